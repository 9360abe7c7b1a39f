"""Structured Streaming wrappers around the batch operators."""
