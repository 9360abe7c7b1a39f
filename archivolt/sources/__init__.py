"""Readers that turn files into canonical frames."""
