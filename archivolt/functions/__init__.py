"""Scalar functions shared by the operators."""
