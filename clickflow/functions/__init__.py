"""Scalar functions as built-in column expressions."""
