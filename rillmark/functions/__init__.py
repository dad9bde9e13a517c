"""Scalar, aggregate and table functions as column expressions, and their SQL names."""
