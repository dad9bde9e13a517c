"""Operators for training text: each module holds one, ``catalog`` applies them to the given tables."""
