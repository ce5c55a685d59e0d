"""Operators on training text: one module each, queries and SQL in ``registered``."""
