"""Whole reports composed from the operators, and the checks registered for them."""
