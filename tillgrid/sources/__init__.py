"""Readers of the input tables and the store of report cells."""
