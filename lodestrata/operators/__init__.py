"""Relational building blocks the plans are made of."""
