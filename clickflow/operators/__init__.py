"""Relational building blocks of the session analysis."""
