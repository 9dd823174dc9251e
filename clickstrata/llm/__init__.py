"""Operators on training data: one module per operator, and their queries."""
