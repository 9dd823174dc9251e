"""Column expressions: every function here returns a ``Column`` built from built-ins."""
