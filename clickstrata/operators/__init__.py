"""The operators: pure ``DataFrame -> DataFrame`` functions."""
