"""Forms of the operators that run on streams."""
