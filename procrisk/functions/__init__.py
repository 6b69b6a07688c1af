"""Column expressions: all built-in functions, evaluated inside generated code."""
