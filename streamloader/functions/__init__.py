"""Column expressions: value conversion and type properties."""
