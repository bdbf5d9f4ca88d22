"""Column builders: windows, recursions, scalars."""
