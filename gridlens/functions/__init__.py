"""Column builders: geometry and scalars."""
