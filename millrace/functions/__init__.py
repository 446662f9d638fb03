"""Column builders over nested values, arrays, JSON text and scalars."""
