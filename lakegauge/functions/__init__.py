"""Column expressions: JSON access, ISO times, casts, shapes, units."""
