"""Column builders: type coercion and packed flag words."""
