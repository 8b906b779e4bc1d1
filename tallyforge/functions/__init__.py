"""Column expressions and scalar statistics used by the operators."""
