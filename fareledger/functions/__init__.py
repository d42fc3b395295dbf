"""Column expressions and distributed rank helpers shared by the operators."""
