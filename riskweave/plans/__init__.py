"""End-to-end compositions of operators, one module per risk domain."""
