"""DataFrame operators, one module per layer / query family."""
