"""Column kinds and scalar functions."""
