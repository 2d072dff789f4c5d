"""Column functions and their SQL names."""
