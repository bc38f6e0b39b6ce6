"""Column names and column expressions shared by the operators."""
