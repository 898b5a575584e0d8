"""Column helpers shared by the operators and the models."""
