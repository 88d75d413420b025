"""Column helpers and small join helpers shared by the operators."""
