"""Column-expression builders shared by the operators."""
