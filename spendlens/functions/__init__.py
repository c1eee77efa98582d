"""Column-level functions (text, keys) shared by the operators."""
