"""Column-level and partitioning helpers shared by the operators."""
