"""Column functions: lineages, sequences and small helpers, all built of Spark's own functions."""
