"""Training-data operators: one module for each, with its query; ``catalog`` gathers the queries."""
