"""Training-data operators: one module per operator, ``queries`` registers the op<N> queries."""
