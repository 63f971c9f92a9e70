"""Operators for language-model training data: one module per operator, queries in `queries`."""
