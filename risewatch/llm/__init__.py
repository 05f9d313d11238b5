"""Operators for building language-model training data: one module per operator, each usable on any table."""
