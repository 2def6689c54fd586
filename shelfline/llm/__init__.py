"""Operators for preparing language-model training data. Nothing outside this package uses them."""
