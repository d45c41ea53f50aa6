"""Operators for preparing text as training data. Nothing outside imports this package."""
