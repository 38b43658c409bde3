"""Operators for preparing language-model training data (see the module docstrings)."""
