"""Operators: lazy DataFrame -> DataFrame transformations."""
