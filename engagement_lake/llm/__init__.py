"""Operators of a training-data pipeline. Nothing else in the library depends on them."""
