"""Operators of a training-data pipeline, from language to packed pieces."""
