"""Operators for large-scale training-text pipelines; nothing else in the package imports this."""
