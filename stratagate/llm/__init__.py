"""Operators for training-data pipelines.

Nothing outside this package imports it; ``__spark_entry__`` adds its queries
only when the package is present.
"""
