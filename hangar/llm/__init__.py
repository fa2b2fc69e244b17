"""Operators of a large-scale training-data pipeline.

Nothing else in the library imports this subpackage; ``registry`` holds its
queries and oracles, which ``__spark_entry__`` adds when it can be imported.
"""
