"""Training-data operators for text corpora, one module per operator.

Every operator takes DataFrames and returns a DataFrame; the registered
queries (``queries.py``) are thin wrappers that derive digest columns.
"""
