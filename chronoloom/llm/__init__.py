"""Operators for training-data pipelines over a corpus of documents. Nothing else in the package imports them."""
