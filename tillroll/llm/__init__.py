"""Operators for large text corpora: DataFrame in, DataFrame out."""
