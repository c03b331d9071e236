"""Retail sell-out lakehouse toolkit: DataFrame in, DataFrame out."""
