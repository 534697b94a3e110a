"""Relational operators of the close: DataFrame in, DataFrame out."""
