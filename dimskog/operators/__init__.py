"""Span operators: DataFrame in, DataFrame out; none collects or needs an order of its input."""
