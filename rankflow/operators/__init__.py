"""Relational, aggregate, window, feature and model operators: DataFrame in, DataFrame out."""
