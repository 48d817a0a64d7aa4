"""Scalar Column functions: tokenizers, keyword filters, colours, unit numbers, metrics, stamps."""
