"""Operators of a training-corpus pipeline: dedup, decontamination, quality,
language, licenses, secrets, toxicity, mixing and token output.

Nothing else in the package imports this one.
"""
