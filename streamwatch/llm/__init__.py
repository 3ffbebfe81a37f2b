"""Operators of a training-data pipeline, one module each, on DataFrames of documents."""
