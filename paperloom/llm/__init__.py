"""Operators of a training-data pipeline: documents in, clean and packed sequences out."""
