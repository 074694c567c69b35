"""Operators of a training-data pipeline: filters, duplicates, scores, formats and mixes."""
