"""Operators of a training-data pipeline, each with a thin registered query."""
