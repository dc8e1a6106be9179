"""Pipelines: DataFrames in, one keyed DataFrame out, lazy and without side effects."""
