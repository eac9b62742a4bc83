"""Operators of a training-data pipeline: deduplication, filters, classifiers, sharding and tokens.

Nothing else in the library imports this package.  Operators take and give DataFrames with any
columns; a column of the input whose name an operator's output uses is replaced.
"""
