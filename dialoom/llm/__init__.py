"""Operators for training-data pipelines: one module per operator.

Each operator is a function over DataFrames with its own parameters and outputs;
``registered`` holds the queries over the given tables.  Every operator takes only the
columns it names, so extra columns of the input never clash with its own.
"""
