"""Operators for training-data pipelines: one module per operator.

Every module holds the operator (general interface, DataFrame in, DataFrame
out) and its registered query ``opN_<name>``. :mod:`tidepool.llm.registry`
collects the queries and their SQL twins.
"""
