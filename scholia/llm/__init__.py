"""Operators of a training-data pipeline, each with a query ``opN_<name>`` over the shared tables."""
