"""Scalar helpers and the (few) Python UDFs."""
