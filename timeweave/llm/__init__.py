"""Operators of a training-data pipeline: filters, joins, encoders and scorers.

Nothing outside this package imports it. Each operator module has a general
DataFrame function; ``queries`` holds the thin contract queries over the tables.
"""
