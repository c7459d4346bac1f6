"""Operators for training-data pipelines: filters, joins, scoring, encoding, sharding.

Nothing else in the library imports this subpackage. `catalog` holds the
registered queries, one for each operator.
"""
