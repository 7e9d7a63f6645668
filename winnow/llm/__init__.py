"""Operators of a large-scale training-data pipeline.

Nothing else in the library imports this subpackage; it may import the
library's general helpers.  ``queries.QUERIES`` and ``queries.ORACLES`` hold
the registered queries ``opN_<name>``.
"""
