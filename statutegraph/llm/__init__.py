"""Operators of a large-scale training-data pipeline.

Nothing outside this subpackage imports it.  `queries.QUERIES` and
`queries.ORACLES` list the registered queries.
"""
