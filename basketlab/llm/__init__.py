"""Operators of a large-scale training-data pipeline, one module each.

Nothing else in the library imports this subpackage; it may import the
library's general helpers (session, shared folder).
"""
