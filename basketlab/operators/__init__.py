"""Relational and ML operators of the retail job."""
