"""Operators for large training-data pipelines; no other subpackage imports this one."""
