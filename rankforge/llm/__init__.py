"""Operators for large-scale training-data preparation.

Nothing outside this subpackage imports it.  Each module holds one operator;
``catalog`` registers one query per operator.
"""
