"""Operators for large training corpora: one module per operator, bound to tables in ``queries``."""
