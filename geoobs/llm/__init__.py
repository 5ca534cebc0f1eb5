"""Operators for preparing text, chat and vector tables at scale, and their registered queries.

Nothing outside this package imports it.
"""
