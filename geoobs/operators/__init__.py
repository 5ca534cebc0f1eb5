"""Relational operators: selection, reshape, joins, aggregates, windows, sessions, catalogue."""
