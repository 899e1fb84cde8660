"""Relational operators: bars, series windows, joins, profiles, drift and return statistics."""
