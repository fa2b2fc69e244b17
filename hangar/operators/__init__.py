"""Relational operators of the warehouse: quality rules, dimensions, facts, checks."""
