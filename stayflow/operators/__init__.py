"""Relational operators: filters, joins, aggregates, ordering, quality checks."""
