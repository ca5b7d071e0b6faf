"""Operators: staging, joins, aggregates, pivot, sampling, checks and catalog."""
