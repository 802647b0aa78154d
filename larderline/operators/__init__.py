"""Reusable DataFrame operators: dedup, price versions, joins, checks, anomalies."""
