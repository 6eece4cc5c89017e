"""Reusable DataFrame -> DataFrame operators: periods, rollups, joins,
sequences, credit, panel and report."""
