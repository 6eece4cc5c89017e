"""Correctness tooling: independent DuckDB formulations and the compare tool."""
