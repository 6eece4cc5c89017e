"""Structured Streaming daily refresh of the panel."""
