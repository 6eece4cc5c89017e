"""Stored tables that are replaced key by key."""
