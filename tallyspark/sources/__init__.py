"""Role views and table access."""
