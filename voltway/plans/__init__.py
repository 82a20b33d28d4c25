"""Query registry."""
