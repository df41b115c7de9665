"""pitwall.sources."""
