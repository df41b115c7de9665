"""pitwall.streaming."""
