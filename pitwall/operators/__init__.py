"""pitwall.operators."""
