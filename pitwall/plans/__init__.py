"""pitwall.plans."""
