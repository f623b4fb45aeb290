"""quantleaf.plans."""
