"""quantleaf.operators."""
