"""quantleaf.sources."""
