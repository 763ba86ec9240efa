"""orderlens.sources."""
