"""orderlens.plans."""
