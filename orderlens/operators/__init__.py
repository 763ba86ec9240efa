"""orderlens.operators."""
