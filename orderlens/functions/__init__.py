"""Column expressions (all built-in Spark functions, no UDFs)."""

from orderlens.functions import dates, money, text

__all__ = ["dates", "money", "text"]
