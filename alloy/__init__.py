"""alloy: medallion-style lake tables (landing CSV → bronze → silver → gold) on Spark."""

__version__ = "0.1.0"
