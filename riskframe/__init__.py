"""Risk analytics for payments and lending, written as Spark DataFrame jobs."""

__version__ = "0.1.0"
