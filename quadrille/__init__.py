"""Zone indicators on Spark: clean open tables, score places, compare years."""

__version__ = "0.1.0"
