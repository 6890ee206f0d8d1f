"""Date-partitioned lake tables on Spark."""

__version__ = "0.1.0"
