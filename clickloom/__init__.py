"""Click-stream analytics expressed as Spark DataFrame queries."""

__version__ = "0.1.0"
