"""Court-decision coding and dataset comparison as PySpark DataFrame jobs."""

__version__ = "0.1.0"
