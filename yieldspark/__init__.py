"""yieldspark: factory test-line ETL and yield KPIs as Spark DataFrame jobs."""

__version__ = "0.1.0"
