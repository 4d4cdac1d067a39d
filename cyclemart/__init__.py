"""Feature warehouse and paired-condition analysis written as PySpark jobs."""

__version__ = "0.1.0"
