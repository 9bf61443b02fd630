"""foliospark: turns page-structured documents into grounded chat records, on Spark."""

__version__ = "0.1.0"
