"""recordloom: a PySpark engine that turns document text and extraction output into a clean catalog of records."""

__version__ = "0.1.0"
