"""pagelathe: a PySpark engine for page-level document data and retrieval analytics."""

__version__ = "0.1.0"
