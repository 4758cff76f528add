"""quillstone: a PySpark-native engine that turns heterogeneous source records into clean product data."""

__version__ = "0.1.0"
