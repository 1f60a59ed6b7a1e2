"""Data-warehouse, data-lake and streaming operators written as PySpark DataFrame code."""
