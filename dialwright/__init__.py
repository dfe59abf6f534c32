"""Time-series lakehouse operators for PySpark."""
