"""Data jobs over tables and streams, built on the public PySpark API."""
