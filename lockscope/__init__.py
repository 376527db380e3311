"""Dependency inventory analytics on PySpark: DataFrame in, DataFrame out."""
