"""E-commerce lakehouse building blocks on plain PySpark.

Every transformation takes and returns DataFrames; the caller owns the SparkSession.
"""
