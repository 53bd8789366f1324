"""Retail analytics as Spark DataFrame and pyspark.ml jobs."""
