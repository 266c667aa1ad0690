"""Lakestar: a sales lakehouse on Spark, from raw files to a star schema."""
