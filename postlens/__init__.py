"""Postal and customer analytics on Spark: DataFrame operators over explicit schemas."""
