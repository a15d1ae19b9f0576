"""Cleaning, enriching and checking trade tables on Spark, from raw text to analytics tables."""
