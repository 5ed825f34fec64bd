"""Meter-reading analytics on Spark: cleaning, statistics, features, models, monitoring."""
