"""Retail leakage analytics on Spark: cleaning, auditing, economics, scorecards and an action queue."""

__version__ = "0.1.0"
