"""Retail sales warehouse and analytics as PySpark DataFrame jobs."""
