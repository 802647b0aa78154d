"""Retail supply and demand analytics as PySpark DataFrame functions."""
