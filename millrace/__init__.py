"""Reusable PySpark operators that turn messy raw tables into trustworthy reports."""
