"""Retail analytics and recommendation jobs written as Spark DataFrame code."""

__version__ = "0.1.0"
