"""Retail analytics for a book chain, written as Spark DataFrame jobs."""
