"""Trend analytics over dated rankings, written as Spark DataFrame jobs."""
