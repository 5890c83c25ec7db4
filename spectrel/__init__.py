"""Spectrum search and its supporting table operators as Spark DataFrame jobs."""
