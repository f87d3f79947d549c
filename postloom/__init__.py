"""Spark jobs over tables of job postings: extract, key, clean, enrich, reconcile, serve."""
