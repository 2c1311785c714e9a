"""Spark operators for loan-style tables: ingest, unit cleaning, analytics, imbalanced classification."""
