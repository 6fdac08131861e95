"""Retail price intelligence on PySpark: snapshots in, price features and monitoring out."""
