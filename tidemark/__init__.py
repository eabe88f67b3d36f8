"""Change-data lakehouse on PySpark: ingest, clean, keep history, build marts, test."""
