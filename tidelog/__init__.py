"""Change-data engine on PySpark: decode, order, dedup, resolve and apply row mutations."""
