"""Point-in-time analytics on event and history tables, as PySpark DataFrame operators."""
