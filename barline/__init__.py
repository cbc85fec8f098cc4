"""Market-data analytics on stock Apache Spark: ingestion, validation, dedup, roll-ups, serving queries."""
