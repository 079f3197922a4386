"""Play-event analytics on Spark: ingest, dedup, star schema, sessions, rollups, checks."""

__version__ = "0.1.0"
