"""Retail sales mart on Spark: versioned ingestion, typed staging, batch and
stream unification, star schema, event contract, quality tests, reconciliation."""
