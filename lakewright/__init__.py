"""Spark table operators for metadata-driven data lakes: ingestion, schema checks,
dictionary versioning, column profiling, harmonization and de-identification."""
