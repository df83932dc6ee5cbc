"""Service-desk data on Spark: ingest, normalise, synchronise, enrich, archive and report."""
