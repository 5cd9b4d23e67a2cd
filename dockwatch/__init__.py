"""Station availability analytics on Spark: ingest, audit, repair, load and report."""
