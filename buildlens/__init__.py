"""CI build analytics on Spark: lake ingest, star schema, failure triage, data checks."""
