"""Web-event analytics on Spark: ingest, sessions, marts, reports and checks."""
