"""The streaming forms of ingest and sessions."""
