"""The ingest flow for files that keep arriving."""
