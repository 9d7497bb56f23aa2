"""The ingest loop, the published tables and the full cycle."""
