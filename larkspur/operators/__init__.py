"""DataFrame operators of the ingest and table lifecycle."""
