"""Structured Streaming ingest: new files landing in a folder feed the pipeline."""
