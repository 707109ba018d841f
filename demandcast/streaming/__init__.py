"""Structured Streaming: incremental landing of CSV drops (the original
pipeline has no streaming operators; this re-aims its ingest stage)."""
