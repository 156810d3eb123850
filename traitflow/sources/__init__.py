"""Readers, raw-line hygiene, per-source ingest recipes and sinks."""
