"""Structured Streaming jobs: daily bars from ticks, insert-only bar ingest, incremental copy."""
