"""Structured Streaming jobs: file arrival, scoring log, daily windows, per-batch drift, validation."""
