"""Structured Streaming jobs: bronze ingest, silver streams, stateful change
detection, and the idempotent gold micro-batch writer."""
