"""Structured Streaming: incremental, exactly-once file ingest into a raw layer."""
