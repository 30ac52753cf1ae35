"""Structured Streaming ingestion: messages, landing zone, quarantine."""
