"""Structured Streaming forms of request preparation and incremental corpus prep."""
