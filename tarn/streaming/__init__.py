"""Structured Streaming forms of the zone jobs."""
