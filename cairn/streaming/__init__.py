"""Structured Streaming: sources, event-time windows, enrichment, sinks."""
