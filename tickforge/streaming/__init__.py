"""Incremental landing of vendor pages with Structured Streaming."""
