"""Incremental landing: the trade cleaning run as a Structured Streaming job."""
