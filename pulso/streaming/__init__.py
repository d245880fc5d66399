"""Incremental survey KPIs with Structured Streaming (see ``incremental``)."""
