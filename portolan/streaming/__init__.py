"""Incremental ingestion of monthly deliveries with Structured Streaming."""

from portolan.streaming.monthly import delivery_stream, ingest_deliveries, start_fact_ingest

__all__ = ["delivery_stream", "ingest_deliveries", "start_fact_ingest"]
