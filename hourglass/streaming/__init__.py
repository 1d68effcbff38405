"""Streaming entry points: new bronze files trigger idempotent day re-runs."""

from hourglass.streaming.ingest import contiguous_ranges, start_bronze_trigger

__all__ = ["contiguous_ranges", "start_bronze_trigger"]
