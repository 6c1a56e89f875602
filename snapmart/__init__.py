"""Batch analytics for daily per-region item snapshots, written as Spark DataFrame jobs."""
