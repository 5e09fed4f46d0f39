"""Structured Streaming variants of the incremental parts of the workload."""
