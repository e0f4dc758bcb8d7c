"""Typed scans and partitioned sinks."""
