"""Scans, adapters and sinks."""
