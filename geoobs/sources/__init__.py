"""Readers of landed files and partitioned sinks."""
