"""Readers and sinks."""
