"""Readers, generated record sources and sinks."""
