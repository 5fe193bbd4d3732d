"""Scans, parsers of landed pages, and sinks."""
