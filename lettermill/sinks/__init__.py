"""Sinks of the archive engine."""
