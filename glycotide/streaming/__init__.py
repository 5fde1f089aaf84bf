"""Streaming forms of the event windows."""
