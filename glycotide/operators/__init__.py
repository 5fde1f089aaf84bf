"""Operators over flat tables: readings, annotations, metrics and verdicts."""
