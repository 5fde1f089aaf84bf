"""Operators put together: the import-to-report workflow and the catalogue of registered queries."""
