"""Readers and writers of the documents, diaries and workbooks, and of the driver's tables."""
