"""Readers and writers: dumps, tables, the summary collection."""
