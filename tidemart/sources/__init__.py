"""Readers: topics, change records, tables and dimensions."""
