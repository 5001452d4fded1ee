"""Readers, table adapters and writers."""
