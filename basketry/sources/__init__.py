"""Readers and writers: document folders, envelopes, tables, JDBC, CSV."""
