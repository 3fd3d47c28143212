"""Schemas, table readers and writers, control and audit tables."""
