"""Schemas, readers, writers and the views over the input tables."""
