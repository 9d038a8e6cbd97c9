"""Readers, log tables and the views over the given tables."""
