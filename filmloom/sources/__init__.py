"""Readers, writers and the catalog views over the benchmark tables."""
