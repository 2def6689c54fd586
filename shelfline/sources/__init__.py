"""Readers, cleaners, writers and the adapter for the benchmark tables."""
