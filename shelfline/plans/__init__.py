"""Shared pre-aggregations and the catalogue of named reports."""
