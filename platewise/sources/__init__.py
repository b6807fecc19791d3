"""Readers: raw lake, warehouse, files as data."""
