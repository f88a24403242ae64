"""Readers: driver tables, stand-in fixtures, files by day."""
