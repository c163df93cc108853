"""Readers, writers and stand-in views."""

from cadenza.sources.tables import TABLES, Tables, read_table  # noqa: F401
