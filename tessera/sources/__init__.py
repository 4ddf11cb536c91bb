"""Readers and writers: driver tables, text/binary/JSON files, vector stores."""

from tessera.sources.tables import load_table, TABLES  # noqa: F401
