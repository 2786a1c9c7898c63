"""Readers of the input tables and the shared scratch folder."""

from mnemosieve.sources.tables import read_table, scratch_path, written

__all__ = ["read_table", "scratch_path", "written"]
