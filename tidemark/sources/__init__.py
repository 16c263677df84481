"""Readers and writers: source extraction, the raw zone, and the snapshot tables."""

from tidemark.sources.raw_zone import RawZone
from tidemark.sources.source_db import SourceDatabase, SourceFiles
from tidemark.sources.store import TableStore

__all__ = ["RawZone", "SourceDatabase", "SourceFiles", "TableStore"]
