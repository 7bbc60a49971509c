"""Chat-community archive and analytics jobs on PySpark DataFrames."""

from palaver.archive import Archive, ArchiveConfig, Archiver

__all__ = ["Archive", "ArchiveConfig", "Archiver"]
