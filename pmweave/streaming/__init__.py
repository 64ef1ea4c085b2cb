"""Landing directories as streams."""

from pmweave.streaming.landing import land_batches, read_quarantine, stream_pm_files

__all__ = ["land_batches", "read_quarantine", "stream_pm_files"]
