"""Where documents and counter catalogs come from."""

from pmweave.sources.catalog import Counter, load_catalog, load_settings, read_counter_catalog
from pmweave.sources.files import read_pm_files, read_pm_sequence

__all__ = [
    "Counter", "load_catalog", "load_settings", "read_counter_catalog", "read_pm_files", "read_pm_sequence",
]
