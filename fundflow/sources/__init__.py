"""Sources and sinks: landing-folder scans, header handling, writers."""

from fundflow.sources.headers import clean_name, clean_names, normalize_headers, rename_drift
from fundflow.sources.landed import Sync, manifest, read_deliveries, read_landed, sync_landing
from fundflow.sources.landing import (
    list_files,
    read_csv_folder,
    read_parquet_folder,
    read_period_table,
    tag_period,
    union_all_by_name,
)
from fundflow.sources.sinks import read_csv_output, write_csv, write_parquet

__all__ = [
    "Sync", "clean_name", "clean_names", "list_files", "manifest", "normalize_headers", "read_deliveries", "read_landed",
    "read_csv_folder", "read_csv_output", "read_parquet_folder", "read_period_table", "rename_drift", "tag_period",
    "sync_landing", "union_all_by_name", "write_csv", "write_parquet",
]
