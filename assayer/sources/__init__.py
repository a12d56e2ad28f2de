"""Reading and writing: sessions, CSV, object listings, results, snapshots."""

from .files import read_csv, read_csv_text, write_csv
from .objects import list_objects
from .results import (
    read_latest,
    read_results,
    read_runs,
    read_violations,
    stored_report,
    write_results,
    write_violations,
)
from .session import CatalogSettings, ObjectStore, build_session, remove_folder, scratch_folder, shared_folder
from .snapshots import previous_snapshot, read_as_of, snapshot_log, write_snapshot

__all__ = [
    "CatalogSettings",
    "ObjectStore",
    "build_session",
    "list_objects",
    "previous_snapshot",
    "read_as_of",
    "read_csv",
    "read_csv_text",
    "read_latest",
    "read_results",
    "read_runs",
    "read_violations",
    "remove_folder",
    "scratch_folder",
    "shared_folder",
    "snapshot_log",
    "stored_report",
    "write_csv",
    "write_results",
    "write_snapshot",
    "write_violations",
]
