"""Readers and writers (sources and sinks)."""

from .landing import append_distinct, land_new_files
from .readers import scan_documents, scan_many, scan_merged, scan_table
from .rescue import parse_records, scan_records, split_records
from .writers import export_json, fan_out, overwrite, refresh_tables, replace_window, restore_folder

__all__ = ["append_distinct", "land_new_files", "scan_documents", "scan_many", "scan_merged", "scan_table", "parse_records",
           "scan_records", "split_records", "export_json", "fan_out", "overwrite", "refresh_tables", "replace_window",
           "restore_folder"]
