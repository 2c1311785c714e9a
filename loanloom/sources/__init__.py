"""Readers and writers: CSV, path and catalog tables, their layout, landings, zipped CSV."""

from loanloom.sources.archive import read_zipped_csv, read_zipped_lines
from loanloom.sources.catalog import create_bucketed_table, create_table_as, insert_overwrite
from loanloom.sources.clustering import write_clustered
from loanloom.sources.delimited import csv_view, read_csv, write_csv
from loanloom.sources.landing import land_new, landed_rows, ledger
from loanloom.sources.listing import manifest
from loanloom.sources.partitions import replace_partitions
from loanloom.sources.quarantine import read_quarantine, write_or_quarantine
from loanloom.sources.tables import (
    enforce_schema,
    read_table,
    required_nulls,
    spread,
    table_view,
    write_enforced,
    write_table,
)

__all__ = [
    "create_bucketed_table",
    "create_table_as",
    "csv_view",
    "enforce_schema",
    "insert_overwrite",
    "land_new",
    "landed_rows",
    "ledger",
    "manifest",
    "read_csv",
    "read_quarantine",
    "read_table",
    "read_zipped_csv",
    "read_zipped_lines",
    "replace_partitions",
    "required_nulls",
    "spread",
    "table_view",
    "write_clustered",
    "write_csv",
    "write_enforced",
    "write_or_quarantine",
    "write_table",
]
