"""Readers, staged tables, and the people tables derived from the driver's data."""

from tallyframe.sources.csv_tables import (
    FEATURE_SCHEMA,
    LABELLED_SCHEMA,
    fault_counts,
    read_checked,
    read_csv,
    read_labelled,
    read_unlabelled,
)
from tallyframe.sources.people import FROZEN_LABELS, PEOPLE_COLUMNS, frozen_scores, people, people_nulls, read_table
from tallyframe.sources.staging import release, run_folder, shared_folder, stage_csv, stage_parquet

__all__ = [
    "FEATURE_SCHEMA",
    "FROZEN_LABELS",
    "LABELLED_SCHEMA",
    "PEOPLE_COLUMNS",
    "fault_counts",
    "frozen_scores",
    "people",
    "people_nulls",
    "read_checked",
    "read_csv",
    "read_labelled",
    "read_table",
    "read_unlabelled",
    "release",
    "run_folder",
    "shared_folder",
    "stage_csv",
    "stage_parquet",
]
