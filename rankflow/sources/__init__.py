"""Readers, writers and checks of stored tables."""

from rankflow.sources.audit import audit_csv, audit_rows, read_clean, split_faulty
from rankflow.sources.inference import infer_types
from rankflow.sources.readers import (
    inferred_types,
    read_by_name,
    read_declared,
    read_inferred,
    read_lines,
    read_list_file,
    read_quoted,
)
from rankflow.sources.records import read_records
from rankflow.sources.schemas import (
    ITEM_INFO_BULKY,
    ITEM_INFO_TEXTS,
    PASSENGER_SCHEMA,
    append_field,
    interaction_schema,
    prepend_field,
    without_fields,
)
from rankflow.sources.sinks import head_sample, write_csv, write_parquet
from rankflow.sources.workspace import Workspace, close_session_workspace, ensure_checkpoint_dir, new_folder

__all__ = [
    "Workspace",
    "close_session_workspace",
    "infer_types",
    "inferred_types",
    "read_clean",
    "read_records",
    "split_faulty",
    "ITEM_INFO_BULKY",
    "ITEM_INFO_TEXTS",
    "PASSENGER_SCHEMA",
    "append_field",
    "audit_csv",
    "audit_rows",
    "ensure_checkpoint_dir",
    "head_sample",
    "interaction_schema",
    "new_folder",
    "prepend_field",
    "read_by_name",
    "read_declared",
    "read_inferred",
    "read_lines",
    "read_list_file",
    "read_quoted",
    "without_fields",
    "write_csv",
    "write_parquet",
]
