"""Bulk load and change apply for PySpark: DataFrames in, target tables out."""

from bulkapply.options import SinkOptions, TargetSpec
from bulkapply.functions.schema import SchemaError, validate_schema
from bulkapply.operators.changelog import apply_changes, collapse
from bulkapply.operators.keyed import (
    delete_by_key,
    insert_if_absent,
    lookup_by_key,
    row_exists,
    update_by_key,
    upsert,
)

__all__ = [
    "SchemaError",
    "SinkOptions",
    "TargetSpec",
    "apply_changes",
    "collapse",
    "delete_by_key",
    "insert_if_absent",
    "lookup_by_key",
    "row_exists",
    "update_by_key",
    "upsert",
    "validate_schema",
]
