"""Declared column types and schema-driven expansion of checks over columns.

A declared type is a routing label: it decides which checks apply to a column,
it never casts data.  By default it is derived from ``df.schema``; a user may
override it (e.g. a CSV read as all-string whose sidecar says ``Int``).
All of this is driver-side metadata work; no Spark job runs here.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from assay.sources.hocon import load

# Declared type labels, plus the wildcard that matches every column.
INT, DOUBLE, STRING, DATE, OTHER = "Int", "Double", "String", "Date", "Other"
ANY = "any"
COLUMN_PLACEHOLDER = "${column}"


@dataclass(frozen=True)
class DeclaredColumn:
    name: str
    type: str
    dtype: T.DataType | None = None


def declared_type(dtype: T.DataType) -> str:
    if isinstance(dtype, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return INT
    if isinstance(dtype, (T.FloatType, T.DoubleType, T.DecimalType)):
        return DOUBLE
    if isinstance(dtype, (T.StringType, T.CharType, T.VarcharType)):
        return STRING
    if isinstance(dtype, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return DATE
    return OTHER


def declared_columns(df: DataFrame, overrides: dict[str, str] | list | None = None) -> list[DeclaredColumn]:
    """Columns of ``df`` with their declared type; ``overrides`` maps name -> type.

    ``overrides`` may also be a sidecar list ``[{"columnName": .., "columnType": ..}]``;
    then it *is* the declared schema (only the listed columns are checked, in that order).
    """
    fields = {f.name: f.dataType for f in df.schema.fields}
    if isinstance(overrides, list):
        return [DeclaredColumn(e["columnName"], e["columnType"], fields.get(e["columnName"])) for e in overrides]
    overrides = overrides or {}
    out, seen = [], set()
    for f in df.schema.fields:
        # A repeated name (e.g. after a join) is declared once: checks on it then
        # fail with Spark's ambiguity error, and the duplicate-column check flags it.
        if f.name in seen:
            continue
        seen.add(f.name)
        out.append(DeclaredColumn(f.name, overrides.get(f.name, declared_type(f.dataType)), f.dataType))
    return out


def load_declared_schema(path: str) -> list[dict]:
    """Read a sidecar ``{"schema": [{"columnName": .., "columnType": ..}]}``, a JSON or HOCON file."""
    return load(path)["schema"]


def matching_columns(columns: list[DeclaredColumn], types: list[str]) -> list[DeclaredColumn]:
    """Columns a per-column definition applies to: declared type listed, or ``any`` listed."""
    if ANY in types:
        return list(columns)
    return [c for c in columns if c.type in types]


def duplicate_column_names(df: DataFrame, case_sensitive: bool | None = None) -> int:
    """1 if two columns share a name (per ``spark.sql.caseSensitive``), else 0."""
    if case_sensitive is None:
        conf = df.sparkSession.conf.get("spark.sql.caseSensitive", "false")
        case_sensitive = str(conf).lower() == "true"
    names = [f.name if case_sensitive else f.name.lower() for f in df.schema.fields]
    return int(len(set(names)) != len(names))
