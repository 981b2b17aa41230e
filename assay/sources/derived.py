"""Derived test tables for differential checks (Spark vs. an SQL oracle).

The driver-generated tables are perfectly clean (no nulls, duplicates or
empty strings), so null/duplicate behaviour is exercised on tables derived
from them by a fixed formula.  Each formula is SQL text that Spark and DuckDB
both accept; ``{name}`` marks an input table.  Spark runs it with
``spark.sql(text, name=df)``, the oracle substitutes plain table names, so
both sides build exactly the same rows from the whole input tables.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

DERIVED_SQL = {
    # Nulls, empty strings, integral text, zeros and duplicate rows in one table.
    "dirty_customer": """
        SELECT CASE WHEN c_custkey % 17 = 0 THEN NULL ELSE c_custkey END AS k,
               CASE WHEN c_custkey % 13 = 0 THEN ''
                    WHEN c_custkey % 11 = 0 THEN CAST(c_custkey AS STRING)
                    ELSE c_mktsegment END AS seg,
               CASE WHEN c_custkey % 19 = 0 THEN 0.0 ELSE c_acctbal END AS bal
        FROM {customer}
        UNION ALL
        SELECT c_custkey, c_mktsegment, c_acctbal FROM {customer} WHERE c_mktsegment = 'AUTOMOBILE'
    """,
    # Natural nulls: documents without labels.
    "labelled_documents": """
        SELECT d.doc_id, d.text, d.lang, d.source, d.n_chars, l.quality, l.toxic
        FROM {documents} d LEFT JOIN {labels} l ON d.doc_id = l.doc_id
    """,
    # One value plus nulls, an all-null column and a two-valued column.
    "constant_with_nulls": """
        SELECT CASE WHEN o_orderstatus = 'F' THEN NULL ELSE 'open' END AS state,
               CAST(NULL AS BIGINT) AS nothing,
               CASE WHEN o_totalprice > 100000 THEN 'big' ELSE 'small' END AS size_band,
               o_orderdate
        FROM {orders}
    """,
    # Rows whose every column is null next to unique rows.
    "all_null_rows": """
        SELECT CASE WHEN o_orderpriority = '1-URGENT' THEN NULL ELSE o_orderkey END AS ok,
               CASE WHEN o_orderpriority = '1-URGENT' THEN NULL ELSE o_custkey END AS ck
        FROM {orders}
    """,
    # Column names with a space, a dot and a hyphen.
    "odd_names": """
        SELECT c_custkey AS `cust key`, c_name AS `c.name`, c_acctbal AS `acct-bal`,
               c_mktsegment AS `seg``tick`
        FROM {customer}
    """,
    # One value holding about half of all rows (open line items), the rest unique.
    "hot_key_lineitem": """
        SELECT CASE WHEN l_linestatus = 'O' THEN 'hot'
                    ELSE CAST(l_orderkey AS STRING) || '-' || CAST(l_linenumber AS STRING) END AS line_key,
               l_returnflag, l_quantity
        FROM {lineitem}
    """,
    # Whole numbers as text in odd forms: blanks, signs, trailing zeros, beyond 64 bits, not numbers.
    "number_texts": """
        SELECT CASE o_orderkey % 10 WHEN 0 THEN ' 42 ' WHEN 1 THEN '+7' WHEN 2 THEN '-3.' WHEN 3 THEN '12.000'
                    WHEN 4 THEN '99999999999999999999' WHEN 5 THEN '9223372036854775807' WHEN 6 THEN '1 2'
                    WHEN 7 THEN '0.50' WHEN 8 THEN '' ELSE '1e3' END AS form,
               CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE ' +' || CAST(o_orderkey AS STRING) || '.0 ' END AS signed
        FROM {orders}
    """,
    # Every column as text, with fractions, zeros and junk mixed in.
    "stringly_orders": """
        SELECT CAST(o_orderkey AS STRING) AS ok,
               CASE WHEN o_orderkey % 7 = 0 THEN CAST(o_custkey AS STRING) || '.0'
                    WHEN o_orderkey % 11 = 0 THEN '0.5'
                    WHEN o_orderkey % 13 = 0 THEN 'abc'
                    ELSE CAST(o_custkey AS STRING) END AS ck,
               o_orderstatus AS status,
               CASE WHEN o_orderkey % 5 = 0 THEN '0' WHEN o_orderkey % 9 = 0 THEN '-3.25'
                    ELSE CAST(o_totalprice AS STRING) END AS price,
               o_orderpriority AS priority
        FROM {orders}
    """,
}

_PLACEHOLDER = re.compile(r"\{(\w+)\}")


def inputs_of(name: str) -> list[str]:
    return sorted(set(_PLACEHOLDER.findall(DERIVED_SQL[name])))


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """A driver table, or a derived table built from the driver tables."""
    if table not in DERIVED_SQL:
        return spark.read.parquet(f"{sf_dir}/{table}.parquet")
    frames = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in inputs_of(table)}
    return spark.sql(DERIVED_SQL[table], **frames)


def oracle_sql(table: str) -> str:
    """The same formula for the oracle, with ``STRING`` spelled as DuckDB accepts it."""
    if table not in DERIVED_SQL:
        return table
    text = _PLACEHOLDER.sub(lambda m: m.group(1), DERIVED_SQL[table])
    text = text.replace("`", '"').replace('""', '`')
    return "(" + text + ")"
