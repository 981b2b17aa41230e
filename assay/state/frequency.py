"""Mergeable frequency tables: for one list of keys, how often each value occurs.

A table is kept bucketed by a hash of the keys.  New counts are shuffled to
the same buckets and added bucket by bucket: the old table is read where it
lies and never shuffled.  Each merge writes a new table beside the old one;
the store commits it by name, so a failed merge leaves the old one valid.
"""

from __future__ import annotations

import hashlib
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assay.operators.metrics import _hashable

#: Columns of a frequency table: the hash of the keys, the keys, the rows that hold them.
HASH, COUNT = "_h", "_n"


def frequency_id(keys: tuple[str, ...], where: str | None) -> str:
    """Names a frequency table: the same keys under the same filter share it."""
    return hashlib.sha256("\n".join([*keys, f"WHERE {where}"]).encode()).hexdigest()[:16]


def key_names(keys: tuple[str, ...]) -> list[str]:
    return [f"_k{i}" for i in range(len(keys))]


def counted(df: DataFrame, keys: tuple[str, ...], where: str | None) -> DataFrame:
    """Frequency table of ``df``'s rows (raises ``ValueError`` for keys whose equal values may hash unequally)."""
    rows = (df.where(where) if where else df).selectExpr(*[f"{k} AS {n}" for k, n in zip(keys, key_names(keys))])
    bad = [k for k, f in zip(keys, rows.schema.fields) if not _hashable(f.dataType)]
    if bad or not keys:
        raise ValueError(f"no mergeable frequencies for keys of this type: {', '.join(bad)}" if bad else "no grouping keys")
    names = key_names(keys)
    return (rows.groupBy(*names).agg(F.count(F.lit(1)).alias(COUNT))
            .select(F.xxhash64(*names).alias(HASH), *names, COUNT))


@contextmanager
def opened(spark: SparkSession, path: str, ddl: str, buckets: int):
    """The frequency table at ``path`` as a bucketed table of this session's catalog, for as long as the block lasts."""
    name = f"assay_frequency_{uuid.uuid4().hex}"
    spark.sql(f"CREATE TABLE {name} ({ddl}) USING parquet CLUSTERED BY ({HASH}) SORTED BY ({HASH}) INTO {buckets} BUCKETS "
              f"LOCATION '{path}'")
    try:
        yield spark.table(name)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")  # external: the files stay


def ddl_of(df: DataFrame) -> str:
    return ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.schema.fields)


def added(old: DataFrame | None, new: DataFrame, buckets: int) -> DataFrame:
    """Counts of both tables together, hash-partitioned into ``buckets``; only ``new`` is shuffled."""
    dealt = new.repartition(buckets, HASH)
    if old is None:
        return dealt
    keys = [c for c in new.columns if c != COUNT]
    return old.select(*new.columns).union(dealt).groupBy(*keys).agg(F.sum(COUNT).alias(COUNT))


def write_bucketed(table: DataFrame, path: str, buckets: int) -> None:
    name = f"assay_frequency_{uuid.uuid4().hex}"
    try:
        (table.write.format("parquet").bucketBy(buckets, HASH).sortBy(HASH).option("path", path).saveAsTable(name))
    finally:
        table.sparkSession.sql(f"DROP TABLE IF EXISTS {name}")


def counters(table: DataFrame) -> DataFrame:
    """One row with the five counters of a frequency table; no shuffle of its rows."""
    keys = [c for c in table.columns if c not in (HASH, COUNT)]
    some = "NOT (" + " AND ".join(f"{k} IS NULL" for k in keys) + ")"
    return table.selectExpr(
        f"count_if({some}) AS distinct", f"sum(CASE WHEN {some} THEN 1 END) AS distinctness", "count(1) AS distinct_keep_nulls",
        f"count_if({COUNT} > 1 AND {some}) AS duplicate_groups", f"count_if({COUNT} > 1) AS duplicate_groups_keep_nulls")
