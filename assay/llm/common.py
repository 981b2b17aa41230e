"""Helpers shared by the operators: scratch tables on the cluster's shared
folder, joins with hot keys, range bounds, connected components."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assay.session import ensure_checkpoint_dir


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint folder, removed when the session's JVM ends."""
    path = f"{str(ensure_checkpoint_dir(spark)).rstrip('/')}/assay-{name}-{uuid.uuid4().hex}"
    if "://" not in path and not path.startswith("file:"):
        path = spark._jvm.org.apache.hadoop.fs.Path(path).getFileSystem(
            spark._jsc.hadoopConfiguration()).makeQualified(spark._jvm.org.apache.hadoop.fs.Path(path)).toString()
    _filesystem(spark, path).deleteOnExit(spark._jvm.org.apache.hadoop.fs.Path(path))
    return path


def _filesystem(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path).getFileSystem(spark._jsc.hadoopConfiguration())


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once per application, so that its functions run in their
    Python workers wherever the driver was started from."""
    context = spark.sparkContext
    if _SHIPPED.get("application") == context.applicationId:
        return
    root = Path(__file__).resolve().parent.parent
    archive = Path(tempfile.mkdtemp(prefix="assay-ship-")) / "assay.zip"  # on the driver; Spark serves it from there
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, Path(root.name) / f.relative_to(root))
    context.addPyFile(str(archive))
    _SHIPPED["application"] = context.applicationId


_SHIPPED: dict[str, str] = {}


def discard(spark: SparkSession, path: str) -> None:
    """Delete a scratch folder that no later job reads."""
    _filesystem(spark, path).delete(spark._jvm.org.apache.hadoop.fs.Path(path), True)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back: later jobs and
    retries read the files, so they never recompute (or see another order of) the rows."""
    return materialize_at(df, name)[0]


def materialize_at(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """As :func:`materialize`, with the folder, for callers that discard it early."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def task_count(spark: SparkSession, size: float, per_task: float) -> int:
    """Tasks for ``size`` units at ``per_task`` units each, never below the session's shuffle partitions."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), int(size // per_task) + 1)


#: Rows sampled (by a hash, so a retry samples the same) to set the bounds of ranges.  Bounds only set
#: how evenly ranges are filled; every row is dealt to its range.
BOUND_SAMPLE = 20_000


def sampled(rows: DataFrame, column: str) -> tuple[DataFrame, float]:
    """About ``BOUND_SAMPLE`` rows by a hash of ``column``, and their share of all rows."""
    share = min(1.0, BOUND_SAMPLE / max(1, rows.count()))
    slots = int(share * (1 << 20)) + 1
    return rows.where(F.pmod(F.xxhash64(F.lit("bounds"), column), F.lit(1 << 20)) < slots), share


def range_bounds(keys: np.ndarray, weights: np.ndarray, ranges: int) -> np.ndarray:
    """Upper bounds that cut weighted keys into ``ranges`` ranges of nearly equal weight."""
    if not len(keys):
        return np.zeros(0, np.int64)
    order = np.argsort(keys, kind="stable")
    heaped = np.cumsum(weights[order])
    return keys[order][np.searchsorted(heaped, heaped[-1] * np.arange(1, ranges) / ranges)]


def packed(df: DataFrame, name: str = "_row") -> DataFrame:
    """All columns as one struct, so an operator's own columns cannot clash with the input's."""
    return df.select(F.struct(*[F.col(f"`{c.replace('`', '``')}`") for c in df.columns]).alias(name)) \
        if df.columns else df.select(F.struct().alias(name))


#: A key is hot if it holds more than this share of all rows; at most 1 / HOT_SHARE keys can be,
#: which is the proven bound of the broadcast in :func:`join_counted`.
HOT_SHARE = 1e-4


def join_counted(rows: DataFrame, table: DataFrame, key: list[str], count_col: str, total: int) -> DataFrame:
    """``rows`` joined with ``table``, which has one row per key and in ``count_col`` how many of the
    ``total`` rows hold it.  Hot keys (bounded in number) join by broadcast, so their rows stay where
    they are; the others join by a shuffle in which no key is large."""
    hot = F.col(count_col) > max(1.0, total * HOT_SHARE)
    few = F.broadcast(table.where(hot))
    cold = rows.join(F.broadcast(table.where(hot).select(*key)), key, "left_anti")
    return rows.join(few, key).unionByName(cold.join(table.where(~hot), key))


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``node, component`` (the component's smallest node) for every node of ``edges`` (longs ``a, b``).

    Alternates two star operations until the edges are stars around the smallest nodes: each node links
    its larger neighbours to its smallest one, then its smaller neighbours and itself.  Only minima are
    aggregated, no neighbourhood is gathered; hubs are joined by broadcast (:func:`join_counted`).  Each
    round is written to the shared folder, so no lineage grows and a lost executor costs one round.
    """
    spark = edges.sparkSession
    pairs = (edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    now, path = materialize_at(pairs, "edges")
    last = None
    for _ in range(max_rounds):
        count, state = now.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
        if (count, state) == last or not count:
            return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
                now.select(F.col("v").alias("node"), F.col("v").alias("component"))).distinct()
        last = count, state
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"), F.count(F.lit(1)).alias("n"))
        large = (join_counted(both, materialize(least, "least"), ["u"], "n", 2 * count).where("v > u")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        large, held = materialize_at(large, "edges")
        least = materialize(large.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("n")), "least")
        moved = join_counted(large, least, ["u"], "n", large.count()).where("v <> m")
        small = moved.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            least.select("u", F.col("m").alias("v"))).distinct()
        before = path
        now, path = materialize_at(small, "edges")
        discard(spark, before)
        discard(spark, held)
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
