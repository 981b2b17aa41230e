"""Sources and sinks: the table under test, verdict/metric/comparison tables.

Inputs are read with the DataFrame reader so Catalyst prunes columns and
pushes filters into columnar scans.  Outputs are written with Spark's
committer (``overwrite`` is atomic per job), so a lost executor only means a
retried task, never a half-written table.  Result tables are tiny (one row
per check or metric) and are written as a single file; data is never
coalesced.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assay.functions.predicates import quote


def read_table(spark: SparkSession, path: str, fmt: str = "parquet", schema=None, **options) -> DataFrame:
    """Read the table under test (with ``schema``, a DDL text or StructType, if given).

    ``fmt="csv"`` reads with a header and *no* type inference: every column is
    a string, as checks on raw text expect (declared types then come from a
    sidecar, see :func:`assay.operators.schema.load_declared_schema`).
    """
    reader = spark.read.format(fmt)
    if fmt == "csv":
        reader = reader.option("header", "true").option("inferSchema", "false")
    for k, v in options.items():
        reader = reader.option(k, v)
    return (reader.schema(schema) if schema else reader).load(path)


def write_verdicts(verdicts: DataFrame, path: str, fmt: str = "csv", mode: str = "overwrite") -> None:
    """Store a verdict table (``checkName, status`` and any extra columns), one file."""
    if "error" in verdicts.columns:
        verdicts = verdicts.withColumn("error", _one_line("error"))
    out = verdicts.coalesce(1).write.mode(mode)
    if fmt == "csv":
        out = out.option("header", "true")
    out.format(fmt).save(path)


def write_metrics(metrics: DataFrame, path: str, fmt: str = "csv", mode: str = "overwrite") -> None:
    """Store a metrics table as ``name, column, value`` (plus ``error``), one file."""
    table = metrics.select(F.col("metric").alias("name"), "column", "value", _one_line("error"))
    out = table.coalesce(1).write.mode(mode)
    if fmt == "csv":
        out = out.option("header", "true")
    out.format(fmt).save(path)


def _one_line(column: str):
    """Line ends as blanks, so that a CSV reader takes each row from one line."""
    return F.regexp_replace(column, r"\s*\n\s*", " ").alias(column)


def read_verdicts(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    """Read a stored verdict table back as ``checkName, status`` (boolean)."""
    df = read_table(spark, path, fmt)
    status = F.col("status")
    if fmt == "csv":
        status = F.lower(F.col("status")) == F.lit("true")
    return df.select(F.col("checkName"), status.alias("status"))


def write_comparison(aligned: DataFrame, path: str, fmt: str = "csv", mode: str = "overwrite",
                     header: bool = True) -> None:
    """Store an aligned comparison table, one file."""
    out = aligned.coalesce(1).write.mode(mode)
    if fmt == "csv":
        out = out.option("header", str(header).lower())
    out.format(fmt).save(path)


def amplify(df: DataFrame, copies: int) -> DataFrame:
    """Bag-union of ``copies`` copies of ``df`` (scale lever for benchmarks).

    One scan: every row is emitted ``copies`` times by a generator, instead of
    unioning ``copies`` scans of the same input.
    """
    if copies < 1:
        raise ValueError("copies must be >= 1")
    if copies == 1:
        return df
    cols = df.columns
    tag = "__assay_copy"
    return df.withColumn(tag, F.explode(F.sequence(F.lit(1), F.lit(int(copies))))).select(*[F.col(quote(c)) for c in cols])


def shared_folder(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder (``spark.checkpoint.dir``)."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        try:  # classic sessions may have it set on the context only
            path = spark.sparkContext.getCheckpointDir()
        except Exception:  # Spark Connect: no SparkContext on the client
            path = None
    if not path:
        raise RuntimeError("spark.checkpoint.dir is not set; point it at a shared folder (HDFS, S3, ...)")
    return str(path).rstrip("/")


def stage(df: DataFrame, fmt: str = "parquet") -> DataFrame:
    """Write ``df`` once to a fresh folder under ``spark.checkpoint.dir`` and read it back.

    A check report scans its input once per group-by and once per SQL
    template.  For a columnar source that is cheap (each scan reads only its
    columns); for CSV/JSON every scan re-parses every row.  Staging converts
    the input to parquet once, cuts the lineage (a lost executor re-reads the
    staged files instead of re-parsing the source), and lets each later scan
    prune columns.  The folder is shared storage, never a machine-local path.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/assay-stage-{uuid.uuid4().hex}"
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    jpath.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(jpath)  # the copy lasts as long as the session
    df.write.mode("errorifexists").format(fmt).save(path)
    return spark.read.format(fmt).load(path)
