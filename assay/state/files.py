"""What a table folder holds: its leaf folders (partitions) and a fingerprint of each one's files."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from assay.functions.predicates import quote


@dataclass(frozen=True)
class Folder:
    """A leaf folder: its name as a file's metadata have it, its path (of the file, where the source is a
    single file), a fingerprint of its files."""

    name: str
    path: str
    print: str
    is_file: bool = False


def _parent(column) -> Column:
    return F.regexp_replace(column, "/[^/]*$", "")


def leaf_folders(spark: SparkSession, source: str) -> dict[str, Folder]:
    """Every folder under ``source`` that holds files, by name.  The fingerprint covers the files' names,
    sizes and times.

    Spark lists the files (their content is not read); one row per folder reaches the driver.
    """
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(source)
             .select(_parent(F.col("_metadata.file_path")).alias("name"), "path", "length", F.unix_micros("modificationTime").alias("at")))
    rows = (files.groupBy("name").agg(
        F.min("path").alias("path"),
        F.sha2(F.array_join(F.sort_array(F.collect_list(F.concat_ws("|", "path", "length", "at"))), "\n"), 256).alias("print")))
    jpath = spark._jvm.org.apache.hadoop.fs.Path(source)
    single = jpath.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(jpath).isFile()
    return {r.name: Folder(r.name, r.path if single else r.path.rsplit("/", 1)[0], r.print, single) for r in rows.collect()}


def read_folders(source: str, folders: list[Folder], like: DataFrame, fmt: str, options: dict) -> DataFrame:
    """The rows of some leaf folders of the table at ``source``, with the columns of ``like`` and ``_batch``,
    the name of the leaf folder that a row comes from."""
    reader = like.sparkSession.read.format(fmt).options(**options).schema(like.schema)
    if not any(f.is_file for f in folders):
        reader = reader.option("basePath", source)
    return reader.load([f.path for f in folders]).select(*[F.col(quote(c)) for c in like.columns],
                                                         _parent(F.col("_metadata.file_path")).alias("_batch"))
