"""The state of a table's metrics, on a shared folder.

Layout under the store's folder: ``scan/run=<id>`` holds the scan states that
one update computed, ``frequency/<keys>/<id>`` a bucketed frequency table,
``manifest/<number>`` the list of what counts: one row per (metric or frequency
table, folder or batch).  An update writes its data under fresh names and then
one new manifest; until that is complete (``_SUCCESS``) the former one holds.  A
lost executor repeats a task, a lost driver leaves files that no manifest
names (``vacuum`` deletes them), and an update that is repeated computes nothing
twice.
"""

from __future__ import annotations

import hashlib
import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assay.operators.metrics import METRICS_SCHEMA, Metric, NamedMetric, _build_or_error, _explode_rows, _row_sql, union_all
from assay.session import job_label
from assay.sources.io import read_table
from assay.state.files import leaf_folders, read_folders
from assay.state.frequency import added, counted, counters, ddl_of, frequency_id, opened, write_bucketed
from assay.state.scan import MERGEABLE, STATE_SCHEMA, merged, metric_key, scan_states, target_sql, value_of

#: What a manifest's rows say, by ``kind``:
#: ``scan``  - the run ``data`` holds the states of the definitions ``name`` over the folder ``batch``
#: ``set``   - the definition ``detail`` belongs to the definitions ``name``
#: ``table`` - the frequency table ``name`` lies in ``data``, has the columns ``detail`` and holds the folders ``batch``
#: ``group`` - the folder ``batch`` belongs to the folders ``name``
#: ``failed`` - the frequency table ``name`` cannot be kept, for the reason ``detail``
MANIFEST_SCHEMA = "kind string, name string, batch string, print string, data string, detail string"


#: Frequency tables that are brought up to date at once.
TABLES_AT_ONCE = 4


@dataclass
class Update:
    """What an update did: folders (or batches) read, folders whose state was there, folders that are gone."""

    read: list[str] = field(default_factory=list)
    kept: list[str] = field(default_factory=list)
    gone: list[str] = field(default_factory=list)


def _named(parts) -> str:
    return hashlib.sha256("\n".join(parts).encode()).hexdigest()[:16]


class TableState:
    """Mergeable state of scan and frequency metrics at ``path`` (a folder that all hosts share).

    ``refresh`` follows a table of files: it reads the leaf folders (partitions) that are new or changed and
    forgets those that are gone.  ``add`` takes batches by name instead (a stream's micro-batches, say); a
    batch that the store holds is not counted again.  ``metrics`` merges what is there.

    A folder that changes or goes costs the frequency tables a new count of all folders (what a key's rows
    in one folder were is not kept); scan states only lose that folder's rows.  One update runs at a time.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int = 64):
        self.spark, self.path, self.buckets = spark, path.rstrip("/"), buckets

    # ---- the manifest -------------------------------------------------------
    def _fs(self, path: str):
        jpath = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return jpath.getFileSystem(self.spark._jsc.hadoopConfiguration()), jpath

    def _children(self, folder: str) -> list[str]:
        fs, p = self._fs(folder)
        return [f"{folder}/{s.getPath().getName()}" for s in fs.listStatus(p)] if fs.exists(p) else []

    def _numbers(self, complete: bool = True) -> list[int]:
        found = self._children(f"{self.path}/manifest")
        whole = lambda m: self._fs(m)[0].exists(self._fs(f"{m}/_SUCCESS")[1])
        return sorted(int(m.rsplit("/", 1)[1]) for m in found if not complete or whole(m))

    def manifest(self) -> DataFrame:
        """What counts now (``MANIFEST_SCHEMA``)."""
        numbers = self._numbers()
        if not numbers:
            return self.spark.createDataFrame([], MANIFEST_SCHEMA)
        return self.spark.read.schema(MANIFEST_SCHEMA).parquet(f"{self.path}/manifest/{numbers[-1]}")

    def _commit(self, rows: list[tuple]) -> None:
        """Write the next manifest; a number that another update takes meanwhile is an error, not an overwrite."""
        number = max(self._numbers(complete=False), default=0) + 1
        self.spark.createDataFrame(rows, MANIFEST_SCHEMA).coalesce(1).write.mode("errorifexists").parquet(f"{self.path}/manifest/{number}")

    def vacuum(self) -> None:
        """Delete the data and manifests that the newest manifest does not name (no update may be running)."""
        numbers = self._numbers()
        held = {r.data for r in self.manifest().select("data").distinct().collect()}
        for folder in (f"{self.path}/scan", *self._children(f"{self.path}/frequency")):
            for child in self._children(folder):
                if child[len(self.path) + 1:] not in held:
                    fs, p = self._fs(child)
                    fs.delete(p, True)
        for n in numbers[:-1]:
            fs, p = self._fs(f"{self.path}/manifest/{n}")
            fs.delete(p, True)

    # ---- updates ------------------------------------------------------------
    def refresh(self, source: str, named: list[NamedMetric], fmt: str = "parquet", **options) -> Update:
        """Bring the states of ``named`` up to date with the files at ``source``; unchanged folders are not read."""
        folders = leaf_folders(self.spark, source)
        if fmt == "csv":
            options = {"header": "true"} | options
        like = read_table(self.spark, source, fmt, **options)
        return self._update({n: f.print for n, f in folders.items()}, named,
                            lambda names: read_folders(source, [folders[n] for n in names], like, fmt, options))

    def add(self, df: DataFrame, batch: str, named: list[NamedMetric]) -> Update:
        """Add the rows of ``df`` as ``batch`` to the states of ``named``; metrics that hold the batch keep theirs."""
        have = {r.batch: r.print for r in self.manifest().where("kind IN ('scan', 'group')").select("batch", "print").distinct().collect()}
        return self._update(have | {batch: "batch"}, named, lambda _: df.withColumn("_batch", F.lit(batch)), only=[batch])

    def _update(self, now: dict[str, str], named: list[NamedMetric], read, only: list[str] | None = None) -> Update:
        rows = [tuple(r) for r in self.manifest().collect()]  # a few rows per folder, and one per definition and table
        of_kind = lambda kind: [r for r in rows if r[0] == kind]
        known = {r[2] for r in rows if r[0] in ("scan", "group")}
        out = Update(gone=sorted(known - set(now)))
        keep, read_now = self._update_scan(now, named, read, only, of_kind)
        tables, also = self._update_tables(now, named, read, only, of_kind)
        out.read = sorted(read_now | also)
        out.kept = sorted(set(now) - set(out.read))
        if sorted(keep + tables, key=repr) != sorted(rows, key=repr):
            self._commit(keep + tables)
        return out

    def _update_scan(self, now, named, read, only, of_kind) -> tuple[list[tuple], set[str]]:
        """Manifest rows of the scan states, and the folders read.  Folders that lack the same definitions are
        read together."""
        asked = {metric_key(m): m for m in (nm.metric for nm in named) if m.kind in ("scan", "failed")}
        sets: dict[str, set[str]] = {}
        for _, name, _, _, _, detail in of_kind("set"):
            sets.setdefault(name, set()).add(detail)
        keep = [r for r in of_kind("scan") if now.get(r[2]) == r[3]]
        held: dict[str, set[str]] = {}
        for _, name, batch, *_ in keep:
            held.setdefault(batch, set()).update(sets[name])
        lacking: dict[tuple, list[str]] = {}
        for batch in only or now:
            missing = tuple(k for k in asked if k not in held.get(batch, ()))
            if missing:
                lacking.setdefault(missing, []).append(batch)
        for missing, batches in lacking.items():
            metrics, df = [asked[k] for k in missing], read(sorted(batches))
            data, name = f"scan/run={uuid.uuid4().hex}", _named(sorted(missing))
            with job_label(self.spark, f"assay: states of {len(metrics)} metrics over {len(batches)} folders"):
                scan_states(df, metrics, self._pivots(df, metrics, keep), True).write.parquet(f"{self.path}/{data}")
            sets[name] = set(missing)
            keep += [("scan", name, b, now[b], data, None) for b in batches]
        used = {r[1] for r in keep}
        return keep + [("set", n, None, None, None, k) for n in sorted(used) for k in sorted(sets[n])], {b for bs in lacking.values() for b in bs}

    def _update_tables(self, now, named, read, only, of_kind) -> tuple[list[tuple], set[str]]:
        """Manifest rows of the frequency tables, and the folders read.  New folders are added to a table; if one
        that it holds has changed or gone, it is counted anew."""
        asked = {frequency_id(m.target, m.where): (m.target, m.where) for m in (nm.metric for nm in named) if m.kind == "frequency"}
        groups: dict[str, dict[str, str]] = {}
        for _, name, batch, mark, *_ in of_kind("group"):
            groups.setdefault(name, {})[batch] = mark
        before = {r[1]: r for r in of_kind("table")}
        keep, read_now, writes = [r for r in of_kind("table") if r[1] not in asked and groups[r[2]].items() <= now.items()], set(), []
        for table, (keys, where) in asked.items():
            old = before.get(table)
            holds = groups[old[2]] if old else {}
            grows = bool(old) and holds.items() <= now.items()
            if old and not grows and only:
                raise ValueError(f"batches of this store have changed: {sorted(set(holds) - set(now))[:3]}")
            fresh = sorted((set(only or now) - set(holds)) if grows else set(only or now))
            if old and grows and not fresh:
                keep.append(old)
                continue
            if not now:
                keep.append(("failed", table, None, None, None, "the source holds no files"))
                continue
            new, error = _build_or_error(lambda: counted(read(fresh), keys, where))
            if not error and grows and old[5] != ddl_of(new):  # other types than before: count anew
                grows, fresh = False, sorted(now)
                new, error = _build_or_error(lambda: counted(read(fresh), keys, where))
            if error:
                keep.append(("failed", table, None, None, None, error))
                continue
            data, ddl = f"frequency/{table}/{uuid.uuid4().hex}", ddl_of(new)
            label = f"assay: frequencies of {', '.join(keys)} over {len(fresh)} folders"
            writes.append((label, new, f"{self.path}/{old[4]}" if grows else None, f"{self.path}/{data}"))
            members = {b: now[b] for b in (set(holds) if grows else set()) | set(fresh)}
            group = _named(f"{b} {m}" for b, m in sorted(members.items()))
            groups[group] = members
            keep.append(("table", table, group, None, data, ddl))
            read_now |= set(fresh)
        with ThreadPoolExecutor(TABLES_AT_ONCE) as pool:  # each is a Spark job of its own; small ones share the cluster
            list(pool.map(lambda w: self._write_table(*w), writes))
        used = {r[2] for r in keep if r[0] == "table"}
        return keep + [("group", g, b, m, None, None) for g in sorted(used) for b, m in sorted(groups[g].items())], read_now

    def _write_table(self, label: str, new: DataFrame, old: str | None, path: str) -> None:
        with job_label(self.spark, label):
            if old is None:
                return write_bucketed(added(None, new, self.buckets), path, self.buckets)
            with opened(self.spark, old, ddl_of(new), self.buckets) as kept:
                write_bucketed(added(kept, new, self.buckets), path, self.buckets)

    def _pivots(self, df: DataFrame, metrics: list[Metric], keep: list[tuple]) -> dict[str, float]:
        """Where squares are measured from: the value that the store already has, else any value of the new rows."""
        want = {metric_key(m): m for m in metrics if m.agg == "stddev_pop"}
        runs, found = sorted({r[4] for r in keep}), {}
        if runs and want:
            states = self.spark.read.schema(STATE_SCHEMA).parquet(*[f"{self.path}/{r}" for r in runs])
            found = {r.metric: r.pivot for r in states.where("pivot IS NOT NULL").groupBy("metric").agg(F.max("pivot").alias("pivot")).collect()}
        for key, m in want.items():
            if key not in found:
                value = f"CAST({target_sql(m)} AS DOUBLE)"
                row, error = _build_or_error(lambda v=value: df.selectExpr(f"{v} AS v").where("abs(v) < 1e300").limit(1).collect())
                found[key] = row[0].v if not error and row else 0.0
        return found

    # ---- results ------------------------------------------------------------
    def metrics(self, named: list[NamedMetric]) -> DataFrame:
        """``metric, column, key, value, error`` (as ``compute_metrics``) out of the states; reads no source row.
        A definition that the store does not hold, or not for all its folders, has an error that says so."""
        spark, pieces, literal = self.spark, [], []
        entries = self.manifest()
        rows = entries.collect()
        runs = sorted({r.data for r in rows if r.kind == "scan"})
        folders = {r.batch for r in rows if r.kind in ("scan", "group")}
        members: dict[str, set[str]] = {}  # the folders of a set of definitions, of a group
        for r in rows:
            if r.kind in ("scan", "group"):
                members.setdefault(r.name, set()).add(r.batch)
        covered: dict[str, set[str]] = {}
        for r in rows:
            if r.kind == "set":
                covered.setdefault(r.detail, set()).update(members.get(r.name, ()))

        def lacks(have: set[str] | None) -> str | None:
            if have is None:
                return "no state"
            return None if have >= folders else f"the state lacks {len(folders - have)} of {len(folders)} folders: refresh it with this metric"

        scan = [nm for nm in named if nm.metric.kind in ("scan", "failed")]
        literal += [(nm, e) for nm in scan if (e := lacks(covered.get(metric_key(nm.metric))))]
        scan = [nm for nm in scan if not lacks(covered.get(metric_key(nm.metric)))]
        if scan:
            states = (spark.read.schema(STATE_SCHEMA).parquet(*[f"{self.path}/{r}" for r in runs])
                      .withColumn("data", F.regexp_extract("_metadata.file_path", "(scan/run=[0-9a-f]+)/", 1)))
            counting = entries.where("kind = 'scan'").select("batch", "data")
            own = states.join(counting, ["batch", "data"], "left_semi").unionByName(states.where("error IS NOT NULL"))
            asked = spark.createDataFrame([(metric_key(nm.metric), nm.metric.agg, nm.name, nm.column, nm.key) for nm in scan],
                                          "_asked string, _agg string, _name string, _column string, _key string")
            # A metric none of whose folders has rows has no state row: it is what an empty table gives.
            joined = (asked.join(merged(own), F.col("_asked") == F.col("metric"), "left")
                      .selectExpr("* EXCEPT (n)", "CASE WHEN error IS NULL THEN coalesce(n, 0L) END AS n"))
            value = " ".join(["CASE _agg", *[f"WHEN '{a}' THEN {value_of(Metric(a, ('0',)))}" for a in MERGEABLE], "END"])
            pieces.append(joined.selectExpr("_name AS metric", "_column AS `column`", "_key AS key", f"CASE WHEN error IS NULL THEN {value} END AS value",
                                            "error"))
        at = {r.name: r for r in rows if r.kind in ("table", "failed")}
        tables: dict[str, list[NamedMetric]] = {}
        for nm in named:
            if nm.metric.kind == "frequency":
                table = frequency_id(nm.metric.target, nm.metric.where)
                entry = at.get(table)
                error = entry.detail if entry is not None and entry.kind == "failed" else lacks(members.get(entry.batch) if entry else None)
                if error:
                    literal.append((nm, error))
                else:
                    tables.setdefault(table, []).append(nm)
        for table, nms in tables.items():
            counts = spark.read.schema(at[table].detail).parquet(f"{self.path}/{at[table].data}")
            pieces.append(_explode_rows(counters(counts), [_row_sql(nm, f"CAST({nm.metric.agg} AS DOUBLE)") for nm in nms]))
        if literal:
            pieces.append(_explode_rows(spark.range(1), [_row_sql(nm, "CAST(NULL AS DOUBLE)", e) for nm, e in literal]))
        return union_all(pieces) if pieces else spark.createDataFrame([], METRICS_SCHEMA)
