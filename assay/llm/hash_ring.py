"""Shards by a consistent-hash ring with virtual nodes and bounded loads.

Every shard has many points (virtual nodes) on a ring of 64-bit positions; a
row goes clockwise from its key's position to the next point's shard.  No
shard takes more than its bound, (1 + slack) times the mean load: what a full
shard cannot take continues clockwise to the next shards that have room.

All rows between two neighbouring points (an arc) pass the same shards in the
same order, so only the arcs' loads are needed to decide who overflows:
``plan_ring`` cuts each arc, by load, into stretches for its shards.  The
number of arcs is shards times virtual nodes, whatever the table's size.  Rows
are then dealt, by ranges of positions, to tasks of bounded size; a row's place
in its arc is the load before it, a prefix sum over (position, a spread of
equal keys), and the stretch that holds it names its shard.  Rows with
equal keys stay together as far as the bound allows: arcs are placed heavy
ones first, so a hot key's rows fill one shard, continue clockwise and end up
in as few shards as can hold them.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from xxhash import xxh64_intdigest

from assay.llm.common import materialize, range_bounds, sampled, task_count

#: Points per shard, and the share by which a shard's load may pass the mean.
VIRTUAL_NODES = 512
SLACK = 1 / 256
#: The low bits of a position spread the rows of one key (a hot key has many tasks' worth of rows).
SPREAD_BITS = 20
#: Rows and load (bytes, if sizes are) per task, rows per batch that a task returns.
TASK_ROWS, TASK_LOAD, OUT_ROWS = 1 << 18, 1 << 26, 10_000


@dataclass(frozen=True)
class Ring:
    """Points in ascending order, the shard of each, and the number of shards.  Arc i holds the positions
    from point i - 1 (exclusive) to point i; positions after the last point belong to arc 0."""

    points: np.ndarray
    owners: np.ndarray
    shards: int

    def arc(self, positions: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.points, positions, side="left") % len(self.points)


def make_ring(shards: int, virtual_nodes: int = VIRTUAL_NODES) -> Ring:
    """The points of ``shards`` shards: a shard's points depend on its number alone, so another shard adds
    its own points and moves none.  A point's spread bits are all set: equal keys share an arc."""
    low = (1 << SPREAD_BITS) - 1
    found = sorted(((xxh64_intdigest(f"{s}:{v}".encode(), 11) | low) - (1 << 63), s) for s in range(shards) for v in range(virtual_nodes))
    return Ring(np.array([p for p, _ in found], dtype=np.int64), np.array([s for _, s in found], dtype=np.int64), shards)


def plan_ring(ring: Ring, loads: np.ndarray, slack: float) -> list[list[tuple[int, int]]]:
    """Per arc its stretches, ``(end, shard)`` in order: the load up to ``end`` goes to that shard.

    Arcs go onto the ring one after the other, heavy arcs first (so that a hot key's rows fill few
    shards): each offers its load to its own shard, what is left of it to the next shard clockwise, and so
    on.  The bounds add up to at least the whole load, so every arc finds room.
    """
    total = int(loads.sum())
    room = [-(-int(total * (1 + slack) + 1) // ring.shards)] * ring.shards
    owners = ring.owners.tolist()
    out: list[list[tuple[int, int]]] = [[] for _ in owners]
    for arc in np.argsort(-loads, kind="stable").tolist():
        at, placed, load = arc, 0, int(loads[arc])
        while placed < load:
            shard = owners[at]
            if taken := min(load - placed, room[shard]):
                placed += taken
                room[shard] -= taken
                out[arc].append((placed, shard))
            at = (at + 1) % len(owners)
    return out


def _positioned(rows: DataFrame, key: Column, size: Column) -> DataFrame:
    """``_row, _size, _pos``: the packed columns, the load, and the position (the key's hash above, a
    spread over the rows of the key below)."""
    low = (1 << SPREAD_BITS) - 1
    position = F.xxhash64(F.lit("key"), key).bitwiseAND(F.lit(~low)).bitwiseOR(
        F.xxhash64(F.monotonically_increasing_id()).bitwiseAND(F.lit(low)))
    columns = [F.col(f"`{c.replace('`', '``')}`") for c in rows.columns]
    return rows.select(F.struct(*columns).alias("_row"), size.cast("long").alias("_size"), position.alias("_pos"))


def ring_shards(rows: DataFrame, key: Column, size: Column, shards: int, virtual_nodes: int = VIRTUAL_NODES,
                slack: float = SLACK) -> DataFrame:
    """``rows`` with ``shard`` (0 to ``shards`` - 1) and ``slot`` (each shard's rows, from 0 without gaps).

    ``key`` places a row on the ring, ``size`` (a positive integer) is its load.  Every shard's load is at
    most (1 + ``slack``) times the mean and at least (1 - (``shards`` - 1) ``slack``) times it, but for the
    rows that stand across the end of a stretch (one per stretch, each counted where it begins).

    Edge cases: null keys are one key; rows of one key stay together as far as the bound allows; repeated
    rows are placed each on its own; an empty table gives no rows.  Columns of the input called shard or
    slot are an error.
    """
    clash = sorted({"shard", "slot"} & {c.lower() for c in rows.columns})
    if clash or shards < 1:
        raise ValueError(f"columns with the names of results: {clash}" if clash else "shards must be at least 1")
    spark, ring = rows.sparkSession, make_ring(shards, virtual_nodes)
    placed = materialize(_positioned(rows, key, size), "ring-rows")  # the spread is drawn once
    count, load = placed.agg(F.count(F.lit(1)), F.coalesce(F.sum("_size"), F.lit(0))).first()
    parts = max(task_count(spark, count, TASK_ROWS), task_count(spark, load, TASK_LOAD))
    sample = np.array([tuple(r) for r in sampled(placed.select("_pos", "_size"), "_pos")[0].collect()], dtype=np.int64).reshape(-1, 2)
    bounds = range_bounds(sample[:, 0], sample[:, 1] + load / max(1, count), parts)  # even in rows and in load

    def locate(batches):
        for batch in batches:
            position = batch.column("_pos").to_numpy()
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.searchsorted(bounds, position, side="left").astype(np.int32)),
                                              pa.array(ring.arc(position).astype(np.int32))], [*batch.schema.names, "_part", "_arc"])

    located = placed.mapInArrow(locate, StructType([*placed.schema.fields]).add("_part", "integer").add("_arc", "integer"))
    sums = located.groupBy("_part", "_arc").agg(F.sum("_size").alias("load")).collect()  # at most parts + arcs rows
    loads, before = np.zeros(len(ring.points), dtype=np.int64), {}
    for r in sorted(sums, key=lambda r: r._part):
        before.setdefault(r._part, []).append((r._arc, int(loads[r._arc])))
        loads[r._arc] += r.load
    # All arcs end to end: a row goes to the shard of the stretch in which its load begins.
    base = np.cumsum(loads) - loads
    stretches = [(int(base[a]) + end, shard) for a, ends in enumerate(plan_ring(ring, loads, slack)) for end, shard in ends]
    ends, owners = np.array([e for e, _ in stretches], dtype=np.int64), np.array([s for _, s in stretches], dtype=np.int32)

    def assign(batches):
        batches = list(batches)
        if not sum(b.num_rows for b in batches):
            return
        table = pa.Table.from_batches(batches)
        part = int(table.column("_part")[0].as_py())
        arc, position, size = (table.column(c).to_numpy() for c in ("_arc", "_pos", "_size"))
        order = np.lexsort((position, arc))
        arc, size = arc[order], size[order]
        first = np.flatnonzero(np.diff(arc, prepend=-1))
        begins = dict(before[part])
        inside = np.cumsum(size) - size
        lengths = np.diff(np.append(first, len(arc)))
        start = inside - np.repeat(inside[first] - np.array([base[a] + begins[a] for a in arc[first].tolist()]), lengths)
        shard = owners[np.searchsorted(ends, start, side="right")]
        rank = np.empty(len(arc), dtype=np.int64)
        for s in np.unique(shard):
            own = np.flatnonzero(shard == s)
            rank[own] = np.arange(len(own))
        for a in range(0, len(order), OUT_ROWS):
            some = order[a:a + OUT_ROWS]
            yield pa.RecordBatch.from_arrays([table.column("_row").take(pa.array(some)).combine_chunks(), pa.array(np.full(len(some), part, dtype=np.int32)),
                                              pa.array(shard[a:a + OUT_ROWS]), pa.array(rank[a:a + OUT_ROWS])], ["_row", "_part", "_shard", "_rank"])

    out = StructType([placed.schema["_row"]]).add("_part", "integer").add("_shard", "integer").add("_rank", "long")
    assigned = materialize(located.repartitionById(parts, F.col("_part")).mapInArrow(assign, out), "ring-shards")
    counts = assigned.groupBy("_part", "_shard").agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy("_shard").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = materialize(counts.select("_part", "_shard", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_offset")), "ring-offsets")
    return assigned.join(offsets, ["_part", "_shard"]).select("_row.*", F.col("_shard").alias("shard"), (F.col("_rank") + F.col("_offset")).alias("slot"))


def shard_documents(docs: DataFrame, shards: int = 16) -> DataFrame:
    """Per row of ``docs`` (``doc_id, text``): ``doc_id, size`` (UTF-8 bytes plus one), ``text_crc32``,
    ``law``, ``shard``, ``slot`` and ``grown_shard`` (null: where a row goes depends on all loads).  The
    text is the key; a null text is the empty one."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select("doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"),
                       F.xxhash64(text).alias("key"))
    return ring_shards(rows, F.col("key"), F.col("size"), shards).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
