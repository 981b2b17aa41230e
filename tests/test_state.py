import math
import random
import struct
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from assay.functions.exact import exact_sum
from assay.operators.metrics import Metric, NamedMetric, compute_metrics
from assay.plans.report import check_report
from assay.state import TableState, state_report
from assay.state import store as store_module
from assay.state.frequency import added, counted, ddl_of, opened, write_bucketed

SCAN = [("size", (), None), ("size", (), "b > 1"), ("count", ("a",), None), ("min", ("a",), None), ("max", ("a",), "b < 9"), ("sum", ("a",), None),
        ("sum", ("b",), None), ("sum", ("d",), None), ("avg", ("a",), None), ("avg", ("b",), "c = 'x'"), ("stddev_pop", ("a",), None),
        ("stddev_pop", ("b",), None), ("min", ("c",), None), ("max", ("t",), None), ("sum", ("nothing",), None), ("min", ("nothing",), None)]
FREQUENCY = [(a, k, w) for a in ("distinct", "distinctness", "distinct_keep_nulls", "duplicate_groups", "duplicate_groups_keep_nulls")
             for k, w in ((("a",), None), (("c",), "b > 1"), (("a", "b", "c"), None), (("nothing",), None))]


def named(definitions):
    return [NamedMetric(a, ",".join(t), f"{i}", Metric(a, t, w)) for i, (a, t, w) in enumerate(definitions)]


def values(df):
    return {r.key: (None if r.value is None else struct.pack(">d", r.value), r.error) for r in df.collect()}


@pytest.fixture()
def table(spark):
    rng = random.Random(7)
    rows = [(rng.choice([None, rng.uniform(-1e6, 1e6), 0.1, -0.1, 1e15, 3e-9]), rng.choice([None, *range(12)]), rng.choice([None, "x", "10", "9", ""]),
             rng.uniform(0, 9), rng.randint(0, 3)) for _ in range(3000)]
    df = spark.createDataFrame(rows, "a double, b int, c string, d0 double, part int")
    return df.selectExpr("a", "b", "c", "CAST(d0 AS DECIMAL(12, 4)) AS d", "CAST(date_add(DATE '2024-01-01', coalesce(b, 0)) AS TIMESTAMP) AS t",
                         "CAST(NULL AS DOUBLE) AS nothing", "part")


def test_exact_sums_equal_the_true_sum_in_any_order(spark):
    rng = random.Random(3)
    xs = [rng.choice([1, -1]) * rng.uniform(1, 10) * 10.0 ** rng.randint(-8, 18) for _ in range(4000)] + [0.1] * 500 + [1e17, -1e17, -0.0]
    df = spark.createDataFrame([(x,) for x in xs + [None]], "x double")
    got = {struct.pack(">d", df.repartition(n).selectExpr(f"{exact_sum('x')} AS s").first().s) for n in (1, 8, 64)}
    true = float(sum(map(Fraction, xs)))
    assert len(got) == 1 and abs(struct.unpack(">d", got.pop())[0] - true) <= 8 * math.ulp(true)


@pytest.mark.parametrize("xs, want", [([], None), ([None], None), ([1e300, 1.0], 1e300), ([math.inf, 1.0], math.inf), ([1e-200, 1e-200], 2e-200),
                                      ([2.0**68, 0.5], 2.0**68 + 0.5), ([-2.5, 2.5], 0.0), ([2.0**67, 1.0, -(2.0**67)], 1.0)])
def test_exact_sums_at_the_ends_of_the_grid(spark, xs, want):
    got = spark.createDataFrame([(x,) for x in xs], "x double").selectExpr(f"{exact_sum('x')} AS s").first().s
    assert got == want


def test_exact_sum_of_nan_is_nan(spark):
    assert math.isnan(spark.createDataFrame([(math.nan,), (1.0,)], "x double").selectExpr(f"{exact_sum('x')} AS s").first().s)


def test_increments_equal_one_pass_bit_for_bit(spark, table, tmp_path):
    """Parts added one by one, in another order, and all at once; and the engine's own values."""
    metrics = named(SCAN + FREQUENCY)
    results = []
    for i, parts in enumerate(([[0], [1, 2], [3]], [[3], [2], [0, 1]], [[0, 1, 2, 3]])):
        state = TableState(spark, str(tmp_path / f"s{i}"), buckets=3)
        for p in parts:
            state.add(table.where(F.col("part").isin(p)), f"batch {p}", metrics)
            state.add(table.where(F.col("part").isin(p)), f"batch {p}", metrics)  # again: not counted twice
        results.append(values(state.metrics(metrics)))
    pivots = {k for k, m in ((nm.key, nm.metric) for nm in metrics) if m.agg == "stddev_pop"}  # measured from another value in each store
    exact = [{k: v for k, v in r.items() if k not in pivots} for r in results]
    assert exact[0] == exact[1] == exact[2]
    want = {r.key: r.value for r in compute_metrics(table, metrics).collect()}
    for r in results:
        for key, (packed, error) in r.items():
            got = None if packed is None else struct.unpack(">d", packed)[0]
            assert error is None and (got == want[key] if got is None or want[key] is None else math.isclose(got, want[key], rel_tol=1e-9)), key


def write(df, path, parts):
    df.where(F.col("part").isin(parts)).write.mode("append").partitionBy("part").parquet(path)


def test_refresh_reads_new_and_changed_folders_only(spark, table, tmp_path, monkeypatch):
    source, state = str(tmp_path / "t"), TableState(spark, str(tmp_path / "s"), buckets=3)
    metrics, seen = named(SCAN + FREQUENCY), []
    real = store_module.read_folders
    monkeypatch.setattr(store_module, "read_folders", lambda s, fs, *rest: seen.extend(f.name.rsplit("=", 1)[1] for f in fs) or real(s, fs, *rest))

    def agrees(parts):
        want = {r.key: r.value for r in compute_metrics(spark.read.parquet(source), metrics).collect()}
        got = {r.key: r.value for r in state.metrics(metrics).collect()}
        assert {k for k in want if got[k] != want[k] and not math.isclose(got[k], want[k], rel_tol=1e-9)} == set()
        found, seen[:] = set(seen), []
        assert found == parts

    write(table, source, [0, 1])
    assert len(state.refresh(source, metrics).read) == 2
    agrees({"0", "1"})
    write(table, source, [2])
    update = state.refresh(source, metrics)
    assert [len(update.read), len(update.kept), update.gone] == [1, 2, []]
    agrees({"2"})
    assert state.refresh(source, metrics).read == []
    agrees(set())
    more = named([*SCAN, ("max", ("d",), None)])[-1:]  # a new definition: all folders, for it alone
    assert len(state.refresh(source, metrics + more).read) == 3
    seen.clear()
    table.where("part = 1").limit(100).write.mode("overwrite").parquet(f"{source}/part=1")
    assert [f.rsplit("=", 1)[1] for f in TableState(spark, str(tmp_path / "scan-only")).refresh(source, named(SCAN)).read] == ["0", "1", "2"]
    seen.clear()
    update = state.refresh(source, named(SCAN))  # scan states: the changed folder alone
    assert [f.rsplit("=", 1)[1] for f in update.read] == ["1"]
    assert len(state.refresh(source, metrics).read) == 3  # frequencies: a changed folder means counting anew
    seen.clear()
    agrees(set())


def test_a_folder_that_goes_is_forgotten(spark, table, tmp_path):
    import shutil

    source, state, metrics = str(tmp_path / "t"), TableState(spark, str(tmp_path / "s"), buckets=3), named(SCAN + FREQUENCY)
    write(table, source, [0, 1])
    state.refresh(source, metrics)
    shutil.rmtree(f"{source}/part=1")
    update = state.refresh(source, metrics)
    assert len(update.gone) == 1
    want = {r.key: r.value for r in compute_metrics(spark.read.parquet(source), metrics).collect()}
    got = {r.key: r.value for r in state.metrics(metrics).collect()}
    assert all(got[k] == want[k] or math.isclose(got[k], want[k], rel_tol=1e-9) for k in want)


def test_merging_never_shuffles_the_old_table(spark, table, tmp_path):
    new = counted(table, ("a", "c"), None)
    write_bucketed(added(None, new, 4), str(tmp_path / "old"), 4)
    with opened(spark, str(tmp_path / "old"), ddl_of(new), 4) as old:
        merged = added(old, counted(table.where("part = 1"), ("a", "c"), None), 4)
        plan = merged._jdf.queryExecution().executedPlan().toString()
        lines = plan.splitlines()
        scan = next(i for i, line in enumerate(lines) if "Bucketed: true" in line)
        depth = lines[scan].index("FileScan")
        above = [line for line in lines[:scan] if len(line) - len(line.lstrip(" :+-")) < depth]
        assert not any("Exchange" in line for line in above), plan
        assert merged.agg(F.sum("_n")).first()[0] == table.count() + table.where("part = 1").count()


def test_an_update_that_breaks_off_leaves_the_old_state(spark, table, tmp_path, monkeypatch):
    metrics = named(SCAN[:6] + FREQUENCY[:4])
    state = TableState(spark, str(tmp_path / "s"), buckets=3)
    state.add(table.where("part = 0"), "one", metrics)
    before = values(state.metrics(metrics))
    monkeypatch.setattr(TableState, "_commit", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        state.add(table.where("part = 1"), "two", metrics)
    monkeypatch.undo()
    (tmp_path / "s" / "manifest" / "2").mkdir()  # a manifest without _SUCCESS
    assert values(state.metrics(metrics)) == before
    state.add(table.where("part = 1"), "two", metrics)
    after = values(state.metrics(metrics))
    assert after != before
    state.vacuum()
    assert values(state.metrics(metrics)) == after
    assert len(list((tmp_path / "s" / "scan").glob("run=*"))) == 2 and len(list((tmp_path / "s" / "manifest").iterdir())) == 2


def test_empty_batches_failed_and_unknown_definitions(spark, table, tmp_path):
    state = TableState(spark, str(tmp_path / "s"), buckets=3)
    odd = named([("size", (), None), ("sum", ("a",), None), ("distinct", ("a",), None), ("sum", ("absent",), None), ("aggregate", ("max(a)",), None),
                 ("distinct", ("map('k', a)",), None)])
    state.add(table.where("part > 9"), "empty", odd)
    got = {r.key: (r.value, r.error) for r in state.metrics(odd).collect()}
    assert got["0"] == (0.0, None) and got["1"] == (None, None) and got["2"] == (0.0, None)
    assert "absent" in got["3"][1] and "merged" in got["4"][1] and "type" in got["5"][1]
    unknown = state.metrics(named([("min", ("b",), None), ("distinct", ("b",), None)])).collect()
    assert {r.error for r in unknown} == {"no state"}


def test_state_report_equals_the_full_report(spark, table, tmp_path):
    source, state = str(tmp_path / "t"), str(tmp_path / "s")
    write(table, source, [0, 1, 2])
    state_report(spark, source, state, as_of="2024-02-01", buckets=3)
    write(table, source, [3])
    config = {"metrics": [{"metricName": "own", "metricType": "Dataset", "aggFunction": "count", "columnExpr": "a", "condition": "t < current_date()"}],
              "checks": [{"checkName": "own", "expression": "own", "operator": ">", "threshold": 0}]}
    for as_of in ("2024-02-01", "2030-01-01"):  # freshness moves with the date, from the same state
        got = state_report(spark, source, state, as_of=as_of, buckets=3)
        want = check_report(spark.read.parquet(source), as_of=as_of)
        assert sorted(map(tuple, got.verdicts.collect())) == sorted(map(tuple, want.verdicts.collect()))
        assert sorted(map(tuple, got.aligned.collect())) == sorted(map(tuple, want.aligned.collect()))
        assert len(got.update.read) == (1 if as_of == "2024-02-01" else 0)
    own = state_report(spark, source, state, strategies=("expression",), expression_config=config, buckets=3)
    assert own.verdicts.first().status and own.update.read == []  # a text that depends on the day is never kept


def test_a_state_that_lacks_folders_says_so(spark, table, tmp_path):
    """A definition that was not asked for when a folder came has no value until it is refreshed."""
    source, state = str(tmp_path / "t"), TableState(spark, str(tmp_path / "s"), buckets=2)
    first, late = named([("size", (), None), ("distinct", ("b",), None)]), named([("max", ("b",), None), ("distinct", ("c",), None)])
    late = [NamedMetric(nm.name, nm.column, f"late {nm.key}", nm.metric) for nm in late]
    write(table, source, [0])
    state.refresh(source, first + late)
    write(table, source, [1])
    state.refresh(source, first)
    got = {r.key: (r.value, r.error) for r in state.metrics(first + late).collect()}
    assert got["0"][1] is None and got["1"][1] is None and all("lacks 1 of 2" in got[k][1] and got[k][0] is None for k in ("late 0", "late 1"))
    state.refresh(source, late)
    assert {r.error for r in state.metrics(first + late).collect()} == {None}
