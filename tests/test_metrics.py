"""The fused metric engine: semantics of each aggregate, de-duplication, batching, errors."""

import pytest

from assay.operators.metrics import Metric, NamedMetric, compute_metrics


def values(metrics_df):
    return {r["key"]: r["value"] for r in metrics_df.collect()}


def errors(metrics_df):
    return {r["key"]: r["error"] for r in metrics_df.collect()}


def test_scan_metrics_with_filters(frame):
    df = frame([(1, 2.0), (2, None), (3, 4.0), (None, 0.0)], "a int, b double")
    m = values(compute_metrics(df, [
        NamedMetric("rows", "*", "rows", Metric("size")),
        NamedMetric("big", "a", "big", Metric("size", where="a > 1")),
        NamedMetric("cnt", "b", "cnt", Metric("count", ("b",))),
        NamedMetric("min", "b", "min", Metric("min", ("b",), "a IS NOT NULL")),
        NamedMetric("max", "b", "max", Metric("max", ("b",))),
        NamedMetric("sum", "a", "sum", Metric("sum", ("a",))),
        NamedMetric("avg", "a", "avg", Metric("avg", ("a",))),
        NamedMetric("sd", "a", "sd", Metric("stddev_pop", ("a",))),
        NamedMetric("agg", "a", "agg", Metric("aggregate", ("max(a) - min(a)",))),
    ]))
    assert m == {"rows": 4, "big": 2, "cnt": 3, "min": 2.0, "max": 4.0, "sum": 6, "avg": 2.0,
                 "sd": (2 / 3) ** 0.5, "agg": 2}


def test_frequency_null_policies(frame):
    # one value plus nulls
    df = frame([("x",), ("x",), (None,), (None,)], "c string")
    m = values(compute_metrics(df, [
        NamedMetric("d", "c", "d", Metric("distinct", ("c",))),
        NamedMetric("k", "c", "k", Metric("distinct_keep_nulls", ("c",))),
        NamedMetric("n", "c", "n", Metric("distinctness", ("c",))),
        NamedMetric("g", "c", "g", Metric("duplicate_groups", ("c",))),
        NamedMetric("gk", "c", "gk", Metric("duplicate_groups_keep_nulls", ("c",))),
    ]))
    assert m == {"d": 1, "k": 2, "n": 1, "g": 1, "gk": 2}


def test_multi_column_drops_only_all_null_rows(frame):
    df = frame([(1, None), (None, 2), (None, None), (None, None), (1, None)], "a int, b int")
    m = values(compute_metrics(df, [
        NamedMetric("d", "a,b", "d", Metric("distinct", ("a", "b"))),
        NamedMetric("k", "a,b", "k", Metric("distinct_keep_nulls", ("a", "b"))),
        NamedMetric("gk", "a,b", "gk", Metric("duplicate_groups_keep_nulls", ("a", "b"))),
    ]))
    assert m == {"d": 2, "k": 3, "gk": 2}


def test_empty_input_count_like_zero_others_null(frame):
    df = frame([], "a int")
    m = values(compute_metrics(df, [
        NamedMetric("rows", "*", "rows", Metric("size")),
        NamedMetric("cnt", "a", "cnt", Metric("count", ("a",))),
        NamedMetric("min", "a", "min", Metric("min", ("a",))),
        NamedMetric("sd", "a", "sd", Metric("stddev_pop", ("a",))),
        NamedMetric("d", "a", "d", Metric("distinct", ("a",))),
        NamedMetric("n", "a", "n", Metric("distinctness", ("a",))),
    ]))
    assert m == {"rows": 0, "cnt": 0, "min": None, "sd": None, "d": 0, "n": None}


def test_same_definition_computed_once(frame):
    df = frame([(1,), (2,)], "a int")
    named = [NamedMetric(f"r{i}", "*", f"r{i}", Metric("size")) for i in range(5)]
    m = compute_metrics(df, named)
    assert values(m) == {f"r{i}": 2 for i in range(5)}
    plan = m._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("count(1)") == 1


def test_batching_gives_same_answer(frame):
    df = frame([(i, i * 1.5) for i in range(20)], "a int, b double")
    named = [NamedMetric(f"{agg}_{c}", c, f"{agg}_{c}", Metric(agg, (c,)))
             for agg in ("min", "max", "sum", "avg") for c in ("a", "b")]
    assert values(compute_metrics(df, named, max_metrics_per_pass=3)) == values(compute_metrics(df, named))


def test_bad_definitions_are_isolated(frame):
    df = frame([(1, "x")], "a int, s string")
    m = compute_metrics(df, [
        NamedMetric("ok", "a", "ok", Metric("max", ("a",))),
        NamedMetric("missing", "zz", "missing", Metric("max", ("zz",))),
        NamedMetric("badtype", "s", "badtype", Metric("sum", ("map(1, s)",))),
        NamedMetric("badgroup", "zz", "badgroup", Metric("distinct", ("zz",))),
    ])
    v, e = values(m), errors(m)
    assert v["ok"] == 1 and e["ok"] is None
    for k in ("missing", "badtype", "badgroup"):
        assert v[k] is None and e[k]


def test_duplicate_column_names_metric(spark, frame):
    a = frame([(1, 2)], "k int, x int")
    b = frame([(1, 3)], "k int, y int")
    joined = a.join(b, a["k"] == b["k"])
    m = values(compute_metrics(joined, [NamedMetric("dup", "*", "dup", Metric("duplicate_columns"))]))
    assert m == {"dup": 1}
    assert values(compute_metrics(a, [NamedMetric("dup", "*", "dup", Metric("duplicate_columns"))])) == {"dup": 0}


def test_runtime_errors_isolated_eagerly(frame):
    from assay.operators.metrics import compute_metrics_isolated

    df = frame([("1",), ("x",)], "s string")
    named = [NamedMetric("rows", "*", "rows", Metric("size")),
             NamedMetric("bad", "s", "bad", Metric("aggregate", ("sum(CAST(s AS INT))",))),
             NamedMetric("len", "s", "len", Metric("max", ("length(s)",)))]
    m = compute_metrics_isolated(df, named)
    v, e = values(m), errors(m)
    assert v["rows"] == 2 and v["len"] == 1 and e["rows"] is None
    assert v["bad"] is None and e["bad"]


def test_runtime_error_isolation_in_checks(frame):
    from assay.plans.expression_checks import run_expression_checks

    df = frame([("1",), ("x",)], "s string")
    cfg = {"metrics": [{"metricName": "rows", "definitionName": "count rows", "metricType": "Dataset"},
                       {"metricName": "total", "aggFunction": "sum", "columnExpr": "CAST(s AS INT)",
                        "metricType": "Dataset"}],
           "checks": [{"checkName": "rows", "expression": "rows", "operator": ">", "threshold": 0, "types": []},
                      {"checkName": "total", "expression": "total", "operator": ">", "threshold": 0, "types": []}]}
    v = {r["checkName"]: r for r in run_expression_checks(df, cfg, isolate_runtime_errors=True).collect()}
    assert v["rows"]["status"] is True
    assert v["total"]["status"] is False


def _row_metrics(cols):
    keys = tuple(f"`{c}`" for c in cols)
    return [NamedMetric(agg, "*", agg, Metric(agg, keys)) for agg in
            ("distinct", "distinctness", "distinct_keep_nulls", "duplicate_groups", "duplicate_groups_keep_nulls")]


def grouped_by_values(df):
    from assay.operators.metrics import _frequency_counters

    return _frequency_counters(df, tuple(f"`{c}`" for c in df.columns), None).collect()[0].asDict()


def test_row_counters_are_exact(frame, monkeypatch):
    import assay.operators.metrics as M

    rows = ([(1, "a", 1.0)] * 5 + [(2, "b", None)] * 2 + [(None, None, None)] * 3 + [(7, "z", 0.0), (7, "z", -0.0)]
            + [(8, "n", float("nan"))] * 2 + [(i, f"u{i}", float(i)) for i in range(10, 40)])
    df = frame(rows, "a int, b string, c double")
    direct = grouped_by_values(df)
    assert values(compute_metrics(df, _row_metrics(df.columns))) == direct
    monkeypatch.setattr(M, "HOT_GROUPS", 1)  # the others go by the shuffle
    assert values(compute_metrics(df, _row_metrics(df.columns))) == direct
    # a weak hash makes many different rows collide: still exact
    monkeypatch.setattr(M, "_row_hashes", lambda parts: ("length(CAST(_k0 AS STRING))", "1"))
    empty = df.where("a > 1000")
    assert values(compute_metrics(empty, _row_metrics(df.columns))) == {
        "distinct": 0, "distinctness": None, "distinct_keep_nulls": 0, "duplicate_groups": 0,
        "duplicate_groups_keep_nulls": 0}


def test_row_counters_with_collated_and_map_columns(spark, frame):
    collated = spark.sql("SELECT * FROM VALUES ('a', 1), ('A', 1), ('b', 2), (NULL, NULL) t(s, i)").selectExpr(
        "s COLLATE UTF8_LCASE AS s", "i")
    got = values(compute_metrics(collated, _row_metrics(collated.columns)))
    assert got == grouped_by_values(collated) == {"distinct": 2, "distinctness": 2, "distinct_keep_nulls": 3,
                                                  "duplicate_groups": 1, "duplicate_groups_keep_nulls": 1}
    maps = spark.sql("SELECT * FROM VALUES (map('x', 1, 'y', 2), 1), (map('y', 2, 'x', 1), 1), (map('x', 2), 1) t(m, i)")
    assert values(compute_metrics(maps, _row_metrics(maps.columns))) == grouped_by_values(maps)
    nested = collated.selectExpr("array(s) AS a", "named_struct('i', i) AS st")
    assert values(compute_metrics(nested, _row_metrics(nested.columns))) == grouped_by_values(nested)


def test_one_row_holding_half_the_table(spark):
    """Its copies are picked out by a broadcast and meet only after partial aggregation."""
    df = spark.range(4000).selectExpr("IF(id % 2 = 0, 0, id) AS a", "IF(id % 2 = 0, 'hot', CAST(id AS STRING)) AS b")
    m = compute_metrics(df, _row_metrics(df.columns))
    assert values(m)["duplicate_groups_keep_nulls"] == 1 and values(m)["distinct_keep_nulls"] == 2001
    plan = m._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "CartesianProduct" not in plan


def test_errors_keep_their_whole_text(frame):
    df = frame([("x",)], "s string")
    named = [NamedMetric("bad", "s", "bad", Metric("aggregate", ("max(" + "no_such_column_" * 60 + ")",)))]
    assert len(compute_metrics(df, named).collect()[0]["error"]) > 800


def test_only_data_errors_are_isolated(frame, monkeypatch):
    import assay.operators.metrics as M

    df = frame([("x",), ("1",)], "s string")
    named = [NamedMetric("ok", "s", "ok", Metric("size")),
             NamedMetric("bad", "s", "bad", Metric("aggregate", ("max(CAST(s AS INT))",)))]
    got = {r["key"]: r for r in M.compute_metrics_isolated(df, named).collect()}
    assert got["ok"]["value"] == 2 and "CAST_INVALID_INPUT" in got["bad"]["error"]

    def lost(*_, **__):
        raise RuntimeError("executor lost")

    monkeypatch.setattr(M, "compute_metrics", lost)
    with pytest.raises(RuntimeError, match="executor lost"):
        M.compute_metrics_isolated(df, named)
