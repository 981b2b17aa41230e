import __spark_entry__ as E


def test_parts_stay_bounded_and_differ():
    """One part held every row, whatever the table's size."""
    for rows in (0, 1, 600_572, 3_000_000, 36_000_000, 216_000_000, 10**10):
        parts = E._part_counts(rows)
        assert len(set(parts)) == 3 and min(parts) >= 1
        assert rows / min(parts) <= E.ROWS_PER_PART
    assert E._part_counts(600_572) == (1, 8, 64)


def test_query_deals_a_larger_table_into_more_parts(spark, tmp_path, monkeypatch):
    rows = [(i, i % 7, 0.1 * i, 0.01 * (i % 5), 0.02) for i in range(1000)]
    spark.createDataFrame(rows, "l_orderkey long, l_linenumber int, l_extendedprice double, l_discount double, l_tax double").write.parquet(
        f"{tmp_path}/lineitem.parquet")
    monkeypatch.setattr(E, "ROWS_PER_PART", 100)
    found = E.q_order_independent_sums(spark, str(tmp_path))
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert all(f"RepartitionByExpression [l_orderkey" in line and line.rstrip().endswith(f", {n}")
               for line, n in zip([x for x in plan.splitlines() if "RepartitionByExpression" in x], (11, 22, 64), strict=True))
    assert {r.n_values for r in found.collect()} == {1}
