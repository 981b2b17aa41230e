from assay.llm.line_dedup import line_dedup


def test_short_lines_are_counted_on_request(spark, rows):
    docs = [(i, f"Les.\n\nown text {i}", f"s{i}") for i in range(1, 7)]
    df = spark.createDataFrame(docs, "doc_id long, text string, source string")
    got = rows(line_dedup(df, min_chars=1), "doc_id", "text", "n_removed")
    assert got == [(1, docs[0][1], 0), *[(i, f"\nown text {i}", 1) for i in range(2, 7)]]


def test_short_lines_need_a_wider_spread(spark, rows):
    """Fifteen sites and texts take a short line; fourteen sites, or copies of few texts, leave it."""
    docs = [(i, f"Wide.\nown text number {i}", f"s{i % 15}") for i in range(1, 31)]
    docs += [(100 + i, f"Less.\nown text number {100 + i}", f"s{i % 14}") for i in range(1, 31)]
    docs += [(200 + i, f"Copy.\ntext {i % 9}", f"s{i}") for i in range(1, 31)]
    df = spark.createDataFrame(docs, "doc_id long, text string, source string")
    got = {r[0]: r[1] for r in rows(line_dedup(df), "doc_id", "text")}
    assert [i for i, t, _ in docs if not got[i].startswith(t.split("\n")[0])] == list(range(2, 31))
    assert all(got[i].startswith("Wide.") for i in (1,)) and got[2] == "own text number 2"
