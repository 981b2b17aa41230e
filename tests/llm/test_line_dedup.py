from assay.llm.line_dedup import line_dedup, line_dedup_sql


def brute(docs, min_sites=5, min_chars=15):
    sites, texts, first = {}, {}, {}
    for i, text, site in docs:
        for line in (text.split("\n") if text is not None else []):
            line = line.strip(" \t\r")
            if len(line) >= min_chars:
                sites.setdefault(line, set()).update([] if site is None else [site])
                texts.setdefault(line, set()).add(text)
                first[line] = min([x for x in (first.get(line), i) if x is not None], default=None)
    bad = {x for x in sites if len(sites[x]) >= min_sites and len(texts[x]) >= min_sites}
    out = []
    for i, text, site in docs:
        lines = text.split("\n") if text is not None else []
        kept = [x for x in lines if x.strip(" \t\r") not in bad or first[x.strip(" \t\r")] == i]
        out.append((i, None if text is None else "\n".join(kept), len(lines), len(lines) - len(kept)))
    return sorted(out, key=repr)


def check(df, rows):
    docs = [tuple(r) for r in df.select("doc_id", "text", "source").collect()]
    got = rows(line_dedup(df).select("doc_id", "text", "n_lines", "n_removed"))
    assert got == brute(docs)
    return got


def test_documents(table, rows):
    assert any(r[3] for r in check(table("documents"), rows))


def test_edge_cases(spark, rows):
    line = "a line that stands on many sites"
    docs = [(i, f"own text number {i} is here\n {line}\t\r\nshort\n\n{line}", f"s{i % 7}") for i in range(20, 40)]
    docs += [(100 + i, "one document copied\nto many sites and hosts", f"s{i}") for i in range(9)]  # copies: one text
    docs += [(200 + i, f"near the threshold {'x' * (i // 4)}\nexactly five sites hold this", f"s{i}") for i in range(5)]
    docs += [(210 + i, f"{i}\nfive texts, but only four sites", f"s{i % 4}") for i in range(5)]
    docs += [(None, line, "s1"), (None, None, None), (3, None, "s1"), (4, "", None), (5, line, None), (5, line, None),
             (6, "x" * 300_000 + "\n" + line, "s2"), (20, docs[0][1], "s9")]
    df = spark.createDataFrame(docs, "doc_id long, text string, source string")
    got = check(df.selectExpr("*", "'x' AS N_LINES", "1 AS _h1", "2 AS _gone", "3 AS lang"), rows)
    assert any(r[3] == 2 for r in got)
    assert line_dedup(df.limit(0)).count() == 0


def test_repeated_line_of_one_keeper_stays(spark, rows):
    line = "a passage found on every site"
    docs = [(i, f"{line}\n{i}" + (f"\n{line}" if i == 1 else ""), f"s{i}") for i in range(1, 8)]
    df = spark.createDataFrame(docs, "doc_id long, text string, source string")
    got = rows(line_dedup(df).select("doc_id", "text", "n_lines", "n_removed"))
    assert got[0] == (1, f"{line}\n1\n{line}", 3, 0) and got[1] == (2, "2", 2, 1)


def test_sql_is_exact():
    assert "count(DISTINCT source) >= 5" in line_dedup_sql()
