"""Cross-site boilerplate removal by distinct-site spread (DataFrame functions only).

A line is boilerplate if it stands in documents of at least ``min_sites``
distinct sites and of at least ``min_sites`` distinct texts (so copies of one
document, wherever they lie, do not make its lines boilerplate).  Lines under
``min_chars`` characters, which sites share by chance sooner, must reach
``short_sites`` of both.  Spread is
estimated by HyperLogLog sketches per line hash, which merge in the
aggregation; lines whose estimate is near the threshold get exact distinct
counts.  The document with the smallest id keeps a boilerplate line, every
other document loses it, so no passage vanishes from the corpus.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assay.llm.common import join_counted, materialize, packed


def line_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", site_col: str = "source",
               min_sites: int = 5, min_chars: int = 15, short_sites: int = 15, margin: float = 0.25) -> DataFrame:
    """``docs`` with boilerplate lines removed from ``text_col``, plus ``n_lines`` and ``n_removed`` (long).

    Lines are separated by ``\\n`` and compared without blanks, tabs and
    carriage returns around them; blank lines are never removed.  Estimates within ``margin`` of the
    threshold are recounted exactly (the sketches' error is under 2 %).

    Edge cases: a null text has no lines and stays null; an empty text has one
    blank line; a null site counts as no site; among equal lines the smallest
    non-null id keeps the line (null ids keep it only if all ids are null);
    rows repeating that id all keep it, as do further occurrences inside such
    a row; an empty table gives an empty table; input columns called
    ``n_lines`` or ``n_removed`` are replaced.
    """
    rows = packed(docs)
    text, ident, site = (F.col("_row").getField(c) for c in (text_col, id_col, site_col))
    rows = rows.select("_row", ident.alias("_id"), F.xxhash64(text).alias("_th"), text.alias("_text"), site.alias("_site"))
    lines = (rows.select("_id", "_th", "_site", F.posexplode(F.split("_text", "\n", -1)).alias("_pos", "_line"))
             .withColumn("_line", F.expr("btrim(_line, ' \t\r')"))
             .where(F.char_length("_line") >= 1)
             .select("_id", "_th", "_site", "_pos", F.xxhash64("_line").alias("_h1"),
                     F.xxhash64(F.lit("second"), "_line").alias("_h2"),
                     F.when(F.char_length("_line") >= min_chars, min_sites).otherwise(short_sites).alias("_wanted")))
    lines = materialize(lines, "lines")
    key, wanted = ["_h1", "_h2", "_wanted"], F.col("_wanted")
    spread = (lines.groupBy(*key)
              .agg(F.count(F.lit(1)).alias("_n"), F.min("_id").alias("_first"),
                   F.hll_sketch_estimate(F.hll_sketch_agg("_site")).alias("_sites"),
                   F.hll_sketch_estimate(F.hll_sketch_agg("_th")).alias("_texts"))
              .where(F.col("_n") >= wanted)
              .withColumn("_least", F.least("_sites", "_texts"))
              .where(F.col("_least") >= wanted * (1 - margin)))
    spread = materialize(spread, "spread")
    sure = F.col("_least") > wanted * (1 + margin)
    near = spread.where(~sure).select(*key)
    exact = lines.join(near, key, "left_semi")
    counted = (exact.groupBy(*key).agg(F.count_distinct("_site").alias("_s"), F.count_distinct("_th").alias("_t"))
               .where((F.col("_s") >= wanted) & (F.col("_t") >= wanted)).select(*key))
    boilerplate = spread.where(sure).select(*key, "_n", "_first").unionByName(
        spread.join(counted, key, "left_semi").select(*key, "_n", "_first"))
    removal = join_counted(lines, materialize(boilerplate, "boilerplate"), key, "_n", lines.count())
    removal = (removal.where(~F.col("_id").eqNullSafe(F.col("_first")))
               .groupBy(F.col("_id").alias("_rid"), F.col("_th").alias("_rth"))
               .agg(F.collect_set("_pos").alias("_gone")))
    joined = rows.join(removal, F.col("_id").eqNullSafe(F.col("_rid")) & (F.col("_th") == F.col("_rth")), "left")
    kept = F.expr("array_join(filter(split(_text, '\n', -1), (l, i) -> NOT array_contains(_gone, i)), '\n')")
    new_text = F.when(F.col("_gone").isNull(), F.col("_text")).otherwise(kept)
    zero = F.lit(0).cast("long")
    made = {"n_lines": F.when(F.col("_text").isNull(), zero).otherwise(F.size(F.split("_text", "\n", -1)).cast("long")),
            "n_removed": F.when(F.col("_gone").isNull(), zero).otherwise(F.size("_gone").cast("long"))}
    own = [c for c in docs.columns if c.lower() not in ("n_lines", "n_removed")]
    return joined.select(*[new_text.alias(c) if c == text_col else F.col("_row").getField(c).alias(c) for c in own],
                         *[e.alias(c) for c, e in made.items()])


def line_dedup_sql(min_sites: int = 5, min_chars: int = 15, short_sites: int = 15) -> str:
    """The same rows in DuckDB SQL, by exact counts."""
    short = f" AND (length(line) >= {min_chars} OR count(DISTINCT source) >= {short_sites} AND count(DISTINCT text) >= {short_sites})"
    return f"""
WITH lines AS (
  SELECT doc_id, text, source, unnest(range(len(string_split(text, chr(10))))) AS pos,
         trim(unnest(string_split(text, chr(10))), ' ' || chr(9) || chr(13)) AS line
  FROM documents),
boilerplate AS (
  SELECT line, min(doc_id) AS first_doc FROM lines WHERE line <> ''
  GROUP BY line HAVING count(DISTINCT source) >= {min_sites} AND count(DISTINCT text) >= {min_sites}{short}),
gone AS (
  SELECT doc_id, text, list(DISTINCT pos) AS gone FROM lines JOIN boilerplate USING (line)
  WHERE doc_id IS DISTINCT FROM first_doc GROUP BY doc_id, text)
SELECT d.doc_id,
       CASE WHEN g.gone IS NULL THEN d.text ELSE coalesce(array_to_string(list_transform(list_filter(
         range(len(string_split(d.text, chr(10)))), lambda i: NOT list_contains(g.gone, i)),
         lambda i: string_split(d.text, chr(10))[i + 1]), chr(10)), '') END AS text,
       CAST(coalesce(len(string_split(d.text, chr(10))), 0) AS BIGINT) AS n_lines,
       CAST(coalesce(len(g.gone), 0) AS BIGINT) AS n_removed
FROM documents d LEFT JOIN gone g ON d.doc_id IS NOT DISTINCT FROM g.doc_id AND d.text = g.text"""
