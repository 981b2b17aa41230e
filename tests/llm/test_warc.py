import base64
import hashlib

import zstandard

from assay.llm.common import scratch
from assay.llm.warc import fetch_records, read_archive, seek_table, write_archive


def expected(pages):
    best = {}
    for i, _, html in pages:
        if i is not None:
            best[html or ""] = max(best.get(html or "", i), i)
    out = []
    for i, url, html in pages:
        data = (html or "").encode()
        revisit = best.get(html or "") != i
        out.append((i, url, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(),
                    "revisit" if revisit else "response", best[html or ""] if revisit else None, None if revisit else data))
    return sorted(out, key=repr)


def roundtrip(spark, df, pages, rows, **options):
    path = scratch(spark, "warc")
    index = write_archive(df, path, **options)
    assert rows(read_archive(spark, path)) == expected(pages)
    return path, index


def test_pages_round_trip_and_random_access(spark, table, rows):
    df = table("pages")
    pages = [tuple(r) for r in df.select("page_id", "url", "html").collect()]
    path, index = roundtrip(spark, df, pages, rows, frame_bytes=5000, bundle_bytes=200_000)
    wanted = df.where("page_id % 7 = 0").select("page_id")
    ids = {r.page_id for r in wanted.collect()}
    assert rows(fetch_records(index, path, wanted)) == [r for r in expected(pages) if r[0] in ids]


def test_edge_cases(spark, rows):
    pages = [(1, "http://a/\r\nX: y%", "same"), (2, None, "same"), (3, "u", None), (4, "u", ""), (None, "n", "same"),
             (None, "n", "alone"), (5, "é", "é" * 1000), (2, "again", "same"), (6, "big", "z\r\n\r\n" * 200_000)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").selectExpr("*", "1 AS sha", "2 AS best")
    path, _ = roundtrip(spark, df, pages, rows)
    files = spark.read.format("binaryFile").load(path).collect()
    for f in files:  # every frame stands alone, and a plain decoder reads the whole bundle too
        data, plain = bytes(f.content), zstandard.ZstdDecompressor()
        parts = [plain.decompress(data[s:s + c], max_output_size=n) for s, c, n in seek_table(data)]
        whole = plain.stream_reader(data, read_across_frames=True).read()
        assert whole == b"".join(parts)


def test_empty_table(spark, rows):
    df = spark.createDataFrame([], "page_id long, url string, html string")
    path = scratch(spark, "warc")
    assert write_archive(df, path).count() == 0
    assert read_archive(spark, path).count() == 0
