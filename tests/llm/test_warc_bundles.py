import hashlib
import io

import zstandard
from pyspark.sql import functions as F

from savora.llm import warc_bundles as wb

PAGES = "page_id long, url string, html string"


def written(spark, rows, tmp_path, **options):
    pages = spark.createDataFrame(rows, PAGES).withColumn("row", F.lit("clash")).withColumn("digest", F.lit(1))
    index, folder = wb.archive(pages, str(tmp_path / "warc"), **options)
    return index, folder, wb.read_records(index, folder).collect()


def test_round_trip_with_revisits(spark, tmp_path):
    same, short = "x" * 100, "y" * 99
    rows = [(1, "http://a", same), (2, "http://b", same), (3, None, short), (4, "u\r\nv", short), (5, "é", None), (6, "", ""), (7, "w", "é" * 60), (8, "w", "é" * 60),
            (9, "http://long", "z" * 700_000), (None, "n", same), (1, "again", same)]
    _, _, records = written(spark, rows, tmp_path)
    assert len(records) == len(rows)
    by_id = {}
    for r in records:
        by_id.setdefault(r["page_id"], []).append(r)
    for page_id, url, html in rows:
        raw = (html or "").encode()
        for r in by_id[page_id]:
            assert (r["payload_bytes"], r["payload_digest"]) == (len(raw), hashlib.sha256(raw).hexdigest())
            if r["record_type"] == "response":
                assert bytes(r["payload"]) == raw
    refers = {k: sorted((r["record_type"], r["refers_to"]) for r in v) for k, v in by_id.items()}
    assert refers[1] == [("response", None)] * 2 and refers[2] == [("revisit", 1)] and refers[None] == [("revisit", 1)]
    assert refers[3] == refers[4] == refers[5] == refers[6] == refers[7] == [("response", None)] and refers[8] == [("revisit", 7)]


def test_bundles_are_plain_zstandard_with_a_seek_table(spark, tmp_path):
    rows = [(i, f"http://h/{i}", f"page {i} " * 40) for i in range(200)]
    index, folder, records = written(spark, rows, tmp_path, frame_bytes=2000, bundle_bytes=20_000)
    assert sorted(r["page_id"] for r in records) == list(range(200))
    held = [r.asDict() for r in index.collect()]
    assert max(r["frame"] for r in held) > 1
    for name in {r["bundle"] for r in held}:
        raw = (tmp_path / "warc" / name).read_bytes()
        whole = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(raw), read_across_frames=True).read()
        frames = wb.read_seek_table(io.BytesIO(raw), len(raw))
        parts = [zstandard.ZstdDecompressor().decompress(raw[a:a + n]) for a, n in frames]
        assert b"".join(parts) == whole
        for r in (r for r in held if r["bundle"] == name):
            record = wb.from_record(parts[r["frame"]][r["offset"]:r["offset"] + r["length"]])
            assert record["page_id"] == r["page_id"]
    assert not list((tmp_path / "warc").glob("*.part"))


def test_no_pages(spark, tmp_path):
    index, _, records = written(spark, [], tmp_path)
    assert index.count() == 0 and records == []
