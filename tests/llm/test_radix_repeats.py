import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from savora.llm import radix_repeats as rr
from llm_texts import prose


def by_hand(texts, depth):
    raw = [(t or "").encode() for t in texts]
    counts = {}
    for b in raw:
        for p in range(len(b) - depth + 1):
            counts[b[p:p + depth]] = counts.get(b[p:p + depth], 0) + 1
    out = []
    for b in raw:
        gone = bytearray(len(b))
        for p in range(len(b) - depth + 1):
            if counts[b[p:p + depth]] > 1:
                gone[p:p + depth] = b"\1" * depth
        out.append((len(b), sum(gone), sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone)), bytes(x for x, g in zip(b, gone) if not g)))
    return out


def cleaned(docs):
    out = rr.remove(docs, rr.repeated_spans(docs))
    return out, [(r["n_bytes"], sum(s["end"] - s["start"] for s in r["spans"]), len(r["spans"]), bytes(r["kept"])) for r in out.orderBy("doc_id").collect()]


def corpus():
    draw = random.Random(2)
    passage, other = prose(50, 200), prose(51, 90)
    texts = [prose(i, 150) + passage + prose(100 + i, 60) for i in range(4)]
    texts += [passage[draw.randrange(40):] + prose(200 + i, 30) for i in range(3)]
    texts += ["Shti " * 400, "Shti " * 250, "hti Shti " * 90, "a" * 399, "a" * 400, "b" * 401, other + other, other, other]
    texts += [(other + "é" * 300)[i:] for i in range(3)] + ["", None, passage[:399], passage[5:405], "x" + passage[5:404] + "y"]
    base = prose(60, 300)
    for k in range(12):  # near copies
        at = draw.randrange(len(base) - 1)
        texts.append(base[:at] + "#" + base[at + 1:])
    return texts


@pytest.mark.parametrize("piece,large", [(1 << 20, 20_000), (700, 2)])
def test_spans_match_counting_every_window(documents, monkeypatch, piece, large):
    """Also with long texts in many pieces, and every group of the last pass dealt out."""
    monkeypatch.setattr(rr, "PIECE", piece)
    monkeypatch.setattr(rr, "LARGE_GROUP", large)
    texts = corpus()
    _, found = cleaned(documents(texts).withColumn("mark", F.lit("clash")))
    expected = by_hand(texts, rr.DEPTH)
    for text, f, e in zip(texts, found, expected):
        assert f == e, text


@pytest.mark.parametrize("depth", [200, 1000])
def test_texts_of_over_a_megabyte_are_cut_by_the_depth_asked_for(documents, depth):
    draw = random.Random(depth)
    long = "".join(draw.choices("abcdefghijklmnop", k=rr.PIECE + 3000))
    again = long[rr.PIECE - depth // 2:rr.PIECE - depth // 2 + depth]  # across the cut
    spans = {r["doc_id"]: [(s["start"], s["end"]) for s in r["spans"]] for r in rr.remove(
        documents([long, "#" + again]), rr.repeated_spans(documents([long, "#" + again]), depth=depth)).collect()}
    start = rr.PIECE - depth // 2
    assert spans == {1: [(start, start + depth)], 2: [(1, 1 + depth)]}
    assert all(not r["spans"] for r in rr.remove(documents([long]), rr.repeated_spans(documents([long]), depth=depth)).collect())


def test_equal_and_null_ids_clashes_and_no_rows(documents):
    text = prose(9, 120)
    docs = documents([(1, text), (1, text), (None, text), (None, prose(8, 120)), (None, None)]).withColumn("kept", F.lit(1)).withColumn("extra", F.lit(1))
    out, found = cleaned(docs)
    assert out.columns.count("kept") == 1 and "extra" in out.columns
    assert sorted(f[1] for f in found) == [0, 0] + [len(text)] * 3
    assert cleaned(documents([]))[1] == []


def test_sliding_min_and_rolling_hashes():
    draw = np.random.default_rng(1)
    values = draw.integers(0, 50, 1000).astype(np.uint64)
    for width in (1, 7, 337, 1000):
        assert (rr.sliding_min(values, width) == [values[i:i + width].min() for i in range(1000 - width + 1)]).all()
    data = draw.integers(0, 3, 500).astype(np.uint8)
    rolling = rr.Rolling(data)
    start = np.arange(0, 480)
    hashes = rolling.of(start, start + 10)
    seen = {}
    for s, h in zip(start.tolist(), hashes.tolist()):
        assert seen.setdefault(data[s:s + 10].tobytes(), h) == h
    assert len(set(seen.values())) == len(seen)


def test_query_digest_is_of_the_remaining_bytes(spark):
    from savora.llm.all_queries import QUERIES
    folder = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{folder}/documents.parquet").orderBy("doc_id").collect()
    expected = {r["doc_id"]: e for r, e in zip(rows, by_hand([r["text"] for r in rows], rr.DEPTH))}
    for r in QUERIES["op7_radix_repeats"](spark, folder).collect():
        n, removed, spans, kept = expected[r["doc_id"]]
        assert (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) == (n, removed, spans, hashlib.sha256(kept).hexdigest())
