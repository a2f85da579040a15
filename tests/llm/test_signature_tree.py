import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from savora.llm import signature_tree as st
from savora.llm.components import components
from llm_texts import prose

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(words[i:i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else ({tuple(words)} if words else set())


def by_hand(rows):
    """Components over all pairs."""
    sets = {i: shingles(t) for i, t in rows if i is not None}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    ids = sorted(sets)
    for a in ids:
        for b in ids:
            common = len(sets[a] & sets[b])
            if a < b and common and 100 * common >= 75 * (len(sets[a]) + len(sets[b]) - common):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in ids}


def edited(text, seed, share):
    draw = random.Random(seed)
    words = text.split(" ")
    for _ in range(max(1, int(share * len(words)))):
        words[draw.randrange(len(words))] = f"x{draw.randrange(10**6)}"
    return " ".join(words)


def corpus():
    rows, i = [], 0
    shared = prose(77, 60)
    for seed in range(12):
        base = prose(seed, 30 + 25 * seed)
        for k in range(9):
            rows.append((i, edited(base, 100 * seed + k, (0.0, 0.01, 0.02, 0.03, 0.05, 0.06, 0.08, 0.15, 0.4)[k])))
            i += 1
    rows += [(i + k, f"{prose(500 + k, 20 + k)} {shared}") for k in range(25)]  # a passage that many share
    i += 25
    chain = prose(900, 200).split(" ")
    rows += [(i + k, " ".join(chain[8 * k:8 * k + 100])) for k in range(8)]  # each links to its neighbours only
    i += 8
    rows += [(i, ""), (i + 1, None), (i + 2, " \n"), (i + 3, "one two"), (i + 4, "One  two"), (i + 5, "one two three"), (i + 6, "A b c d e"), (i + 7, "a b C d\te")]
    return rows


@pytest.mark.parametrize("tile", [4096, 5])
def test_components_match_all_pairs(spark, documents, monkeypatch, tile):
    """Also with groups cut into tiny tiles."""
    monkeypatch.setattr(st, "TILE", tile)
    rows = corpus()
    docs = documents(rows).withColumn("component_id", F.lit("clash")).withColumn("low", F.lit(1))
    found = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in st.similar_components(docs).collect()}
    assert found == by_hand(rows)


def test_many_near_copies_with_frequent_shingles(spark, documents, monkeypatch):
    monkeypatch.setattr(st, "TILE", 16)
    monkeypatch.setattr(st, "FREQUENT_SHARE", 10)
    base = prose(1, 80)
    rows = [(i, edited(base, i, 0.01)) for i in range(400)] + [(400 + i, prose(1000 + i, 40)) for i in range(50)]
    found = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in st.similar_components(documents(rows)).collect()}
    assert found == by_hand(rows)


def test_traversal_finds_every_pair_the_bound_allows():
    draw = np.random.default_rng(4)
    for across in (False, True):
        sizes = draw.integers(5, 60, 70)
        sets = [draw.integers(0, 400, s).astype(np.uint64) for s in sizes]
        sets = [np.unique(s) for s in sets] + [np.unique(np.append(s[:-1], 999)) for s in sets[:20]]
        n = np.array([len(s) for s in sets])
        maps = [st.bitmap(s) for s in sets]
        width = max(map(len, maps))
        spare, labels = st.spare_of(maps, n), np.arange(len(sets))
        full = st.stretched(maps, width)
        cut = 40 if across else len(sets)
        one = st.SignatureTree(n[:cut], full[:cut], spare[:cut], labels[:cut])
        two = st.SignatureTree(n[cut:], full[cut:], spare[cut:], labels[cut:]) if across else None
        found = {(min(i, j), max(i, j)) for a, b in st.dual_traversal(one, two, 75) for i, j in zip(a.tolist(), (b + (cut if across else 0)).tolist())}
        pairs = [(i, j) for i in range(len(sets)) for j in range(i + 1, len(sets)) if not across or i < cut <= j]
        links = {(i, j) for i, j in pairs if 100 * len(np.intersect1d(sets[i], sets[j])) >= 75 * len(np.union1d(sets[i], sets[j]))}
        assert links <= found and len(found) < len(pairs) / 2


def test_one_component_is_not_searched():
    maps = [st.bitmap(np.arange(20, dtype=np.uint64))] * 30
    n = np.full(30, 20)
    tree = st.SignatureTree(n, st.stretched(maps, len(maps[0])), st.spare_of(maps, n), np.zeros(30, np.int64))
    assert list(st.dual_traversal(tree, None, 75)) == []


def test_keep_one_repeats_nulls_and_no_rows(documents):
    text = prose(3, 60)
    docs = documents([(5, text), (3, edited(text, 1, 0.02)), (3, edited(text, 1, 0.02)), (None, text), (None, text), (9, None), (10, "")]).withColumn("_rank", F.lit("clash"))
    kept = st.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in kept.collect()) == [(False, 3), (False, 9), (False, 10), (True, 0), (True, 0)]
    assert st.similar_components(documents([])).count() == 0
    assert {r["component_id"] for r in st.similar_components(docs).filter("doc_id IS NULL").collect()} == {None}


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(1, 40)] + [(100, 100 + k) for k in range(1, 30)] + [(205, 203), (203, 209), (7, 7)]
    found = {r["node"]: r["component"] for r in components(spark.createDataFrame(links, "u long, v long")).collect()}
    assert found == {**{i: 1 for i in range(1, 41)}, **{100 + k: 100 for k in range(30)}, 203: 203, 205: 203, 209: 203}


def test_shingle_sets_of_arrow_slices():
    texts = pa.array([None, "a b c d e f", "", "A B c d e f", "x", None]).slice(1, 4)
    runs = list(st.shingle_sets(texts, 5))
    sets = [tuple(s[a:z]) for _, _, s, bounds in runs for a, z in zip(bounds[:-1], bounds[1:])]
    assert sets[0] == sets[2] and [len(s) for s in sets] == [2, 0, 2, 1]
