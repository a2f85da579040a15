import hashlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from savora.llm import token_alignment as ta
from savora.llm.bpe_speculate import byte_letters
from llm_texts import prose

PATHS = [public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model")]
TEXTS = ["", " ", "  ", "a ", " a", "a  b", "a \n b", "\n", "\n\n x \t y ", "<|endoftext|> <s> </s> <unk> <0x41>", "a▁b", "ok ▁", "I'll we've d'''s 12", "é é ² Ⅷ ١٢ 漢字kana 😀!!😀", "a\xa0b\u0085c​d　e \x1c\x1f x_y",
         "\x1c b \x1d", "\x00 \x7f", "aaaaaaaaaaaaaaaaaaaaaaa bbbb hahahahaha " * 3, "z" * 3000, " " * 700 + "x" + " " * 300, "a\r\nb \r\n c", prose(1, 400)]


@pytest.fixture(scope="module")
def libraries():
    a = Tokenizer.from_file(PATHS[0])
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=PATHS[1])


@pytest.fixture(scope="module")
def aligner():
    return ta.Aligner(*(open(p, "rb").read() for p in PATHS))


def tokens_of(libraries, text):
    """(id, first byte, behind the last) of both tokenizers; nothing if they do not spell the text."""
    a, b = libraries
    if not text:
        return [], []
    byte_of = {c: i for i, c in enumerate(byte_letters())}
    sides = ([(i, bytes(byte_of[c] for c in a.id_to_token(i))) for i in a.encode(" " + text, add_special_tokens=False).ids],
             [(i, bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()) for i in b.encode(text)])
    if any(b"".join(t for _, t in s) != (" " + text).encode() for s in sides):
        return [], []
    out = []
    for side in sides:
        at, spans = 0, []
        for i, t in side:
            spans.append((i, at, at := at + len(t)))
        out.append(spans)
    return out


def groups_of(a, b):
    ends = sorted({z for _, _, z in a} & {z for _, _, z in b})
    inside = [(begin, end) for begin, end in zip([0, *ends], ends)]
    return ";".join("|".join(",".join(str(i) for i, s, z in side if begin <= s and z <= end) for side in (a, b)) for begin, end in inside)


def plain(libraries, rows):
    counts, texts = Counter(), []
    for key, text in rows:
        a, b = tokens_of(libraries, text)
        links = [(i, j) for i, s, z in a for j, t, y in b if s < y and t < z] if len(a) < 1500 else near(a, b)
        counts.update(links)
        texts.append((key, a, b, links))
    best = Counter()
    for (_, b), n in counts.items():
        best[b] = max(best[b], n)
    out = []
    for key, a, b, links in texts:
        groups = groups_of(a, b) if len(a) < 1500 else None
        out.append((key, len(a), len(b), len({z for _, _, z in a} & {z for _, _, z in b}), len(links), sum(counts[p] == best[p[1]] for p in links), sum(counts[p] for p in links),
                    groups and hashlib.sha256(groups.encode()).hexdigest()))
    return out


def near(a, b):
    links, j = [], 0
    for i, s, z in a:
        while b[j][2] <= s:
            j += 1
        k = j
        while k < len(b) and b[k][1] < z:
            links.append((i, b[k][0]))
            k += 1
    return links


def rows_of(docs):
    aligned = ta.chunks(docs, *PATHS)
    rows = ta.documents(aligned, ta.link_counts(aligned)).collect()
    return sorted(([r[c] for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")] for r in rows), key=str)


def same(got, expected):
    expected = sorted(map(list, expected), key=str)
    assert len(got) == len(expected)
    for g, e in zip(sorted(got, key=lambda r: str(r[:7])), sorted(expected, key=lambda r: str(r[:7]))):
        assert g[:7] == e[:7]
        assert e[7] is None or g[7] == e[7]


ascending = st.lists(st.integers(0, 400), unique=True).map(sorted)


@settings(max_examples=200, deadline=None)
@given(ascending, ascending, st.integers(1, 9))
def test_gallop_finds_first_places(short, long, block):
    before = ta.SEARCHED_AT_ONCE
    ta.SEARCHED_AT_ONCE = block
    try:
        assert ta.gallop(np.array(short, np.int64), np.array(long, np.int64)).tolist() == np.searchsorted(long, short).tolist()
    finally:
        ta.SEARCHED_AT_ONCE = before


@settings(max_examples=200, deadline=None)
@given(ascending, ascending)
def test_overlaps_are_all_links(a, b):
    a, b = ([*(x for x in side if x > 0), 500] for side in (a, b))
    upto_a, upto_b, link_a, link_b = ta.align(np.array(a), np.array(b))
    assert [a[i - 1] for i in upto_a] == [b[i - 1] for i in upto_b] == sorted({*a} & {*b})
    spans = [list(zip([0, *x], x)) for x in (a, b)]
    assert list(zip(link_a.tolist(), link_b.tolist())) == [(i, j) for i, (s, z) in enumerate(spans[0]) for j, (t, y) in enumerate(spans[1]) if s < y and t < z]


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from("ab \n\t'.1▁"), st.characters(codec="utf-8", max_codepoint=0x2FFF)), min_size=1, max_size=40))
def test_units_are_encoded_as_the_whole_text(aligner, libraries, text):
    """Cutting at blanks changes no token, and tiktoken gives what the tokenizers library gives."""
    a, b = tokens_of(libraries, text)
    aligner.meet([cut := ta.units(text)])
    places = aligner.places(cut)
    assert "".join(" " + u for u in cut) == " " + text
    assert (aligner.groups(places) if places is not None else "") == groups_of(a, b)


def test_rows(spark, libraries):
    rows = [*enumerate(TEXTS, 1), (5, "again and again"), (5, "again and again"), (None, "no id"), (99, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit(1) for c in ("chunk", "pairs", "row", "n_a", "links")}).repartition(3)
    got = rows_of(docs)
    same(got, plain(libraries, rows))
    assert [r[1:] for r in got if r[0] in (1, 99)] == [[0, 0, 0, 0, 0, 0, ""]] * 2


def test_bounds_do_not_change_results(spark, libraries, monkeypatch):
    """Small chunks, few remembered units, and texts cut in parts, one of them not spelt by its tokens."""
    rows = [*enumerate(TEXTS, 1), (70, prose(3, 3000)), (71, prose(4, 900) + " ▁ " + prose(5, 300)), (72, (prose(6, 50) + "  \n") * 30 + " ")]
    for name, value in (("PART", 300), ("UNITS_PER_CHUNK", 200), ("REMEMBERED_UNITS", 150)):
        monkeypatch.setattr(ta, name, value)
    same(rows_of(spark.createDataFrame(rows, "doc_id long, text string").repartition(2)), plain(libraries, rows))


def test_parts_keep_the_text():
    before, ta.PART = ta.PART, 20
    try:
        for text in (prose(1, 200), "a" * 100, " " * 100, "ab " * 50, "x" + " " * 60 + "\n" + " " * 20, "a  b   c" * 30):
            parts = list(ta.parts_of(text))
            assert " ".join(parts) == text
            assert [u for p in parts for u in ta.units(p)] == ta.units(text)
    finally:
        ta.PART = before


def test_counts_and_empty_tables(spark, libraries):
    rows = [(1, "the cat the cat"), (2, "the hat")]
    aligned = ta.chunks(spark.createDataFrame(rows, "doc_id long, text string"), *PATHS)
    found = {(r["a"], r["b"]): (r["links"], r["best"]) for r in ta.link_counts(aligned).collect()}
    the = libraries[0].encode(" the").ids[0], libraries[1].encode("the")[0]
    assert found[the] == (3, True)
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert rows_of(empty) == [] and ta.link_counts(ta.chunks(empty, *PATHS)).count() == 0
