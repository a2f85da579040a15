import json

import public_tokenizers
import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from savora.llm import bpe_speculate as bs
from llm_texts import prose

PATH = public_tokenizers.path("word_bpe_49k.json")
TEXTS = ["", " ", "<|endoftext|>a <|startoftext|><|endoftext|>", "I'll we've IT'S d'''s 12", "ΣΑΣ ΑΣ İstanbul ǅ ﬁ é é ² Ⅷ ١٢ 漢字kana 😀!!😀",
         "a\xa0b\u0085c​d　e \x1c\x1f x_y", "aaaaaaaaaaaaaaaaaaaaaaa bbbb hahahahahahaha " * 3, "\x00 \x7f <| <|endoftext|", prose(1, 3000), "z" * 5000]


@pytest.fixture(scope="module")
def both():
    return bs.SpeculativeBpe(json.load(open(PATH))), Tokenizer.from_file(PATH)


def same(both, texts):
    mine, library = both
    expected = library.encode_batch(texts, add_special_tokens=False)
    got = mine.encode_batch(texts)
    assert got == [e.ids for e in expected]
    assert [mine.decode(g) for g in got] == [library.decode(e.ids, skip_special_tokens=False) for e in expected]


def test_same_as_the_library(both):
    same(both, TEXTS)


@settings(max_examples=150, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet=st.one_of(st.sampled_from("aehinorst 'éß!1"), st.characters(codec="utf-8", max_codepoint=0x2FFF)), max_size=40), max_size=5))
def test_same_as_the_library_on_any_text(both, texts):
    same(both, texts)


def test_pair_checks_decide_as_merging_does(both):
    """A pair fits exactly if the two tokens, put together, merge to themselves again."""
    import random
    import numpy as np
    mine, _ = both
    draw = random.Random(3)
    plain = [t for t in mine.vocab if not t.endswith("</w>") and len(t) < 6]
    ends = [t for t in mine.vocab if t.endswith("</w>") and len(t) < 9]
    pairs = [(draw.choice(plain), draw.choice(ends)) for _ in range(4000)]
    fits = mine._first_merge(np.array([mine.vocab[a] for a, _ in pairs]), np.array([mine.vocab[b] for _, b in pairs])) == bs.NEVER
    for (a, b), ok in zip(pairs, fits):
        assert ok == (mine._merged((a + b).removesuffix("</w>")) == [mine.vocab[a], mine.vocab[b]]), (a, b)
    assert 0.1 < fits.mean() < 1


def test_remembered_words_are_bounded(both, monkeypatch):
    monkeypatch.setattr(bs, "REMEMBERED_WORDS", 50)
    mine = bs.SpeculativeBpe(json.load(open(PATH)))
    texts = [prose(i, 60) for i in range(20)]
    assert [mine.encode_batch([t])[0] for t in texts] == [e.ids for e in both[1].encode_batch(texts, add_special_tokens=False)]


def test_rows(documents, both):
    docs = documents([*TEXTS, (1, "again"), (1, "again"), (None, None)]).withColumn("ids", F.lit("clash")).withColumn("decoded", F.lit(1)).withColumn("extra", F.lit(1))
    rows = bs.decode(bs.encode(docs, PATH), PATH).collect()
    assert len(rows) == len(TEXTS) + 3
    for r in rows:
        expected = both[1].encode(r["text"] or "", add_special_tokens=False)
        assert r["ids"] == expected.ids and r["decoded"] == both[1].decode(expected.ids, skip_special_tokens=False)
    assert bs.encode(documents([]), PATH).count() == 0
