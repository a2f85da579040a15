import random
import re

from pyspark.sql import functions as F

from savora.llm import secret_novelty as sn
from llm_texts import prose

KEY = "q7Zt9LmX2vRb8KwY4nHs6JdP"


def by_hand(text):
    """The three patterns as written, without any shortcut."""
    assign = re.compile(r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
    found = [("assign", *m.span()) for m in assign.finditer(text) if len(m[2]) >= 6]
    found += [("access", *m.span()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [("hex", *m.span()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(found, key=lambda s: (s[1], ("assign", "access", "hex").index(s[0])))


TEXTS = ["token = abcdef", "token=abc secret: 'xyzxyz'", "TOKEN=ABCDEF password:  \"a.b-c=d/+\"", "toKen=abcdef ſecret=abcdef", "api_key=123456 apikey:1234567 api__key=1234567",
         "AKIA" + "Z9" * 8, "AKIA" + "Z9" * 7, "x" + "0af" * 8 + "g", "deadbeef" * 2, "token=token=abcdef1", "é token = 012345 \U0001f600 secret=abcdefg", "", None, prose(1, 2000)]


def test_base_spans_match_the_plain_patterns():
    for text in TEXTS:
        assert sn.base_spans(text or "") == by_hand(text or ""), text


def test_novelty_separates_keys_from_words():
    assert sn.novelty(KEY, "", "") > 0.9
    assert sn.novelty("your_api_key_here", "", "") < 0.5
    assert sn.novelty(KEY, f"earlier {KEY} and", "") < 0.5  # the surroundings explain it


def test_novel_spans_need_a_sensitive_place_and_a_new_string():
    text = f"authorization: {KEY}"
    assert [(k, text[s:e]) for k, s, e, _ in sn.novel_spans(text)] == [("novel", KEY)]
    assert sn.novel_spans(f"the value {KEY} stands here") == []
    assert sn.novel_spans("credential: example_example_example_1") == []


def test_secrets_of_letters_only_are_told_from_words():
    for text, value in [("pwd: kqzwvbxnprtymlsh", "kqzwvbxnprtymlsh"), ("Authorization: Bearer HqXvTzLpWkRjBnMdFg", "HqXvTzLpWkRjBnMdFg"),
                        ("credentials = 'x$K!q@Z%w^P&v'", "x$K!q@Z%w^P&v")]:
        assert [text[s:e] for _, s, e, _ in sn.novel_spans(text)] == [value]
        assert value not in sn.cut(text, sn.scan_text(text))
    words = ["straightforward", "internationalization", "configuracionPredeterminada", "correct-horse-battery-staple", "getUserByEmail.address", "characteristics"]
    assert [w for w in words if sn.novel_spans(f"pwd: {w}")] == []
    draw = random.Random(4)
    keys = ["".join(draw.choices("abcdefghijklmnopqrstuvwxyz", k=16)) for _ in range(500)]
    assert sum(len(sn.novel_spans(f"passphrase: {k}")) for k in keys) >= 490


def test_scan_and_redact_rows(documents):
    docs = documents([*TEXTS, (99, f"password = {KEY}"), (99, f"password = {KEY}"), (None, None)]).withColumn("spans", F.lit("clash")).withColumn("extra", F.lit(1))
    found = sn.scan(docs)
    rows = found.collect()
    assert len(rows) == len(TEXTS) + 3 and found.columns.count("spans") == 1
    for r in rows:
        assert [(s["kind"], s["start"], s["end"]) for s in r["spans"] if s["kind"] != "novel"] == by_hand(r["text"] or "")
    clean = [r["text"] for r in sn.redact(docs).filter("doc_id = 99").collect()]
    assert clean == ["[ASSIGN]", "[ASSIGN]"]
    assert sn.redact(docs).filter("text IS NULL").count() == 2
    assert sn.scan(documents([])).count() == 0


def test_overlapping_spans_are_cut_together():
    spans = [{"kind": "assign", "start": 2, "end": 9}, {"kind": "novel", "start": 5, "end": 12}]
    assert sn.cut("a token=123456z b", spans) == "a [ASSIGN]56z b"
