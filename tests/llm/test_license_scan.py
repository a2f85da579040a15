import math
import re

from pyspark.sql import functions as F

from savora.llm import license_scan as ls
from llm_texts import prose

SEP = re.compile(ls.SEPARATORS)


def words(text):
    return [w for w in SEP.split(re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) if w]


def by_hand(text, templates=ls.TEMPLATES, threshold=ls.THRESHOLD):
    own = words(text)
    base = [(label, i) for label, p in ls.PHRASES.items() for i in range(len(own)) if tuple(own[i:i + len(p)]) == p]
    best = {}
    for block in re.split(r"\n[ \t\r]*\n", text or ""):
        held = set(words(block))
        for label, t in templates.items():
            whole = set(ls.template_words(t))
            if len(held & whole) >= math.ceil(threshold * len(whole) - 1e-9):
                best[label] = max(best.get(label, 0), len(held & whole) / len(whole))
    at = [i for _, i in base]
    return (len(own), len(base), min(at, default=None), max(at, default=None), ",".join(sorted({b for b, _ in base})),
            ",".join(sorted({b for b, _ in base} | set(best))), max(best.values(), default=0.0))


def test_places_and_templates_match_a_plain_version(documents):
    mit, gpl, warranty = ls.TEMPLATES["mit"], ls.TEMPLATES["gpl-3.0-notice"], ls.TEMPLATES["no-warranty"]
    texts = [prose(1, 50), f"{prose(2, 30)}\n\n{mit}\n\n{warranty}", gpl.upper(), "CC-BY, cc.by and CC_BY. All rights reserved! All rights\nreserved",
             " ".join(mit.split()[8:]), mit.replace("software", "program"), mit.replace("\n", " ").replace(" ", "\n \t\n"), "", None,
             "Licensed under the Apache License, version", "licensed apache license version 2 0 the\nunder", f"{prose(3, 4000)} {gpl}", "cc", "all rights", "É ccé by"]
    out = ls.scan(documents(texts)).orderBy("doc_id").collect()
    for text, r in zip(texts, out):
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"], r["labels"], r["score"]) == by_hand(text), text
    assert "mit" in out[1]["labels"] and "no-warranty" in out[1]["labels"]


def test_filters_lose_no_pair(spark):
    """Prefix, length and positional filters against all pairs, over many random blocks."""
    import random
    draw = random.Random(5)
    vocabulary = [f"w{i}" for i in range(30)]
    templates = {f"t{k}": " ".join(draw.sample(vocabulary, draw.randint(3, 12))) for k in range(12)}
    blocks = [draw.sample(vocabulary, draw.randint(1, 25)) for _ in range(400)]
    held = spark.createDataFrame([(i, 0, b) for i, b in enumerate(blocks)], "_row long, _block int, held array<string>")
    found = {(r["_row"], r["label"]) for r in ls.template_links(held, templates, 0.7).collect()}
    expected = {(i, label) for i, b in enumerate(blocks) for label, t in templates.items()
                if len(set(b) & set(t.split())) >= ls.need_of(len(t.split()), 0.7)}
    assert found == expected and expected


def test_repeats_clashes_and_no_rows(documents):
    docs = documents([(1, "All rights reserved."), (1, "All rights reserved."), (None, None)]).withColumn("labels", F.lit(3)).withColumn("extra", F.lit(1))
    out = ls.scan(docs).collect()
    assert sorted((r["doc_id"] or 0, r["labels"], r["extra"]) for r in out) == [(0, "", 1), (1, "reserved", 1), (1, "reserved", 1)]
    assert ls.scan(documents([])).count() == 0
