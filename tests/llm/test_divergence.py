import re
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from savora.llm import divergence as dv
from llm_texts import prose

SCHEMA = "text string, lang string, source string"


def plain(rows, least):
    """Part, item and value of every group over all kept terms, by the definition."""
    counts, held, groups = defaultdict(Counter), defaultdict(Counter), set()
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        terms = re.findall("[^\x00-\x40\x5B-\x60\x7B-\x7F]+", lowered)
        counts[lang, source].update(terms)
        held[lang].update(set(terms))
    out = []
    for lang, source in groups:
        kept = [t for t, n in held[lang].items() if n >= least]
        whole = Counter()
        for g in groups:
            if g[0] == lang:
                whole.update(counts[g])

        def chances(c):
            total = sum(c[t] for t in kept) + 2 * len(kept)
            return {t: 1 + 1_000_000_000 * (c[t] + 2) // total for t in kept}

        def apart(p, q):
            return (p - q) ** 2 // (p + q)
        p, q = chances(counts[lang, source]), chances(whole)
        found = [("pair", other, sum(apart(p[t], r[t]) for t in kept)) for o, other in groups if o == lang and other != source for r in [chances(counts[o, other])]]
        best = sorted((-apart(p[t], q[t]), t.encode(), t) for t in kept if counts[lang, source][t] and p[t] > q[t])[:10]
        for part, items in (("pair", sorted(((-v, i.encode(), i) for _, i, v in found))), ("term", best)):
            out += [(lang, source, part, i, -v, rank) for rank, (v, _, i) in enumerate(items, 1)]
    return sorted(out)


def rows_of(spark, rows, least, parts=3):
    docs = spark.createDataFrame(rows, SCHEMA).repartition(parts) if rows else spark.createDataFrame([], SCHEMA)
    return sorted(tuple(r) for r in dv.audit(docs, least).collect())


def odd_rows():
    rows = [(prose(i, 20 + 7 * (i % 9)), "en" if i % 3 else "de", f"s{i % 5 if i % 4 else 0}") for i in range(90)]
    rows += [("Émile ÉMILE émile İi ß日本 x_y a1b", "en", "s1"), (None, "en", "s1"), ("", "en", "empty"), ("12 -- 3", "en", "empty"), (None, None, None), ("ka lo", None, "s2"),
             ("once", "fr", "a"), ("never", "fr", "b"), ("tie eit " * 4, "tie", "b"), ("eit tie " * 4, "tie", "a"), (prose(0, 20), "en", "s0"), (prose(0, 20), "en", "s0")]
    return rows


def test_same_as_the_definition(spark):
    rows = odd_rows()
    for least in (1, 2, 10):
        assert rows_of(spark, rows, least) == plain(rows, least)


def test_groups_without_terms_are_listed(spark):
    found = rows_of(spark, odd_rows(), 10)
    assert ("fr", "a", "pair", "b", 0, 1) in found and ("fr", "b", "pair", "a", 0, 1) in found
    assert not [r for r in found if r[0] == "fr" and r[2] == "term"]
    assert [r for r in found if r[:2] == ("en", "empty") and r[2] == "pair"]


def test_bounds_do_not_change_results(spark, monkeypatch):
    rows = odd_rows() + [(prose(5, 4000), "en", "long")]
    monkeypatch.setattr(dv, "COUNTS_IN_MEMORY", 7)
    monkeypatch.setattr(dv, "SLICE", 100)
    monkeypatch.setattr(dv, "PAIRS_AT_ONCE", 3)
    assert rows_of(spark, rows, 2) == plain(rows, 2)


def test_empty_tables_and_other_columns(spark):
    assert rows_of(spark, [], 1) == []
    docs = spark.createDataFrame(odd_rows(), SCHEMA).withColumns({c: F.lit(7) for c in ("term", "n", "p", "rank", "no", "value")})
    assert sorted(tuple(r) for r in dv.audit(docs, 2).collect()) == plain(odd_rows(), 2)


def test_counts_beyond_64_bits_of_the_product(spark):
    """Counts so large that a thousand million times as many leaves 64 bits."""
    big = 1 << 40
    kept = spark.createDataFrame([("en", s, "", 0, 0, False) for s in "ab"] + [("en", "a", "x", big, big + 1, True), ("en", "b", "x", 1, big + 1, False), ("en", "b", "y", 3 * big, 3 * big, True)],
                                 "lang string, source string, term string, n long, total long, first boolean")
    seen = kept.filter("length(term) > 0").join(dv.source_totals(kept).withColumnRenamed("n", "source_n"), ["lang", "source"])
    got = {(r["source"], r["term"]): r["p"] for r in seen.withColumn("p", dv._probability("n", "source_n")).collect()}
    assert got == {("a", "x"): 1 + 10**9 * (big + 2) // (big + 4), ("b", "x"): 1 + 10**9 * 3 // (3 * big + 5), ("b", "y"): 1 + 10**9 * (3 * big + 2) // (3 * big + 5)}
