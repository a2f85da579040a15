"""How far the word use of each source lies from the other sources of its language.

1. One pass over the texts: ``bytes.translate`` lowers letters and blanks everything that belongs to no term, ``bytes.split`` cuts, and
   a ``Counter`` per document gives frequencies.  They are summed per source inside the task, so a task sends one row per source and term.
2. Terms are shuffled once, by language and term; terms of too few documents go.
3. A pair of sources differs over all kept terms, most of which neither has.  With a source's probability of an unseen term as base,
   the sum is that of the bases over all terms, plus what the terms of one source add (a histogram of its counts is enough), plus a correction for
   terms that both have.  Only those meet, per term and inside the task, which sums them up; no row per pair and term is made.

All numbers are whole, so nothing depends on the order of sums.

Defined cases: a null text, language or source is ''; a source without kept terms counts 0 everywhere, a language without kept terms has
values of 0 and no term rows; equal values are ranked by the bytes of the item; repeated rows count each; a long text is counted in slices;
other columns are not read; no rows give no rows.
"""

from __future__ import annotations

from collections import Counter
from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from savora.llm.common import stored

LEAST_DOCUMENTS = 10
TOP_TERMS = 10
ONE = 1_000_000_000
SLICE = 1 << 20
COUNTS_IN_MEMORY = 300_000
PAIRS_AT_ONCE = 1 << 20

LETTERS = bytes(range(0x41, 0x5B)) + bytes(range(0x61, 0x7B)) + bytes(range(0x80, 0x100))
TRANSLATION = bytes(b + 32 if 0x41 <= b <= 0x5A else b if b in LETTERS else 0x20 for b in range(256))


def frequencies(text: bytes) -> Counter:
    """Occurrences of each term of a text; a long one is cut at blanks."""
    plain = text.translate(TRANSLATION)
    if len(plain) <= SLICE:
        return Counter(plain.split())
    counts: Counter = Counter()
    at = 0
    while at < len(plain):
        stop = plain.find(b" ", at + SLICE)
        stop = len(plain) if stop < 0 else stop
        counts.update(plain[at:stop].split())
        at = stop
    return counts


def term_counts(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """``(lang, source, term, n, docs)`` per task; the empty term, with zeros, stands for the source itself."""
    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups: dict[tuple, tuple[Counter, Counter]] = {}

        def emptied() -> pa.RecordBatch:
            sizes = [1 + len(n) for n, _ in groups.values()]
            names = [pa.array([k[i] for k in groups], pa.string()).take(pa.array(np.repeat(np.arange(len(groups)), sizes))) for i in (0, 1)]
            terms = [t for n, _ in groups.values() for t in (b"", *n)]
            n = [c for n, _ in groups.values() for c in (0, *n.values())]
            held = [h for n, d in groups.values() for h in (0, *map(d.__getitem__, n))]
            groups.clear()
            return pa.RecordBatch.from_arrays([*names, pa.array(terms, pa.binary()), pa.array(n, pa.int64()), pa.array(held, pa.int64())],
                                              ["lang", "source", "term", "n", "docs"])
        size = 0
        for part in parts:
            for text, *key in zip(*(c.to_pylist() for c in part.columns)):
                n, held = groups.setdefault(tuple(key), (Counter(), Counter()))
                before = len(n)
                counts = frequencies(text)
                n.update(counts)
                held.update(counts.keys())
                size += len(n) - before
                if size > COUNTS_IN_MEMORY:
                    yield emptied()
                    size = 0
        if groups:
            yield emptied()
    rows = docs.select(F.coalesce(F.col(f"`{text}`").cast("binary"), F.lit(b"")), *[F.coalesce(F.col(f"`{c}`"), F.lit("")) for c in (lang, source)])
    return rows.toDF("text", "lang", "source").mapInArrow(batches, "lang string, source string, term binary, n bigint, docs bigint")


def kept_terms(counts: DataFrame, least: int = LEAST_DOCUMENTS) -> DataFrame:
    """``(lang, source, term, n, total, first)`` of terms in at least ``least`` documents of the language, ``total`` over its sources;
    ``first`` marks one row per term.  Rows of the empty term stay."""
    term = Window.partitionBy("lang", "term")
    sums = counts.repartition("lang", "term").groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    wide = sums.withColumns({"total": F.sum("n").over(term), "held": F.sum("docs").over(term), "first": F.row_number().over(term.orderBy("source")) == 1})
    return wide.filter((F.col("held") >= least) | (F.length("term") == 0)).select("lang", "source", F.col("term").cast("string"), "n", "total", "first")


def source_totals(kept: DataFrame) -> DataFrame:
    """``(lang, source, no, n, v, lang_n, p0)``: number within the language, occurrences of kept terms, their number, those of the language, unseen probability."""
    langs = kept.groupBy("lang").agg(F.count(F.when(F.col("first") & (F.length("term") > 0), 1)).alias("v"), F.sum("n").alias("lang_n"))
    sources = kept.groupBy("lang", "source").agg(F.sum("n").alias("n")).withColumn("no", F.row_number().over(Window.partitionBy("lang").orderBy("source")))
    return sources.join(langs, "lang").withColumn("p0", F.when(F.col("v") > 0, _probability("0L", "n")))


def _probability(count: str, total: str) -> Column:
    return F.expr(f"1 + (CAST({count} + 2 AS DECIMAL(20, 0)) * {ONE}) DIV CAST({total} + 2 * v AS DECIMAL(20, 0))")


def _distance(p: str, q: str) -> str:
    return f"(({p} - {q}) * ({p} - {q}) DIV ({p} + {q}))"


def _distances(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // (p + q)


def _summed(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    distinct, which = np.unique(keys, return_inverse=True)
    sums = np.zeros(len(distinct), np.int64)
    np.add.at(sums, which, values)
    return distinct, sums


def shared_terms(rows: DataFrame) -> DataFrame:
    """``(lang, a, b, value)``, a < b by number: what terms of both change against counting each of the two alone.

    ``rows``: ``(lang, term, no, p, p0)``.  A term's list holds one entry per source that has it.
    """
    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, tuple[np.ndarray, np.ndarray]] = {}

        def emptied() -> Iterator[pa.RecordBatch]:
            for lang, (keys, values) in sums.items():
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(keys), pa.string()), pa.array(keys >> 32), pa.array(keys & 0xFFFFFFFF), pa.array(values)],
                                                 ["lang", "a", "b", "value"])
            sums.clear()
        for part in parts:
            langs = part.column(0).dictionary_encode()
            lists = part.column(1)
            bounds = lists.offsets.to_numpy()
            first = int(bounds[0])
            no, p, p0 = (lists.flatten().field(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(3))
            behind = np.repeat(bounds[1:] - first, np.diff(bounds))
            lang_of = np.repeat(langs.indices.to_numpy(), np.diff(bounds))
            partners = behind - np.arange(len(no)) - 1
            upto = np.concatenate(([0], np.cumsum(partners)))
            at = 0
            while at < len(no):
                stop = max(at + 1, int(np.searchsorted(upto, upto[at] + PAIRS_AT_ONCE, "right")) - 1)
                a = np.repeat(np.arange(at, stop), partners[at:stop])
                b = np.arange(upto[stop] - upto[at]) - (upto[a] - upto[at]) + a + 1
                change = _distances(p[a], p[b]) - _distances(p[a], p0[b]) - _distances(p0[a], p[b]) + _distances(p0[a], p0[b])
                keys = np.minimum(no[a], no[b]) << 32 | np.maximum(no[a], no[b])
                for i in np.unique(lang_of[at:stop]).tolist():
                    here, lang = lang_of[a] == i, langs.dictionary[i].as_py()
                    new = _summed(keys[here], change[here])
                    old = sums.get(lang)
                    sums[lang] = _summed(np.concatenate((old[0], new[0])), np.concatenate((old[1], new[1]))) if old else new
                if sum(len(k) for k, _ in sums.values()) > COUNTS_IN_MEMORY:
                    yield from emptied()
                at = stop
        yield from emptied()
    lists = rows.groupBy("lang", "term").agg(F.collect_list(F.struct("no", "p", "p0")).alias("entries")).filter(F.size("entries") > 1)
    return lists.select("lang", "entries").mapInArrow(batches, "lang string, a bigint, b bigint, value bigint")


def _ranked(rows: DataFrame, part: str) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    return rows.select("lang", "source", F.lit(part).alias("part"), "item", "value", rank.alias("rank"))


def audit(docs: DataFrame, least: int = LEAST_DOCUMENTS, top: int = TOP_TERMS, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """``(lang, source, part, item, value, rank)``: part ``pair`` holds the divergence from each other source of the language, part
    ``term`` the ``top`` terms that a source uses more than its language does."""
    kept = stored(kept_terms(term_counts(docs, text, lang, source), least), "kept_terms")
    sources = stored(source_totals(kept), "sources")
    seen = kept.filter("length(term) > 0").join(sources.withColumnRenamed("n", "source_n"), ["lang", "source"])
    seen = seen.withColumns({"p": _probability("n", "source_n"), "q": _probability("total", "lang_n")})
    terms = seen.filter("p > q").select("lang", "source", F.col("term").alias("item"), F.expr(_distance("p", "q")).alias("value"))

    other = sources.select("lang", F.col("source").alias("item"), F.col("p0").alias("q0"))
    base = sources.join(other, "lang").filter("source <> item").select(
        "lang", "source", "item", F.expr(f"CASE WHEN v > 0 THEN v * {_distance('p0', 'q0')} ELSE 0L END").alias("value"))
    alike = seen.groupBy("lang", "source", "p", "p0").agg(F.count("*").alias("times")).join(other, "lang").filter("source <> item")
    alone = alike.groupBy("lang", "source", "item").agg(F.sum(F.expr(f"times * ({_distance('p', 'q0')} - {_distance('p0', 'q0')})")).alias("value"))
    names = sources.select("lang", "no", "source")
    both = (shared_terms(seen.select("lang", "term", "no", "p", "p0")).groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))
            .join(names.toDF("lang", "a", "source"), ["lang", "a"]).join(names.toDF("lang", "b", "item"), ["lang", "b"]).select("lang", "source", "item", "value"))

    def turned(df: DataFrame) -> DataFrame:
        return df.select("lang", F.col("item").alias("source"), F.col("source").alias("item"), "value")
    one_way = alone.unionByName(both)
    pairs = base.unionByName(one_way).unionByName(turned(one_way)).groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    return _ranked(pairs, "pair").unionByName(_ranked(terms, "term").filter(F.col("rank") <= top))
