"""Quality classifier: perplexity under an interpolated modified Kneser-Ney model of trusted text.

The model predicts a character from the three before it.  Characters up to U+024F stand for themselves, others for one of
the remaining of 1,024 symbols, so a gram is a 40-bit number.  Counts are taken over all trusted texts, as a table
``(gram, count)`` that grows with them.

Scoring is a join of counts with counts, sharded by the two middle symbols of the gram: all a shard
needs to know of a gram, its contexts and its lower order is in the shard.  The lowest orders have at most 1,024 x 1,024 entries
and are broadcast.  Each task sends the grams of a chunk of documents with their counts once to the shards, and gets
back one sum per document and shard.  Shards are replicated as the number of chunks grows, so a frequent pair of symbols
meets in several tasks.

A document is kept if its perplexity is at most ``slack`` times the ``quantile`` of trusted texts of its language that the model
has not seen (of all languages, if its own has none): one in ``held_out`` trusted texts, by the hash of its id, is kept from
training for that, since a model finds what it has learnt from less surprising.

Defined cases: a null or empty text has no perplexity and is not kept; without trusted texts every symbol is equally likely and nothing
is rejected; null languages are one language; each row is scored apart, also rows of equal or null ids; repeated labels of an id count once, and a
text is trusted if any of its labels says so.
"""

from __future__ import annotations

from typing import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F

from savora.llm import byte_text
from savora.llm.common import slots, stored

SYMBOLS = 1024
DIRECT = 0x250
BITS = 10
QUANTILE = 0.99
SLACK = 1.25
HELD_OUT = 5
CHUNK_CHARS = 4 << 20
CHUNK_DOCS = 4096
GRAMS_PER_SHARD = 250_000
CHUNKS_PER_REPLICA = 2048
BROADCAST_ROWS = 4_000_000

PAIR = (1 << 2 * BITS) - 1
TRIPLE = (1 << 3 * BITS) - 1


def symbols(text: str) -> np.ndarray:
    """Symbol of each character; 0 stands for what is before a text."""
    codes = np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32).astype(np.int64)
    far = codes >= DIRECT
    if far.any():
        codes[far] = DIRECT + codes[far] % (SYMBOLS - DIRECT)
    return codes


def chunk_texts(texts: list[str | None]) -> Iterator[tuple[int, int]]:
    """Runs of texts of bounded length and number; a longer text is a run of its own."""
    first, size = 0, 0
    for i, text in enumerate(texts):
        more = len(text or "")
        if i > first and (size + more > CHUNK_CHARS or i - first == CHUNK_DOCS):
            yield first, i
            first, size = i, 0
        size += more
    if first < len(texts):
        yield first, len(texts)


def grams_of(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """(gram, number of the text) of every character."""
    texts = [t or "" for t in texts]
    sizes = np.array([len(t) for t in texts], np.int64)
    s = symbols("".join("\0\0\0" + t for t in texts))
    owner = np.repeat(np.arange(len(texts)), sizes)
    at = np.arange(len(owner)) + 3 * (owner + 1)
    return (s[at - 3] << 3 * BITS) | (s[at - 2] << 2 * BITS) | (s[at - 1] << BITS) | s[at], owner


def count_grams(texts: DataFrame) -> DataFrame:
    """``(gram, n)`` over all texts."""
    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            rows = part.column(0).to_pylist()
            for a, z in chunk_texts(rows):
                grams, n = np.unique(grams_of(rows[a:z])[0], return_counts=True)
                if len(grams):
                    yield pa.RecordBatch.from_arrays([pa.array(grams), pa.array(n)], ["gram", "n"])
    return stored(texts.mapInArrow(batches, "gram bigint, n bigint").groupBy("gram").agg(F.sum("n").alias("n")), "grams")


def discounts(n1: int, n2: int, n3: int, n4: int) -> np.ndarray:
    """Discount of counts 0, 1, 2 and 3 or more, from the numbers of grams seen once to four times."""
    if not (n1 and n2 and n3 and n4):
        return np.array([0.0, 0.5, 1.0, 1.5])
    y = n1 / (n1 + 2 * n2)
    return np.clip([0.0, 1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3], 0, [0, 1, 2, 3])


def count_discounts(counts: DataFrame) -> np.ndarray:
    return discounts(*counts.agg(*[F.count(F.when(F.col("n") == k, 1)) for k in (1, 2, 3, 4)]).first())


def lowest_orders(pairs: list[tuple[int, int]], of_pairs: np.ndarray) -> np.ndarray:
    """Probability of each symbol behind each symbol, from the number of different symbols before each pair."""
    counts = np.zeros((SYMBOLS, SYMBOLS))
    for pair, n in pairs:
        counts[pair >> BITS, pair & (SYMBOLS - 1)] = n
    seen = (counts > 0).sum(0).astype(float)
    d = discounts(*[int((seen == k).sum()) for k in (1, 2, 3, 4)])
    off = d[np.minimum(seen, 3).astype(int)]
    single = np.full(SYMBOLS, 1 / SYMBOLS) if not seen.sum() else (seen - off) / seen.sum() + off.sum() / seen.sum() / SYMBOLS
    off = of_pairs[np.minimum(counts, 3).astype(int)]
    total = np.maximum(counts.sum(1, keepdims=True), 1)
    weight = np.where(counts.sum(1, keepdims=True) > 0, off.sum(1, keepdims=True) / total, 1.0)
    return (counts - off) / total + weight * single[None, :]


class Order:
    """Counts of one order in a shard: grams in order, and the totals of their contexts."""

    def __init__(self, grams: np.ndarray, counts: np.ndarray, d: np.ndarray):
        self.grams, off = grams, d[np.minimum(counts, 3)]
        context = grams >> BITS
        cuts = np.flatnonzero(np.concatenate(([True], context[1:] != context[:-1]))) if len(grams) else np.zeros(0, np.int64)
        self.contexts = context[cuts]
        self.totals = np.add.reduceat(counts, cuts).astype(float) if len(cuts) else np.zeros(0)
        self.weights = np.add.reduceat(off, cuts) / self.totals if len(cuts) else np.zeros(0)
        self.rest = counts - off

    def probability(self, grams: np.ndarray, lower: np.ndarray) -> np.ndarray:
        if not len(self.grams):
            return lower
        at = np.minimum(np.searchsorted(self.grams, grams), len(self.grams) - 1)
        mass = np.where(self.grams[at] == grams, self.rest[at], 0.0)
        context = grams >> BITS
        c = np.minimum(np.searchsorted(self.contexts, context), len(self.contexts) - 1)
        known = self.contexts[c] == context
        return np.where(known, mass / self.totals[c] + self.weights[c] * lower, lower)


class Shard:
    def __init__(self, grams: np.ndarray, counts: np.ndarray, d4: np.ndarray, d3: np.ndarray, pairs: np.ndarray):
        order = np.argsort(grams)
        self.four = Order(grams[order], counts[order], d4)
        self.three = Order(*np.unique(grams & TRIPLE, return_counts=True), d3)
        self.pairs = pairs

    def logs(self, grams: np.ndarray) -> np.ndarray:
        lowest = self.pairs[(grams >> BITS) & (SYMBOLS - 1), grams & (SYMBOLS - 1)]
        return np.log(self.four.probability(grams, self.three.probability(grams & TRIPLE, lowest)))


def shard_of(grams: np.ndarray, shards: int) -> np.ndarray:
    return (byte_text.keys_of((grams >> BITS) & PAIR, 31) % np.uint64(shards)).astype(np.int64)


def pack(grams: np.ndarray, runs: np.ndarray, docs: np.ndarray, counts: np.ndarray) -> bytes:
    head = np.array([len(grams), len(docs)], np.int64).tobytes()
    steps = np.diff(docs, prepend=0).astype(np.int16)
    return zstandard.ZstdCompressor(level=1).compress(
        head + np.diff(grams, prepend=0).tobytes() + runs.astype(np.int32).tobytes() + steps.tobytes() + counts.astype(np.int32).tobytes())


def unpack(blob: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(blob)
    n, m = np.frombuffer(raw, np.int64, 2).tolist()
    grams = np.cumsum(np.frombuffer(raw, np.int64, n, 16))
    runs = np.frombuffer(raw, np.int32, n, 16 + 8 * n)
    docs = np.cumsum(np.frombuffer(raw, np.int16, m, 16 + 12 * n).astype(np.int64))
    return grams, runs, docs, np.frombuffer(raw, np.int32, m, 16 + 12 * n + 2 * m)


SENT = "shard int, replica int, kind int, gram bigint, n bigint, chunk bigint, data binary, ids array<bigint>, langs array<string>, sizes array<bigint>"
SENT_ARROW = pa.schema([("shard", pa.int32()), ("replica", pa.int32()), ("kind", pa.int32()), ("gram", pa.int64()), ("n", pa.int64()), ("chunk", pa.int64()),
                        ("data", pa.binary()), ("ids", pa.list_(pa.int64())), ("langs", pa.list_(pa.string())), ("sizes", pa.list_(pa.int64()))])
MODEL, GRAMS, NAMES = 0, 1, 2


def sent_chunks(docs: DataFrame, shards: int, replicas: int) -> DataFrame:
    """Rows for the shards: the grams of each chunk of ``(doc_id, lang, text)``, and one row with the names of its documents.

    A chunk is named by the partition and place of its first row, whatever it holds, so equal chunks stay apart, and a task that
    runs again over the same rows sends the same names.
    """
    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            ids, langs, texts = (part.column(i).to_pylist() for i in range(3))
            names = byte_text.keys_of(part.column(3).to_numpy(), 32).view(np.int64)  # different places, different keys, evenly spread
            for a, z in chunk_texts(texts):
                grams, owner = grams_of(texts[a:z])
                sizes = np.bincount(owner, minlength=z - a)
                chunk = int(names[a])
                both, counts = np.unique((grams << 12) | owner, return_counts=True)
                gram, doc = both >> 12, both & (CHUNK_DOCS - 1)
                shard = shard_of(gram, shards)
                order = np.argsort(shard.astype(np.uint16) if shards < 1 << 16 else shard, kind="stable")
                gram, doc, counts = gram[order], doc[order], counts[order]
                cuts = np.searchsorted(shard[order], np.arange(shards + 1))
                replica = chunk % replicas
                rows = []
                for s in np.flatnonzero(np.diff(cuts)).tolist():
                    own = slice(cuts[s], cuts[s + 1])
                    fresh = np.flatnonzero(np.concatenate(([True], gram[own][1:] != gram[own][:-1])))
                    runs = np.diff(fresh, append=own.stop - own.start)
                    rows.append({"shard": s, "replica": replica, "kind": GRAMS, "chunk": chunk, "n": z - a, "data": pack(gram[own][fresh], runs, doc[own], counts[own])})
                rows.append({"shard": chunk % shards, "replica": replica, "kind": NAMES, "chunk": chunk, "n": z - a, "ids": ids[a:z], "langs": langs[a:z], "sizes": sizes.tolist()})
                yield pa.RecordBatch.from_pylist(rows, SENT_ARROW)
    return docs.withColumn("_place", F.monotonically_increasing_id()).mapInArrow(batches, SENT)


def log_probabilities(docs: DataFrame, counts: DataFrame) -> DataFrame:
    """``(doc_id, lang, size, log_probability)`` of each row of ``(doc_id, lang, text)``."""
    spark = docs.sparkSession
    triples = counts.groupBy(F.col("gram").bitwiseAND(F.lit(TRIPLE)).alias("gram")).agg(F.count("*").alias("n"))
    pairs = triples.groupBy(F.col("gram").bitwiseAND(F.lit(PAIR)).alias("gram")).agg(F.count("*").alias("n"))
    d4, d3 = count_discounts(counts), count_discounts(triples)
    found = [(r[0], r[1]) for r in pairs.collect()]  # at most SYMBOLS x SYMBOLS
    lowest = lowest_orders(found, discounts(*[sum(n == k for _, n in found) for k in (1, 2, 3, 4)]))
    shipped = spark.sparkContext.broadcast((d4, d3, lowest))
    shards = slots(counts.count(), GRAMS_PER_SHARD, least=2 * spark.sparkContext.defaultParallelism)
    total = docs.agg(F.sum(F.length("text"))).first()[0] or 0
    replicas = slots(total, CHUNKS_PER_REPLICA * CHUNK_CHARS)
    key = F.col("gram").bitwiseAND(F.lit(TRIPLE))
    model = counts.select("gram", "n", key.alias("_k"))

    def placed(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            grams = part.column(0).to_numpy()
            for r in range(replicas):
                none = [pa.nulls(len(grams), f.type) for f in SENT_ARROW][5:]
                yield pa.RecordBatch.from_arrays([pa.array(shard_of(grams, shards), pa.int32()), pa.array(np.full(len(grams), r), pa.int32()),
                                                  pa.array(np.full(len(grams), MODEL), pa.int32()), part.column(0), part.column(1), *none], schema=SENT_ARROW)

    def scored(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        d4, d3, lowest = shipped.value
        at, grams, seen, shard = None, [], [], None
        for part in parts:
            keys = list(zip(part.column(0).to_pylist(), part.column(1).to_pylist(), part.column(2).to_pylist()))
            cuts = [0, *(i for i in range(1, len(keys)) if keys[i] != keys[i - 1]), len(keys)]
            for a, z in zip(cuts[:-1], cuts[1:]):
                if a == z:
                    continue
                if keys[a][:2] != at:
                    at, grams, seen, shard = keys[a][:2], [], [], None
                if keys[a][2] == MODEL:
                    grams.append(part.column(3).slice(a, z - a).to_numpy())
                    seen.append(part.column(4).slice(a, z - a).to_numpy())
                    continue
                out = []
                for r in part.slice(a, z - a).select([2, 4, 5, 6, 7, 8, 9]).to_pylist():
                    if r["kind"] == NAMES:
                        out.append({"chunk": r["chunk"], "ids": r["ids"], "langs": r["langs"], "sizes": r["sizes"]})
                        continue
                    if shard is None:
                        empty = np.zeros(0, np.int64)
                        shard = Shard(np.concatenate(grams) if grams else empty, np.concatenate(seen) if seen else empty, d4, d3, lowest)
                    gram, runs, docs, counts = unpack(r["data"])
                    sums = np.bincount(docs, np.repeat(shard.logs(gram), runs) * counts, r["n"])
                    out.append({"chunk": r["chunk"], "data": sums.astype(np.float64).tobytes()})
                yield pa.RecordBatch.from_pylist(out, RETURNED_ARROW)

    def summed(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk, names, sums = None, None, 0.0

        def close() -> pa.RecordBatch:
            total = np.broadcast_to(np.asarray(sums, float), len(names["ids"]))
            return pa.RecordBatch.from_arrays([pa.array(names["ids"], pa.int64()), pa.array(names["langs"], pa.string()), pa.array(names["sizes"], pa.int64()), pa.array(total)],
                                              ["doc_id", "lang", "size", "log_probability"])
        for part in parts:
            for r in part.to_pylist():
                if r["chunk"] != chunk and names:
                    yield close()
                    names, sums = None, 0.0
                chunk = r["chunk"]
                if r["data"] is None:
                    names = r
                else:
                    sums = sums + np.frombuffer(r["data"], np.float64)
        if names:
            yield close()

    rows = (model.select("gram", "n").mapInArrow(placed, SENT).unionByName(sent_chunks(docs, shards, replicas))
            .repartition("shard", "replica").sortWithinPartitions("shard", "replica", "kind").mapInArrow(scored, RETURNED))
    return rows.repartition("chunk").sortWithinPartitions("chunk").mapInArrow(summed, "doc_id bigint, lang string, size bigint, log_probability double")


RETURNED = "chunk bigint, data binary, ids array<bigint>, langs array<string>, sizes array<bigint>"
RETURNED_ARROW = pa.schema([("chunk", pa.int64()), ("data", pa.binary()), ("ids", pa.list_(pa.int64())), ("langs", pa.list_(pa.string())), ("sizes", pa.list_(pa.int64()))])


def classify(docs: DataFrame, trusted: DataFrame, quantile: float = QUANTILE, slack: float = SLACK, held_out: int = HELD_OUT) -> DataFrame:
    """``(doc_id, lang, n_symbols, perplexity, threshold, kept)`` of each row of ``(doc_id, lang, text)``; ``trusted`` holds ids.

    With ``held_out`` 0 the model learns from all trusted texts and the quantiles are theirs.
    """
    ids = trusted.select(F.col("doc_id").cast("long").alias("doc_id")).filter("doc_id IS NOT NULL").distinct()
    few = ids.count() <= BROADCAST_ROWS  # else Spark shuffles both sides, with the same result
    apart = F.pmod(F.xxhash64("doc_id"), F.lit(held_out or 1)) == 0
    learnt, unseen = (ids, ids) if not held_out else (ids.filter(~apart), ids.filter(apart))
    learnt, unseen = (F.broadcast(x) if few else x for x in (learnt, unseen))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "lang", "text")
    counts = count_grams(rows.join(learnt, "doc_id", "left_semi").select("text"))
    scored = stored(log_probabilities(rows, counts).withColumn(
        "perplexity", F.when(F.col("size") > 0, F.exp(-F.col("log_probability") / F.col("size")))), "perplexity")
    known = scored.join(unseen, "doc_id", "left_semi").filter("size > 0")
    limit = F.percentile_approx("perplexity", quantile, 10_000) * slack
    limits = known.groupBy("lang").agg(limit.alias("own"))
    overall = known.agg(limit).first()[0]
    limited = scored.join(limits.withColumnRenamed("lang", "_lang"), F.col("lang").eqNullSafe(F.col("_lang")), "left")
    threshold = F.coalesce("own", F.lit(overall).cast("double"))
    return limited.select("doc_id", "lang", F.col("size").alias("n_symbols"), "perplexity", threshold.alias("threshold"),
                          (F.col("perplexity").isNotNull() & F.coalesce(F.col("perplexity") <= threshold, F.lit(True))).alias("kept"))
