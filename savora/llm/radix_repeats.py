"""Suffix-array dedup: repeated byte strings of a fixed length, by a radix sort of suffixes that stops at that depth.

Suffixes are ordered only through their first ``depth`` bytes, in passes from coarse digits to fine ones; after each pass
only groups of two and more go on, and what is equal after the last pass are exactly the repeated strings.  One row
stands for a block of neighbouring suffixes:

* Each suffix belongs to the smallest hash of its 64-byte grams, a place that its own bytes decide, so equal
  strings have equal places.  Suffixes of one place are cut into blocks by their distance to it.
* first digit: the bytes that all suffixes of a block have in common (over half of the depth).  Most blocks end here, alone.
* second digit: all bytes of the block.  If two blocks agree, all their suffixes are repeated.
* last digit: for blocks that agree in the first digit only, the ``depth`` bytes of each suffix.

Groups of the last pass are sorted in one task each; a group of over ``LARGE_GROUP`` blocks is dealt out by the bytes of the single suffixes instead.

Digits are 64-bit hashes, so strings count as equal where three of them are.  Matches never cross documents.

Defined cases: a null text has no bytes; a text shorter than ``depth`` repeats nothing; rows of equal id and text are copies of each other, so both lose
all (from ``depth`` bytes on), as do equal texts under null ids; other columns pass through ``remove``, columns it adds are replaced.
"""

from __future__ import annotations

from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from savora.llm import byte_text
from savora.llm.common import stored

DEPTH = 400
GRAM = 64
BLOCK = 169
LARGE_GROUP = 20_000
PIECE = 1 << 20

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_LETTER = byte_text.keys_of(np.arange(256), 21)


class Rolling:
    """Hashes of any range of some bytes, from sums of letter times base to the position (modulo 2**64)."""

    _powers = (np.ones(1, np.uint64), np.ones(1, np.uint64))

    def __init__(self, data: np.ndarray):
        if len(data) >= len(Rolling._powers[0]):
            Rolling._powers = tuple(np.concatenate((np.ones(1, np.uint64), np.cumprod(np.full(2 * len(data), base, np.uint64), dtype=np.uint64)))
                                    for base in (_BASE, _INVERSE))
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_LETTER[data] * Rolling._powers[0][:len(data)], out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return byte_text.keys_of((self.sums[end] - self.sums[start]) * Rolling._powers[1][start] + (end - start).astype(np.uint64), 22)

    def grams(self, size: int) -> np.ndarray:
        n = len(self.sums) - size
        return byte_text.keys_of((self.sums[size:] - self.sums[:n]) * Rolling._powers[1][:n], 23)


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Smallest of each run of ``width`` values, from running minima of blocks in both directions."""
    n = len(values) - width + 1
    padded = np.full(-(-len(values) // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[:len(values)] = values
    rows = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(rows, axis=1).ravel()
    back = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n], ahead[width - 1:width - 1 + n])


def blocks_of(data: np.ndarray, depth: int) -> tuple[np.ndarray, ...]:
    """``(key, whole, first, last, ahead)`` of each block of suffixes: digits, range of starts, distance of the first start to its place."""
    width = depth - GRAM + 1
    rolling = Rolling(data)
    grams = rolling.grams(GRAM)
    least = sliding_min(grams, width)
    n = len(least)
    windows = np.lib.stride_tricks.sliding_window_view(grams, width)
    cuts = np.flatnonzero(least[1:] != least[:-1]) + 1
    begin, until = np.concatenate(([0], cuts)), np.append(cuts, n) - 1
    parts = []
    while len(begin):
        place = np.concatenate([begin[a:a + 4096] + windows[begin[a:a + 4096]].argmin(1) for a in range(0, len(begin), 4096)])
        end = np.minimum(until, place)
        parts.append((begin, end, place))
        further = until > end  # equal grams: from behind the place on, the next one counts
        begin, until = end[further] + 1, until[further]
    begin, end, place = (np.concatenate(x) for x in zip(*parts))
    rows = []
    for j in range(-(-width // BLOCK)):
        near, far = place - j * BLOCK, place - (j + 1) * BLOCK + 1  # starts of a whole block
        first, last = np.maximum(begin, far), np.minimum(end, near)
        held = np.flatnonzero(first <= last)
        key = rolling.of(near[held], far[held] + depth)
        ahead = (place - first)[held]
        whole = byte_text.keys_of(rolling.of(first[held], last[held] + depth) + ahead.astype(np.uint64), 24)
        rows.append((byte_text.keys_of(key + np.uint64(j), 25), whole, first[held], last[held], ahead))
    return tuple(np.concatenate(x) for x in zip(*rows))


def pieces(texts: pa.Array, depth: int) -> Iterator[tuple[int, int, np.ndarray]]:
    """(row, position of the first byte, bytes) of texts, long ones in overlapping parts that have each suffix of ``depth`` bytes once."""
    for first, stop, data, offsets in byte_text.chunks(texts):
        for row in range(first, stop):
            text = data[offsets[row - first]:offsets[row - first + 1]]
            for at in range(0, max(1, len(text) - depth + 1), PIECE):
                yield row, at, text[at:at + PIECE + depth - 1]


def identified(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """``(mark, id, text)``: what names a row, also where ids are null or repeated."""
    return docs.select(F.xxhash64(F.col(doc_id), F.col(text)).alias("mark"), F.coalesce(F.col(doc_id).cast("long"), F.lit(-(1 << 63))).alias("id"),
                       F.coalesce(F.col(text), F.lit("")).alias("text"))


BLOCKS = "key bigint, whole bigint, mark bigint, id bigint, first bigint, last bigint, ahead int, n bigint, more array<struct<first:bigint,last:bigint>>"
BLOCKS_ARROW = pa.schema([*((c, pa.int64()) for c in ("key", "whole", "mark", "id", "first", "last")), ("ahead", pa.int32()), ("n", pa.int64()),
                          ("more", pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())])))])


def collapsed(key: np.ndarray, whole: np.ndarray, first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray, list]:
    """Of blocks of one text that agree in both digits the first stays: (rows that stay, number of blocks, all their ranges, joined).

    Text that repeats itself at short distance has a block for every few bytes, all alike.
    """
    order = np.lexsort((first, whole, key))
    fresh = np.concatenate(([True], (key[order][1:] != key[order][:-1]) | (whole[order][1:] != whole[order][:-1])))
    cuts = np.append(np.flatnonzero(fresh), len(order))
    counts, more = np.diff(cuts), [None] * (len(cuts) - 1)
    for g in np.flatnonzero(counts > 1).tolist():
        own = order[cuts[g]:cuts[g + 1]]
        apart = np.flatnonzero(first[own][1:] > last[own][:-1] + 1)
        begin, end = np.concatenate(([0], apart + 1)), np.append(apart, len(own) - 1)
        more[g] = [{"first": a, "last": z} for a, z in zip(first[own[begin]].tolist(), last[own[end]].tolist())]
    return order[cuts[:-1]], counts, more


def suffix_blocks(rows: DataFrame, depth: int) -> DataFrame:
    """The blocks of all texts."""
    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            marks, ids = part.column(0).to_numpy(), part.column(1).to_numpy()
            held, size = [], 0
            for row, at, data in [*pieces(part.column(2), depth), (-1, 0, None)]:
                if data is not None and len(data) >= depth:
                    key, whole, first, last, ahead = blocks_of(data, depth)
                    first, last = first + at, last + at
                    kept, counts, more = collapsed(key, whole, first, last)
                    held.append((key[kept].view(np.int64), whole[kept].view(np.int64), np.full(len(kept), marks[row]), np.full(len(kept), ids[row]),
                                 first[kept], last[kept], ahead[kept].astype(np.int32), counts, more))
                    size += len(kept)
                if held and (row < 0 or size > 50_000):
                    columns = [pa.array(np.concatenate(x)) for x in list(zip(*held))[:-1]]
                    lists = pa.array([m for h in held for m in h[-1]], BLOCKS_ARROW.field("more").type)
                    yield pa.RecordBatch.from_arrays([*columns, lists], schema=BLOCKS_ARROW)
                    held, size = [], 0
    return rows.mapInArrow(batches, BLOCKS)


def contexts(rows: DataFrame, undecided: DataFrame, depth: int) -> DataFrame:
    """The bytes of undecided blocks: ``(key, n, mark, id, first, ahead, bytes)``."""
    spec = "key bigint, n bigint, mark bigint, id bigint, first bigint, ahead int, bytes binary"
    names = [f.split()[0] for f in spec.split(", ")]

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for i in range(part.num_rows):
                text = part.column(2)[i].as_py().encode("utf-8", "replace")
                own = part.column(3)[i].as_py()
                yield pa.RecordBatch.from_arrays(
                    [pa.array([b["key"] for b in own], pa.int64()), pa.array([b["n"] for b in own], pa.int64()), pa.array([part.column(0)[i].as_py()] * len(own), pa.int64()),
                     pa.array([part.column(1)[i].as_py()] * len(own), pa.int64()), pa.array([b["first"] for b in own], pa.int64()), pa.array([b["ahead"] for b in own], pa.int32()),
                     pa.array([text[b["first"]:b["last"] + depth] for b in own], pa.binary())], names)
    per_row = undecided.groupBy("mark", "id").agg(F.collect_list(F.struct("key", "n", "first", "last", "ahead")).alias("blocks"))
    return rows.join(per_row, ["mark", "id"]).select("mark", "id", "text", "blocks").mapInArrow(batches, spec)


def single_suffixes(blocks: list[tuple], depth: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(block, start, digit) of every suffix of some blocks ``(first, ahead, bytes)``."""
    data = np.frombuffer(b"".join(b[2] for b in blocks), np.uint8)
    sizes = np.array([len(b[2]) for b in blocks])
    counts = sizes - depth + 1
    owner = np.repeat(np.arange(len(blocks)), counts)
    step = np.arange(int(counts.sum())) - np.repeat(np.cumsum(counts) - counts, counts)
    begin = np.repeat(np.cumsum(sizes) - sizes, counts) + step
    ahead = np.repeat(np.array([b[1] for b in blocks]), counts) - step
    digit = byte_text.keys_of(Rolling(data).of(begin, begin + depth) + ahead.astype(np.uint64), 26)
    return owner, np.repeat(np.array([b[0] for b in blocks]), counts) + step, digit


RANGES = "mark bigint, id bigint, first bigint, last bigint"


def sorted_groups(rows: DataFrame, depth: int) -> DataFrame:
    """Ranges of repeated suffixes of the groups of one key each."""
    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, []

        def close() -> Iterator[pa.RecordBatch]:
            owner, start, digit = single_suffixes([h[3:] for h in held], depth)
            _, which = np.unique(digit, return_inverse=True)
            weight = np.array([h[0] for h in held])
            repeated = np.bincount(which, weights=weight[owner])[which] > 1
            owner, start = owner[repeated], start[repeated]
            if len(owner):
                cut = np.concatenate(([True], (owner[1:] != owner[:-1]) | (start[1:] != start[:-1] + 1)))
                a, z = np.flatnonzero(cut), np.append(np.flatnonzero(cut)[1:], len(cut)) - 1
                marks, ids = np.array([h[1] for h in held]), np.array([h[2] for h in held])
                yield pa.RecordBatch.from_arrays([pa.array(marks[owner[a]]), pa.array(ids[owner[a]]), pa.array(start[a]), pa.array(start[z])], ["mark", "id", "first", "last"])

        for part in parts:
            columns = [part.column(i).to_pylist() for i in range(7)]
            for k, *rest in zip(*columns):
                if k != key and held:
                    yield from close()
                    held = []
                key = k
                held.append(rest)
        if held:
            yield from close()
    return rows.repartition("key").sortWithinPartitions("key").mapInArrow(batches, RANGES)


def dealt_groups(rows: DataFrame, depth: int) -> DataFrame:
    """The same for large groups: single suffixes are dealt by their bytes."""
    spec = "key bigint, digit bigint, n bigint, mark bigint, id bigint, first bigint"

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for at in range(0, part.num_rows, 512):
                columns = [part.column(i).slice(at, 512).to_pylist() for i in range(7)]
                owner, start, digit = single_suffixes(list(zip(*columns[4:])), depth)
                yield pa.RecordBatch.from_arrays([pa.array(np.array(columns[0])[owner]), pa.array(digit.view(np.int64)), *(pa.array(np.array(columns[i])[owner]) for i in (1, 2, 3)),
                                                  pa.array(start)], [f.split()[0] for f in spec.split(", ")])
    single = rows.mapInArrow(batches, spec)
    twice = single.groupBy("key", "digit").agg(F.sum("n").alias("all")).filter(F.col("all") > 1).select("key", "digit")
    return single.join(twice, ["key", "digit"]).select("mark", "id", "first", F.col("first").alias("last"))


def merged(ranges):
    """Disjoint ranges, in order, of sorted ``(start, end)``."""
    state = F.array().cast("array<struct<start:bigint,end:bigint>>")

    def step(acc, x):
        last = F.get(acc, F.size(acc) - 1)
        joined = F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(F.struct(last["start"].alias("start"), F.greatest(last["end"], x["end"]).alias("end"))))
        return F.when((F.size(acc) > 0) & (last["end"] >= x["start"]), joined).otherwise(F.concat(acc, F.array(x)))
    return F.aggregate(ranges, state, step)


def repeated_spans(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", depth: int = DEPTH) -> DataFrame:
    """``(mark, id, spans)``: byte ranges covered by repeated strings, for the rows that have any."""
    rows = identified(docs, doc_id, text)
    blocks = suffix_blocks(rows, depth)
    shared = blocks.select("key", "n").groupBy("key").agg(F.sum("n").alias("n")).filter("n > 1").select("key")
    again = stored(blocks.join(shared, "key"), "blocks")
    alike = again.groupBy("key", "whole").agg(F.sum("n").alias("n"), F.min(F.struct("mark", "id", "first", "last", "ahead")).alias("one"))
    alike = stored(alike, "alike")
    own = F.coalesce("more", F.array(F.struct("first", "last")))
    decided = (again.join(alike.filter("n > 1").select("key", "whole"), ["key", "whole"]).select("mark", "id", F.explode(own).alias("range"))
               .select("mark", "id", "range.first", "range.last"))
    # one block of each kind stands for its kind
    kinds = alike.groupBy("key").agg(F.count("*").alias("kinds")).filter("kinds > 1")
    undecided = alike.join(kinds, "key").select("key", "kinds", F.least("n", F.lit(2)).cast("long").alias("n"), "one.*")
    found = stored(contexts(rows, undecided.drop("kinds"), depth).join(kinds, "key"), "contexts")
    columns = ["key", "n", "mark", "id", "first", "ahead", "bytes"]
    small = sorted_groups(found.filter(F.col("kinds") <= LARGE_GROUP).select(*columns), depth)
    large = dealt_groups(found.filter(F.col("kinds") > LARGE_GROUP).select(*columns), depth)
    starts = decided.unionByName(small).unionByName(large)
    return (starts.groupBy("mark", "id").agg(F.array_sort(F.collect_set(F.struct(F.col("first").alias("start"), (F.col("last") + depth).alias("end")))).alias("all"))
            .select("mark", "id", merged(F.col("all")).alias("spans")))


def remove(docs: DataFrame, spans: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Add ``n_bytes``, ``spans`` and ``kept``, the bytes outside the spans; a text's other copies are removed as well."""
    added = ("n_bytes", "spans", "kept")
    rest = [c for c in docs.columns if c not in added]
    rows = (docs.select(*rest).withColumns({"_mark": F.xxhash64(F.col(doc_id), F.col(text)), "_id": F.coalesce(F.col(doc_id).cast("long"), F.lit(-(1 << 63)))})
            .join(spans.select(F.col("mark").alias("_mark"), F.col("id").alias("_id"), "spans"), ["_mark", "_id"], "left")
            .select(*rest, F.coalesce("spans", F.array().cast("array<struct<start:bigint,end:bigint>>")).alias("spans")))
    raw = F.coalesce(F.col(text).cast("binary"), F.lit("").cast("binary"))
    cuts = F.concat(F.array(F.lit(0).cast("long")), F.flatten(F.transform("spans", lambda s: F.array(s["start"], s["end"]))), F.array(F.octet_length(raw).cast("long")))
    kept = F.aggregate(F.sequence(F.lit(0), F.size("spans")), F.lit("").cast("binary"), lambda acc, i: F.concat(
        acc, F.substr(F.col("_raw"), (F.get(F.col("_cuts"), 2 * i) + 1).cast("int"), (F.get(F.col("_cuts"), 2 * i + 1) - F.get(F.col("_cuts"), 2 * i)).cast("int"))))
    return (rows.withColumns({"_raw": raw, "_cuts": cuts}).withColumns({"n_bytes": F.octet_length("_raw").cast("long"), "kept": kept}).drop("_raw", "_cuts"))
