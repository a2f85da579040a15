"""Benchmark decontamination: a BM25 index of the test items, asked by every passage of every text.

A passage is a window of twice the longest item, moved by the length of that item, so each copy of an item
lies whole in some window.  The score of an item is BM25 over the distinct words of the passage, divided by the score of the
item's own text, so that 1 means all of it.  Every word of an item counts.  Its commonest words, as long as they weigh at most ``SPARE`` of
``threshold`` together, are not looked for but added once the others, the essential ones, weigh what is then still needed: without that the threshold is out of reach.  Block-max WAND
over the essential words finds every item that gets there: the upper bound of a passage is tested for all windows at once, those that pass walk the posting
lists, which are ordered by item and hold the maximum of each block, and skip what cannot reach it.  Retrieved items are verified: the shares
of the question and of the answer that stand in the passage must both reach ``overlap``.  The question is all
of an item but its last sentence, the answer is that sentence; of a single sentence they are its halves.  A share is that of the
word runs, or that of the words that need no edit where the part fits best, so one changed word does not undo all runs around
it.  Two or three words are fitted together with their neighbours in the item, five words in all; a single word must be there.

Items are indexed in blocks of bounded size, one broadcast each, so the benchmark may grow.

Defined cases: a null text is an empty one and matches nothing, an item without words likewise; equal items each
match; every row is kept, repeated rows alike; a text of any length is searched whole, window by window; other columns pass through, ``leaks`` is replaced;
no items give empty ``leaks``, no rows none.
"""

from __future__ import annotations

import pickle
import re
from dataclasses import dataclass
from typing import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame, functions as F

from savora.llm import byte_text
from savora.llm.common import kept_by_worker, slots, stored, tidy

K1, B = 1.2, 0.75
THRESHOLD, OVERLAP = 0.5, 0.7
SPARE = 0.8
RUN = 5
POSTINGS_BLOCK = 64
BLOCK_CHARS = 16 << 20
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
WORD_SQL = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
LEAKS = "array<struct<item_id:bigint,score:double,question_overlap:double,answer_overlap:double,first_word:bigint>>"
LEAKS_ARROW = pa.list_(pa.struct([("item_id", pa.int64()), ("score", pa.float64()), ("question_overlap", pa.float64()),
                                  ("answer_overlap", pa.float64()), ("first_word", pa.int64())]))


def lower(rows: DataFrame, text: str) -> DataFrame:
    """Small letters as Arrow has them, so that items and passages agree on every letter."""
    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            names = part.schema.names
            yield pa.RecordBatch.from_arrays([pc.utf8_lower(part.column(i)) if n == text else part.column(i) for i, n in enumerate(names)], names)
    return rows.mapInArrow(tidy(batches), rows.schema)


def question_and_answer(text: str) -> tuple[list[str], list[str]]:
    sentences = [w for w in (WORD.findall(s) for s in re.split(r"(?<=[.!?])\s+", text)) if w]
    if len(sentences) > 1:
        return [w for s in sentences[:-1] for w in s], sentences[-1]
    words = sentences[0] if sentences else []
    half = (len(words) + 1) // 2
    return words[:half], words[half:] or words


def runs(words: list[str], width: int) -> set[tuple[str, ...]]:
    return {tuple(words[i:i + width]) for i in range(len(words) - width + 1)}


def share_found(wanted: list[str], passage: list[str]) -> float:
    width = min(RUN, len(wanted))
    if not width:
        return 0.0
    part = runs(wanted, width)
    return len(part & runs(passage, width)) / len(part)


def edits(wanted: list[str], passage: list[str]) -> int:
    """Least number of words to change, add or drop so that ``wanted`` stands somewhere in the passage (Myers' bit vectors)."""
    at: dict[str, int] = {}
    for i, w in enumerate(wanted):
        at[w] = at.get(w, 0) | 1 << i
    every, last = (1 << len(wanted)) - 1, 1 << len(wanted) - 1
    up, down, now = every, 0, len(wanted)
    least = now
    for w in passage:
        same = at.get(w, 0)
        cross = same | down
        along = (((same & up) + up) ^ up) | same
        more, less = down | ~(along | up) & every, up & along
        now += bool(more & last) - bool(less & last)
        least = min(least, now)
        more, less = more << 1 & every, less << 1 & every
        up, down = (less | ~(cross | more)) & every, more & cross
    return least


def share_fitted(wanted: list[str], passage: list[str], overlap: float) -> float:
    """Share of the words that need no edit where they fit best; 0 if too few of the words are there at all."""
    held = set(passage)
    if sum(w in held for w in wanted) < overlap * len(wanted):
        return 0.0
    return 1 - edits(wanted, passage) / len(wanted)


def shares_of(question: list[str], answer: list[str], passage: list[str], overlap: float) -> tuple[float, float]:
    """Shares of question and answer in the passage; the answer is not looked for if the question fails."""
    whole = question + answer

    def share(part: list[str], context: list[str]) -> float:
        found = share_found(part, passage)
        if found >= overlap or len(part) < 2:
            return found
        return max(found, share_fitted(part if len(part) > 3 else context, passage, overlap))
    first = share(question, whole[:RUN])
    return first, share(answer, whole[-RUN:]) if first >= overlap else 0.0


@dataclass
class Posting:
    """Items that a word is essential for, with its share of what they need."""

    items: list[int]
    weights: list[float]
    block_max: dict[int, float]
    most: float


class Index:
    """Inverted index of one block of items, their texts in small letters, with statistics of all items."""

    def __init__(self, items: list[tuple[int, str]], df: dict[str, int], total: int, mean_length: float, threshold: float = THRESHOLD, spare: float = SPARE):
        self.threshold = threshold
        self.ids = [i for i, _ in items]
        self.parts = [question_and_answer(t) for _, t in items]
        words = [WORD.findall(t) for _, t in items]
        self.longest = max([1, *map(len, words)])
        postings: dict[str, list[tuple[int, float]]] = {}
        extras: list[dict[str, float]] = []
        self.needs: list[float] = []
        for n, own in enumerate(words):
            counts: dict[str, int] = {}
            for w in own:
                counts[w] = counts.get(w, 0) + 1
            norm = K1 * (1 - B + B * len(own) / max(mean_length, 1.0))
            weights = {w: np.log1p((total - df[w] + 0.5) / (df[w] + 0.5)) * c * (K1 + 1) / (c + norm) for w, c in counts.items()}
            whole = sum(weights.values())
            share = {w: float(weight / whole) for w, weight in weights.items()}
            need, extra = threshold, {}
            for w in sorted(share, key=lambda w: (-df[w], w)):
                if df[w] < 2 or threshold - need + share[w] > spare * threshold:
                    break
                need -= share[w]
                extra[w] = share[w]
            self.needs.append(need)
            extras.append(extra)
            for w, weight in share.items():
                lists = postings.setdefault(w, [])
                if w not in extra:
                    lists.append((n, weight / need))
        terms = sorted(postings)
        joined = [t.encode("utf-8", "replace") for t in terms]
        ends = np.cumsum([len(t) for t in joined], dtype=np.int64)
        data = np.frombuffer(b"".join(joined), np.uint8)
        hashes = byte_text.word_hashes(data, ends - np.array([len(t) for t in joined], np.int64), ends)
        order = np.argsort(hashes)
        self.hashes, self.postings = hashes[order], []
        for i in order.tolist():
            found = postings[terms[i]]
            block_max: dict[int, float] = {}
            for n, weight in found:
                block_max[n // POSTINGS_BLOCK] = max(block_max.get(n // POSTINGS_BLOCK, 0.0), weight)
            self.postings.append(Posting([n for n, _ in found], [w for _, w in found], block_max, max((w for _, w in found), default=0.0)))
        place = {terms[i]: k for k, i in enumerate(order.tolist())}
        self.extras = [[(place[w], weight) for w, weight in extra.items()] for extra in extras]
        self.most = np.array([p.most for p in self.postings] + [0.0])
        self.seen = np.zeros(1 << 16, bool)  # cheap first test of a hash
        self.seen[(self.hashes & np.uint64(0xFFFF)).astype(np.int64)] = True

    def terms(self, hashes: np.ndarray) -> np.ndarray:
        """Number of each word's posting list; the one behind the last means none."""
        out = np.full(len(hashes), len(self.hashes), np.int64)
        maybe = np.flatnonzero(self.seen[(hashes & np.uint64(0xFFFF)).astype(np.int64)])
        at = np.searchsorted(self.hashes, hashes[maybe])
        at[at == len(self.hashes)] = 0
        same = self.hashes[at] == hashes[maybe] if len(self.hashes) else np.zeros(0, bool)
        out[maybe[same]] = at[same]
        return out

    def search(self, terms: list[int]) -> list[tuple[int, float]]:
        """Block-max WAND: all items whose score over the distinct terms reaches the threshold."""
        present = set(terms)
        cursors = [[p.items[0], 0, p] for p in map(self.postings.__getitem__, terms) if p.items]
        found, reach = [], 1 - 1e-9

        def forward(cursor: list, target: int) -> None:
            items, at = cursor[2].items, cursor[1]
            while at < len(items) and items[at] < target:
                at += 1
            cursor[0], cursor[1] = (items[at] if at < len(items) else -1), at

        while cursors:
            cursors.sort(key=lambda c: c[0])
            bound, pivot = 0.0, -1
            for k, (_, _, posting) in enumerate(cursors):
                bound += posting.most
                if bound >= reach:
                    pivot = k
                    break
            if pivot < 0:
                break
            item = cursors[pivot][0]
            while pivot + 1 < len(cursors) and cursors[pivot + 1][0] == item:
                pivot += 1
            block = item // POSTINGS_BLOCK
            if sum(c[2].block_max.get(block, 0.0) for c in cursors[:pivot + 1]) < reach:
                # no item before the block ends or the next list begins can reach it
                target = (block + 1) * POSTINGS_BLOCK
                if pivot + 1 < len(cursors):
                    target = min(target, cursors[pivot + 1][0])
                for c in cursors[:pivot + 1]:
                    forward(c, max(target, item + 1))
            elif cursors[0][0] == item:
                essential = sum(c[2].weights[c[1]] for c in cursors[:pivot + 1])
                if essential >= reach:
                    score = essential * self.needs[item] + sum(weight for t, weight in self.extras[item] if t in present)
                    if score >= self.threshold - 1e-9:
                        found.append((item, min(1.0, score)))
                for c in cursors[:pivot + 1]:
                    forward(c, item + 1)
            else:
                for c in cursors[:pivot]:
                    forward(c, item)
            cursors = [c for c in cursors if c[0] >= 0]
        return found

    def leaks(self, texts: pa.Array, overlap: float) -> list[list[dict]]:
        """Verified items of each text, each with its best passage."""
        out: list[list[dict]] = []
        step, width = self.longest, 2 * self.longest
        for first, stop, data, offsets in byte_text.chunks(pc.utf8_lower(texts.cast(pa.large_string()))):
            starts, ends, bounds = byte_text.words(data, offsets, byte_text.NOT_ALNUM)
            terms = self.terms(byte_text.word_hashes(data, starts, ends))
            total = np.concatenate(([0.0], np.cumsum(self.most[terms])))
            counts = np.diff(bounds)
            n_windows = np.where(counts > 0, np.maximum(1, -(-(counts - width) // step) + 1), 0)
            rows = np.repeat(np.arange(stop - first), n_windows)
            begins = bounds[rows] + step * (np.arange(len(rows)) - np.repeat(np.cumsum(n_windows) - n_windows, n_windows))
            finish = np.minimum(begins + width, bounds[rows + 1])
            found: list[dict[int, dict]] = [{} for _ in range(stop - first)]
            for w in np.flatnonzero(total[finish] - total[begins] >= 1 - 1e-9).tolist():
                a, z = int(begins[w]), int(finish[w])
                known = np.unique(terms[a:z])
                hits = self.search(known[known < len(self.hashes)].tolist())
                if not hits:
                    continue
                passage = [bytes(data[s:e]).decode() for s, e in zip(starts[a:z], ends[a:z])]
                for item, score in hits:
                    question, answer = self.parts[item]
                    shares = shares_of(question, answer, passage, overlap)
                    if min(shares) >= overlap and score > found[rows[w]].get(item, {}).get("score", 0.0):
                        found[rows[w]][item] = {"item_id": self.ids[item], "score": score, "question_overlap": shares[0],
                                                "answer_overlap": shares[1], "first_word": a - int(bounds[rows[w]])}
            out += [[f[i] for i in sorted(f)] for f in found]
        return out


def build_indexes(items: DataFrame, text: str = "text", item: str = "item_id", threshold: float = THRESHOLD, block_chars: int = BLOCK_CHARS) -> Iterator[Index]:
    """Indexes of blocks of items, each of about ``block_chars``; counts are taken over all distinct texts."""
    rows = items.select(F.col(item).cast("long").alias("item_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    held = stored(lower(rows, "text"), "items").select("item_id", "text", F.regexp_extract_all("text", F.lit(WORD_SQL), F.lit(0)).alias("words"))
    totals = held.agg(F.sum(F.length("text")), F.avg(F.size("words"))).first()
    distinct = stored(held.dropDuplicates(["text"]).select(F.explode(F.array_distinct("words")).alias("word"))
                      .groupBy("word").agg(F.count("*").alias("df")), "item-words")
    n_texts = held.select("text").distinct().count()
    n_blocks = slots(totals[0] or 0, block_chars)
    held = held.withColumn("block", F.pmod(F.hash("item_id", "text"), F.lit(n_blocks)))
    for block in range(n_blocks):
        own = held.filter(F.col("block") == block)
        df = {r[0]: r[1] for r in own.select(F.explode("words").alias("word")).distinct().join(distinct, "word").collect()}
        members = [(r[0], r[1]) for r in own.orderBy("item_id", "text").select("item_id", "text").collect()]
        members = [m for m in members if WORD.search(m[1])]
        if members:
            yield Index(members, df, n_texts, totals[1] or 0.0, threshold)


def find_leaks(docs: DataFrame, items: DataFrame, text: str = "text", threshold: float = THRESHOLD, overlap: float = OVERLAP) -> DataFrame:
    """Add ``leaks``, the items whose question and answer stand in a passage of the text."""
    out = docs.drop("leaks").withColumn("leaks", F.array().cast(LEAKS))
    for index in build_indexes(items, threshold=threshold):
        shipped = docs.sparkSession.sparkContext.broadcast(cloudpickle.dumps(index))  # the class travels along: executors need no copy of this package

        def batches(parts: Iterator[pa.RecordBatch], shipped=shipped) -> Iterator[pa.RecordBatch]:
            index = kept_by_worker(f"wand {hash(shipped.value)}", lambda: pickle.loads(shipped.value))
            for part in parts:
                names = part.schema.names
                before = part.column(names.index("leaks")).to_pylist()
                new = index.leaks(part.column(names.index(text)), overlap)
                leaks = pa.array([[*(b or []), *n] for b, n in zip(before, new)], LEAKS_ARROW)
                yield pa.RecordBatch.from_arrays([leaks if n == "leaks" else part.column(i) for i, n in enumerate(names)], names)
        out = out.mapInArrow(tidy(batches), out.schema)
    return out
