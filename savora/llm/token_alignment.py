"""Alignment of the tokens of two tokenizers over the same bytes, and how often their ids meet in the corpus.

1. Galloping intersection: of the two ascending lists of token ends the shorter drives an exponential, then a binary search into the longer.  Ends in
   both lists cut the text into groups; the difference of successive places found is the range of tokens that a token overlaps: its links.
2. Both tokenizers always cut before a blank that follows something else than white space, so a text is a row of units.  Units that a worker has
   met are remembered with their groups and links, new ones are laid end to end and intersected together.
3. A chunk of documents is stored as its distinct pairs of ids, the pairs of each distinct unit and the units of each document.  Pairs are summed over the
   corpus, and the sums go back to a chunk once per distinct pair of it, not once per document or link.

The byte-level tokenizer runs with tiktoken on the ranks of its file, the other one with sentencepiece.  Both files are read by the driver and
broadcast: their size is that of a vocabulary.  A B id pairs with at most all A ids, which bounds the group its maximum is taken over.

Defined cases: a null or empty text, or one whose tokens do not spell blank + text (it holds U+2581), has no tokens, zeros and the groups '';
special tokens inside texts are plain text; repeated rows, also of one id, count and are listed each; a null id is kept; a long text is cut between units;
other columns are not read; no rows give no rows.
"""

from __future__ import annotations

import hashlib
import json
import re
from itertools import chain
from typing import Iterator

import numpy as np
import pyarrow as pa
import sentencepiece
import tiktoken
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from savora.llm.bpe_speculate import byte_letters, read_file
from savora.llm.common import kept_by_worker, stored

# fixed value: how byte-level BPE cuts a text into words
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
CUT = re.compile(r"(?<=\S) ")
INK = re.compile(r"\S")
BLANK_BEHIND_WHITE = re.compile(r"[^\S ] ")

SEARCHED_AT_ONCE = 1024
REMEMBERED_UNITS = 200_000
UNITS_PER_CHUNK = 1 << 21
PART = 1 << 20
SUMS = ("n_a", "n_b", "n_groups", "n_links")
DOCUMENT = "row bigint, doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, units bigint, groups_sha256 string"
CHUNK = f"chunk bigint, documents array<struct<{re.sub(r'(\w+) (\w+)', r'\1:\2', DOCUMENT)}>>, order binary, unit_links binary, unit_sizes binary, pairs array<bigint>, times array<bigint>"
_TYPES = {"bigint": pa.int64(), "string": pa.string(), "binary": pa.binary(), "array<bigint>": pa.list_(pa.int64())}
DOCUMENT_TYPE = pa.struct([(n, _TYPES[t]) for n, t in (f.split() for f in DOCUMENT.split(", "))])
CHUNK_SCHEMA = pa.schema([("chunk", pa.int64()), ("documents", pa.list_(DOCUMENT_TYPE)), ("order", pa.binary()), ("unit_links", pa.binary()),
                          ("unit_sizes", pa.binary()), ("pairs", pa.list_(pa.int64())), ("times", pa.list_(pa.int64()))])


def gallop(short: np.ndarray, long: np.ndarray) -> np.ndarray:
    """First place in ``long`` that is not below each number of ``short``; both ascend.

    Each search begins where the block of numbers before has ended: steps double until they pass the number, halving closes in.
    """
    found = np.empty(len(short), np.int64)
    padded = np.append(long, np.iinfo(np.int64).max)
    last, at = len(long), 0
    for first in range(0, len(short), SEARCHED_AT_ONCE):
        x = short[first:first + SEARCHED_AT_ONCE]
        low = np.full(len(x), at)
        high, step = low.copy(), 1
        while (below := padded[high] < x).any():
            low[below] = high[below] + 1
            high[below] = np.minimum(high[below] + step, last)
            step *= 2
        while (low < high).any():
            middle = (low + high) // 2
            below = padded[middle] < x
            low, high = np.where(below & (low < high), middle + 1, low), np.where(below, high, np.minimum(middle, high))
        found[first:first + len(x)] = low
        at = int(low[-1])
    return found


def align(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(A tokens up to each common end, B tokens likewise, A place of each link, B place) of two lists of ends with the same last one."""
    swapped = len(ends_a) > len(ends_b)
    short, long = (ends_b, ends_a) if swapped else (ends_a, ends_b)
    place = gallop(short, long)
    common = long[place] == short if len(short) else np.zeros(0, bool)
    begin = np.concatenate((np.zeros(1, np.int64), place + common))[:-1]
    width = place - begin + 1
    one = np.repeat(np.arange(len(short)), width)
    other = np.arange(len(one)) - np.repeat(np.cumsum(width) - width, width) + np.repeat(begin, width)
    upto = np.flatnonzero(common) + 1, place[common] + 1
    return (*upto[::-1], other, one) if swapped else (*upto, one, other)


def units(text: str) -> list[str]:
    """The text, cut before each blank that follows something else than white space; that blank, and the one put before the text, is left out."""
    parts = text.split(" ")
    if "" not in parts and not BLANK_BEHIND_WHITE.search(text):
        return parts
    text = " " + text
    cuts = [0, *(m.start() for m in CUT.finditer(text)), len(text)]
    if len(cuts) > 2 and not INK.search(text, cuts[-2]):
        del cuts[-2]
    return [text[a + 1:z] for a, z in zip(cuts, cuts[1:])]


def parts_of(text: str) -> Iterator[str]:
    """A long text in parts, each a row of whole units."""
    at = 0
    while len(text) - at > PART and (cut := CUT.search(text, at + PART)) and INK.search(text, cut.start()):
        yield text[at:cut.start()]
        at = cut.start() + 1
    yield text[at:] if at else text


def _gathered(flat: np.ndarray, bounds: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Runs of ``flat`` one after the other, and their sizes."""
    sizes = bounds[which + 1] - bounds[which]
    return flat[np.repeat(bounds[which] - np.cumsum(sizes) + sizes, sizes) + np.arange(int(sizes.sum()))], sizes


def _bounds(sizes: np.ndarray) -> np.ndarray:
    return np.concatenate((np.zeros(1, np.int64), np.cumsum(sizes, dtype=np.int64)))


def _totals(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Sum of each run."""
    upto = _bounds(values)
    bounds = _bounds(sizes)
    return upto[bounds[1:]] - upto[bounds[:-1]]


class Aligner:
    """Both tokenizers, and the units its worker has met."""

    def __init__(self, byte_bpe: bytes, pieces: bytes):
        model = json.loads(byte_bpe)["model"]
        byte_of = {letter: b for b, letter in enumerate(byte_letters())}
        ranks = {bytes(map(byte_of.__getitem__, token)): i for token, i in model["vocab"].items()}
        made = [bytes(map(byte_of.__getitem__, "".join(m if isinstance(m, list) else m.split(" ")))) for m in model["merges"]]
        if [ranks[t] for t in made] != list(range(len(ranks) - len(made), len(ranks))):
            raise ValueError("ids must follow the order of the merges")
        self.bytes_a = {i: t for t, i in ranks.items()}
        self.a = tiktoken.Encoding("byte_bpe", pat_str=WORDS, mergeable_ranks=ranks, special_tokens={})
        self.b = sentencepiece.SentencePieceProcessor(model_proto=pieces)
        names = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        if any(re.search("[^▁]▁", n) for n in names):
            raise ValueError("pieces must not reach across blanks")
        self.bytes_b = [bytes([int(n[3:5], 16)]) if self.b.is_byte(i) else n.replace("▁", " ").encode() for i, n in enumerate(names)]
        self.forget()

    def forget(self) -> None:
        self.place: dict[str, int] = {}
        self.texts: list[str] = []
        self.numbers = np.zeros((0, len(SUMS)), np.int64)
        self.links, self.link_bounds = np.zeros(0, np.int64), np.zeros(1, np.int64)
        self.bad: set[int] = set()

    def learn(self, new: list[str]) -> None:
        """Tokens, groups and links of new units; bad ones are not spelt by their tokens and have none."""
        ids_a = [self.a.encode_ordinary(" " + u) for u in new]
        ids_b = self.b.encode(new, num_threads=1)
        for i, u in enumerate(new):
            spelt = (" " + u).encode()
            if b"".join(map(self.bytes_a.__getitem__, ids_a[i])) != spelt or b"".join(map(self.bytes_b.__getitem__, ids_b[i])) != spelt:
                self.bad.add(len(self.place) + i)
                ids_a[i], ids_b[i] = [], []
        a, b = list(chain.from_iterable(ids_a)), list(chain.from_iterable(ids_b))
        upto_a, upto_b, link_a, link_b = align(np.cumsum([len(self.bytes_a[i]) for i in a], dtype=np.int64), np.cumsum([len(self.bytes_b[i]) for i in b], dtype=np.int64))
        n_a, n_b = np.array([len(i) for i in ids_a]), np.array([len(i) for i in ids_b])
        groups = np.searchsorted(upto_a, _bounds(n_a), "right")
        links = np.searchsorted(link_a, _bounds(n_a))
        names_a, names_b = list(map(str, a)), list(map(str, b))
        cuts_a, cuts_b = [0, *upto_a.tolist()], [0, *upto_b.tolist()]
        texts = [",".join(names_a[cuts_a[g]:cuts_a[g + 1]]) + "|" + ",".join(names_b[cuts_b[g]:cuts_b[g + 1]]) for g in range(len(upto_a))]
        first = groups.tolist()
        self.texts += [";".join(texts[s:t]) for s, t in zip(first, first[1:])]
        self.place.update(zip(new, range(len(self.place), len(self.place) + len(new))))
        self.numbers = np.concatenate((self.numbers, np.stack((n_a, n_b, np.diff(groups), np.diff(links)), axis=1)))
        self.links = np.concatenate((self.links, np.array(a, np.int64)[link_a] << 32 | np.array(b, np.int64)[link_b]))
        self.link_bounds = np.concatenate((self.link_bounds, self.link_bounds[-1] + links[1:]))

    def meet(self, cuts: list[list[str]]) -> None:
        new = set(chain.from_iterable(cuts)).difference(self.place)
        if new:
            self.learn(list(new))

    def places(self, cut: list[str]) -> np.ndarray | None:
        """The units of a text as places; None if there is none or one is bad."""
        found = np.fromiter(map(self.place.__getitem__, cut), np.int64, len(cut))
        return None if not cut or self.bad and not self.bad.isdisjoint(found.tolist()) else found

    def spelt(self, text: str) -> bool:
        """Whether the tokens of every part of a text spell it."""
        for part in parts_of(text):
            self.meet([cut := units(part)])
            if self.places(cut) is None:
                return False
        return True

    def groups(self, places: np.ndarray) -> str:
        """A ids, a bar, B ids; groups are separated by semicolons."""
        return ";".join(map(self.texts.__getitem__, places.tolist()))


class Chunk:
    """Documents until their units are stored."""

    def __init__(self, aligner: Aligner):
        self.aligner, self.documents, self.places, self.size = aligner, [], [], 0

    def add(self, row: int, doc_id: int | None, places: np.ndarray, digest: str | None) -> None:
        sums = self.aligner.numbers[places].sum(axis=0).tolist()
        self.documents.append((row, doc_id, *sums, len(places), digest))
        self.places.append(places.astype(np.int32))
        self.size += len(places)

    def full(self) -> bool:
        return self.size >= UNITS_PER_CHUNK or len(self.documents) >= UNITS_PER_CHUNK or len(self.aligner.place) > REMEMBERED_UNITS

    def stored(self, number: int) -> pa.RecordBatch:
        known = self.aligner
        distinct, which, times = np.unique(np.concatenate([np.zeros(0, np.int32), *self.places]), return_inverse=True, return_counts=True)
        by_use = np.argsort(-times, kind="stable")  # common units get small numbers, which take fewer bytes
        rank = np.empty(len(by_use), np.int64)
        rank[by_use] = np.arange(len(by_use))
        links, sizes = _gathered(known.links, known.link_bounds, distinct[by_use].astype(np.int64))
        pairs, at = np.unique(links, return_inverse=True)
        held = np.zeros(len(pairs), np.int64)
        np.add.at(held, at, np.repeat(times[by_use], sizes))
        documents = pa.StructArray.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*self.documents), DOCUMENT_TYPE)], fields=list(DOCUMENT_TYPE))
        listed = [pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x) for x in (documents, pa.array(pairs), pa.array(held))]
        blobs = [pa.array([_packed(x)], pa.binary()) for x in (rank[which], at, sizes)]
        self.documents, self.places, self.size = [], [], 0
        return pa.RecordBatch.from_arrays([pa.array([number]), listed[0], *blobs, *listed[1:]], schema=CHUNK_SCHEMA)


def _packed(numbers: np.ndarray) -> bytes:
    """Numbers below 2^32, all their low bytes first."""
    return zstandard.ZstdCompressor(level=1).compress(numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes())


def _unpacked(blob: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8)
    return np.ascontiguousarray(planes.reshape(4, -1).T).view("<u4").ravel().astype(np.int64)


def chunks(docs: DataFrame, byte_bpe: str, pieces: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Documents, aligned and stored in chunks."""
    files = [read_file(docs.sparkSession, path) for path in (byte_bpe, pieces)]

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw = [f.value for f in files]
        aligner = kept_by_worker(f"aligner {hash(tuple(raw))}", lambda: Aligner(*raw))
        chunk = Chunk(aligner)
        task, number, row, waiting, size = TaskContext.get().partitionId() << 40, 0, 0, [], 0

        def emptied() -> Iterator[pa.RecordBatch]:
            nonlocal number
            if chunk.documents:
                yield chunk.stored(task + number)
                number += 1
            if len(aligner.place) > REMEMBERED_UNITS:
                aligner.forget()

        def settled() -> Iterator[pa.RecordBatch]:
            """Short texts, their new units learnt together."""
            aligner.meet([cut for _, _, cut in waiting])
            for number, key, cut in waiting:
                places = aligner.places(cut)
                if places is None:
                    chunk.add(number, key, np.zeros(0, np.int64), "")
                else:
                    chunk.add(number, key, places, hashlib.sha256(aligner.groups(places).encode()).hexdigest())
            waiting.clear()
            if chunk.full():
                yield from emptied()

        for part in parts:
            for key, text in zip(part.column(0).to_pylist(), part.column(1)):
                row, text = row + 1, text.as_py() or ""
                if len(text) <= PART or not aligner.spelt(text):
                    waiting.append((task + row, key, units(text) if 0 < len(text) <= PART else []))
                    size += len(text)
                    if size > PART:
                        yield from settled()
                        size = 0
                    continue
                yield from settled()
                digest, pieces = hashlib.sha256(), parts_of(text)
                piece = next(pieces)
                while piece is not None:
                    after = next(pieces, None)
                    aligner.meet([cut := units(piece)])
                    places = aligner.places(cut)
                    digest.update(aligner.groups(places).encode() + (b"" if after is None else b";"))
                    chunk.add(task + row, key, places, digest.hexdigest() if after is None else None)
                    if chunk.full():
                        yield from emptied()
                    piece = after
        yield from settled()
        yield from emptied()
    return stored(docs.select(F.col(f"`{doc_id}`").cast("long"), F.col(f"`{text}`")).toDF("doc_id", "text").mapInArrow(batches, CHUNK), "aligned")


def link_counts(aligned: DataFrame) -> DataFrame:
    """``(a, b, links, best)`` of every pair of ids that any token pair links; ``best`` marks the highest of a B id, ties included."""
    counts = (aligned.select(F.explode(F.arrays_zip("pairs", "times")).alias("p")).groupBy(F.col("p.pairs").alias("pair")).agg(F.sum("p.times").alias("links"))
              .select(F.shiftright("pair", 32).cast("int").alias("a"), F.col("pair").bitwiseAND(F.lit(0xFFFFFFFF)).cast("int").alias("b"), "links"))
    return counts.withColumn("best", F.col("links") == F.max("links").over(Window.partitionBy("b")))


def documents(aligned: DataFrame, counts: DataFrame) -> DataFrame:
    """One row per document: ``doc_id``, numbers of tokens, groups and links, ``n_best``, ``count_sum`` and the digest of the groups."""
    spec = DOCUMENT.replace(", units bigint", "") + ", n_best bigint, count_sum bigint"
    schema = pa.schema([(n, _TYPES[t]) for n, t in (f.split() for f in spec.split(", "))])

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for i in range(part.num_rows):
                row = part.slice(i, 1)
                docs, found = row.column(0).flatten(), row.column(4).flatten()
                order, links, sizes = (_unpacked(row.column(k)[0].as_py()) for k in (1, 2, 3))
                by_pair = np.argsort(found.field(0).to_numpy())
                units_in = docs.field(6).to_numpy()
                sums = []
                for values in (found.field(2).cast(pa.int64()), found.field(1)):
                    per_unit = _totals(values.to_numpy()[by_pair][links], sizes)
                    sums.append(pa.array(_totals(per_unit[order], units_in)))
                yield pa.RecordBatch.from_arrays([docs.field(k) for k in range(8) if k != 6] + sums, schema=schema)
    pair = F.shiftleft(F.col("a").cast("long"), 32).bitwiseOR(F.col("b").cast("long"))
    asked = aligned.select("chunk", F.explode_outer("pairs").alias("pair")).join(counts.select(pair.alias("pair"), "links", "best"), "pair", "left")
    found = asked.groupBy("chunk").agg(F.collect_list(F.when(F.col("pair").isNotNull(), F.struct("pair", "links", "best"))).alias("found"))
    rows = aligned.drop("pairs", "times").join(found, "chunk").select("documents", "order", "unit_links", "unit_sizes", "found").mapInArrow(batches, spec)
    sums = [F.sum(c).alias(c) for c in (*SUMS, "n_best", "count_sum")]
    return rows.groupBy("row").agg(F.first("doc_id").alias("doc_id"), *sums, F.max("groups_sha256").alias("groups_sha256")).drop("row")
