"""BPE encoding and decoding: speculate and verify.

Greedy longest match proposes the tokens of a word.  A proposal is the BPE result exactly if each token merges to itself
and no merge fires across any boundary between neighbours; whether one fires depends on the two neighbours alone.  That test
is vectorised: for all new neighbour pairs of a batch at once, along the last pieces of the left token and the first pieces of
the right one.  Only words that fail are merged step by step.

White space always ends a word, so a text is looked up run by run between white space; runs that were met before are remembered with their ids.

Merge across a boundary: pieces x (left) and y (right) meet when both exist and neither has
been merged further.  So a rule (x, y) of rank m fires if m is below the rank that makes x part of the next larger
piece, and not above the one that does so for y (of equal rules the leftmost goes first).

The tokenizer file is read once by the driver and broadcast: its size is that of one vocabulary.

Defined cases: a null text is an empty text, without tokens; repeated rows are encoded alike; other columns pass through,
``ids`` and ``decoded`` are replaced; a text of any length is encoded whole.
"""

from __future__ import annotations

import json
import unicodedata
from itertools import chain
from typing import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, SparkSession, functions as F

from savora.llm.common import kept_by_worker, tidy

NO_RANK = 1 << 40
NEVER = np.int64(NO_RANK)
REMEMBERED_WORDS = 400_000
TEXTS_AT_ONCE = 256
NOT_WHITE = regex.compile("[\x1c-\x1f]")
# \s as the tokenizer's pattern has it
SPACE = r"\t-\r\x20\x85\xa0  -     　"


def byte_letters() -> list[str]:
    """The letter that stands for each byte: printable ones stand for themselves."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    letters, extra = {b: chr(b) for b in printable}, 0x100
    for b in range(256):
        if b not in letters:
            letters[b], extra = chr(extra), extra + 1
    return [letters[b] for b in range(256)]


class SpeculativeBpe:
    """Encoder and decoder of one tokenizer file."""

    def __init__(self, spec: dict, remembered: int | None = None):
        """``remembered`` bounds the words whose tokens are kept in memory between texts."""
        self.remembered = remembered or REMEMBERED_WORDS
        model = spec["model"]
        pre = spec["pre_tokenizer"]["pretokenizers"]
        if (model["type"], spec["decoder"], spec["post_processor"], model["continuing_subword_prefix"], pre[0]["invert"]) != ("BPE", None, None, None, True):
            raise ValueError("only BPE files with a pattern of pieces, and without decoder and post-processor")
        self.suffix = model["end_of_word_suffix"] or ""
        self.vocab: dict[str, int] = dict(model["vocab"])
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.names = {i: t for t, i in (self.vocab | self.added).items()}
        self.letters = byte_letters()
        self.pieces = regex.compile(pre[0]["pattern"]["Regex"].replace(r"\s", SPACE))
        self.special = regex.compile("|".join(map(regex.escape, sorted(self.added, key=len, reverse=True)))) if self.added else None
        # length of the longest token that begins with these letters
        self.reach: dict[str, int] = {}
        for token in self.vocab:
            letters = token.removesuffix(self.suffix)
            for k in range(1, min(len(letters), 3) + 1):
                self.reach[letters[:k]] = max(self.reach.get(letters[:k], 0), len(letters))
        pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        self.rank = {p: i for i, p in enumerate(pairs)}
        self._tables(pairs)
        self.white = regex.compile(f"[{SPACE}]+")
        self.known: dict[int, bool] = {}
        self.words: dict[str, tuple[int, ...]] = {}
        self._forget_runs()

    def _forget_runs(self) -> None:
        """Runs between white space: their places, and the ids of each one after the other.  The first ones are the added tokens."""
        self.runs: dict[str | int, int] = {i: place for place, i in enumerate(self.added.values())}
        self.flat, self.bounds = np.array(list(self.added.values()), np.int32), np.arange(len(self.added) + 1)

    def _tables(self, pairs: list[tuple[str, str]]) -> None:
        n = max(self.vocab.values()) + 1
        left = np.array([self.vocab[a] for a, _ in pairs], np.int64)
        right = np.array([self.vocab[b] for _, b in pairs], np.int64)
        made = np.array([self.vocab[a + b] for a, b in pairs], np.int64)
        keys = left * n + right
        order = np.argsort(keys, kind="stable")
        self.n, self.keys, self.key_ranks = n, keys[order], order.astype(np.int64)
        self.rank_of = np.full(n + 1, -1, np.int64)  # the last entry stands for no token
        child = {"left": np.full(n + 1, n, np.int64), "right": np.full(n + 1, n, np.int64)}
        self.rank_of[made], child["left"][made], child["right"][made] = np.arange(len(made)), left, right
        self.edge = {}
        for side, step in child.items():
            levels = [np.arange(n + 1)]
            while (levels[-1] < n).any():
                levels.append(step[levels[-1]])
            self.edge[side] = levels[:-1]
        # a token merges to itself if its halves do, and the rule that joins them is the first to fire between them
        self.valid = np.ones(n + 1, bool)
        first = self._first_merge(left, right)
        for i, (a, b, t) in enumerate(zip(left.tolist(), right.tolist(), made.tolist())):
            self.valid[t] = self.valid[a] and self.valid[b] and first[i] == i

    def _merge_ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        keys = np.where((a < self.n) & (b < self.n), a * self.n + b, -1)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.key_ranks[at], NEVER)

    def _first_merge(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of the first merge across the boundary of each pair; NEVER if there is none."""
        first = np.full(len(a), NEVER)
        above_x = np.full(len(a), NEVER)
        for right_edge in self.edge["right"]:
            x = right_edge[a]
            above_y = np.full(len(a), NEVER)
            for left_edge in self.edge["left"]:
                y = left_edge[b]
                m = self._merge_ranks(x, y)
                first = np.where((m < above_x) & (m <= above_y) & (m < first), m, first)
                above_y = np.where(y < self.n, self.rank_of[y], -1)
            above_x = np.where(x < self.n, self.rank_of[x], -1)
        return first

    def _propose(self, symbols: str) -> list[int]:
        """Greedy longest match over the letters of a word; the last token carries the suffix."""
        out, at, end, vocab, reach, suffix = [], 0, len(symbols), self.vocab, self.reach, self.suffix
        while at < end:
            far = reach.get(symbols[at:at + 3]) or reach.get(symbols[at:at + 2]) or 1
            for stop in range(min(end, at + far), at, -1):
                token = vocab.get(symbols[at:] + suffix if stop == end else symbols[at:stop])
                if token is not None:
                    out.append(token)
                    at = stop
                    break
            else:
                at += 1  # a letter without a token gives none
        return out

    def _merged(self, symbols: str) -> list[int]:
        """Exact merging: the lowest rank first, of equal ones the leftmost."""
        parts = [p for p in (*symbols[:-1], symbols[-1] + self.suffix) if p in self.vocab]
        get = self.rank.get
        ranks = [get(p, NO_RANK) for p in zip(parts, parts[1:])]
        while ranks and (best := min(ranks)) < NO_RANK:
            at = ranks.index(best)
            parts[at:at + 2] = [joined := parts[at] + parts[at + 1]]
            del ranks[at]
            if at:
                ranks[at - 1] = get((parts[at - 1], joined), NO_RANK)
            if at < len(ranks):
                ranks[at] = get((joined, parts[at + 1]), NO_RANK)
        return [self.vocab[p] for p in parts]

    def _learn(self, words: set[str]) -> None:
        """Encode new words together."""
        letters = self.letters
        words = list(words)
        symbols = [w if w.isascii() and w.isprintable() else "".join([letters[b] for b in w.encode("utf-8", "replace")]) for w in words]
        proposals = [self._propose(s) for s in symbols]
        sizes = np.array([len(p) for p in proposals], np.int64)
        flat = np.fromiter((t for p in proposals for t in p), np.int64, int(sizes.sum()))
        owner = np.repeat(np.arange(len(words)), sizes)
        good = np.ones(len(words), bool)
        good[owner[~self.valid[flat]]] = False
        inside = owner[1:] == owner[:-1]
        pairs = (flat[:-1] * self.n + flat[1:])[inside]
        distinct, which = np.unique(pairs, return_inverse=True)
        fits = np.array([self.known.get(k) for k in distinct.tolist()], object)
        new = np.flatnonzero(fits == None)  # noqa: E711
        if len(new):
            keys = distinct[new]
            fits[new] = self._first_merge(keys // self.n, keys % self.n) == NEVER
            if len(self.known) > self.remembered // 3:
                self.known.clear()
            self.known.update(zip(keys.tolist(), fits[new].tolist()))
        good[owner[1:][inside][~fits.astype(bool)[which]]] = False
        for word, s, proposal, ok in zip(words, symbols, proposals, good.tolist()):
            self.words[word] = tuple(proposal if ok else self._merged(s))

    def split(self, text: str) -> list[str]:
        """The runs between white space of a text without added tokens, after normalisation."""
        if not text.isascii():
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")  # letters are lowered one by one: no final sigma
        text = text.lower()
        # str.split takes four control characters for white space, the tokenizer does not
        return [r for r in self.white.split(text) if r] if NOT_WHITE.search(text) else text.split()

    def _meet(self, new: list[str]) -> None:
        """Ids of new runs."""
        if len(self.words) > self.remembered:
            self.words.clear()
        cut = [self.pieces.findall(r) for r in new]
        if fresh := set(chain.from_iterable(cut)).difference(self.words):
            self._learn(fresh)
        known = self.words
        ids = [list(chain.from_iterable(map(known.__getitem__, words))) for words in cut]
        sizes = np.fromiter(map(len, ids), np.int64, len(ids))
        self.runs.update(zip(new, range(len(self.runs), len(self.runs) + len(new))))
        self.flat = np.concatenate((self.flat, np.fromiter(chain.from_iterable(ids), np.int32, int(sizes.sum()))))
        self.bounds = np.concatenate((self.bounds, self.bounds[-1] + np.cumsum(sizes)))

    def encode_flat(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(token ids of all texts one after the other, number of tokens of each)."""
        jobs: list[list[str | int]] = []
        for text in texts:
            runs: list[str | int] = []
            at = 0
            for m in (self.special.finditer(text) if self.special and "<" in text else ()):
                runs += [*self.split(text[at:m.start()]), self.added[m[0]]]
                at = m.end()
            jobs.append(runs + self.split(text[at:]) if at else self.split(text))
        if len(self.runs) > self.remembered:
            self._forget_runs()
        if new := set(chain.from_iterable(jobs)).difference(self.runs):
            self._meet(list(new))
        counts = np.fromiter(map(len, jobs), np.int64, len(jobs))
        places = np.fromiter(map(self.runs.__getitem__, chain.from_iterable(jobs)), np.int64, int(counts.sum()))
        sizes = self.bounds[places + 1] - self.bounds[places]
        behind = np.cumsum(sizes)
        flat = self.flat[np.repeat(self.bounds[places] - behind + sizes, sizes) + np.arange(int(sizes.sum()))]
        upto = np.concatenate((np.zeros(1, np.int64), behind))[np.concatenate((np.zeros(1, np.int64), np.cumsum(counts)))]
        return flat, np.diff(upto)

    def encode_batch(self, texts: list[str]) -> list[list[int]]:
        """Token ids of each text."""
        flat, counts = self.encode_flat(texts)
        return [part.tolist() for part in np.split(flat, np.cumsum(counts)[:-1])] if len(texts) else []

    def decode(self, ids: list[int]) -> str:
        """The tokens, special ones included, joined by blanks: the file names no decoder."""
        return " ".join(map(self.names.__getitem__, ids))


def load(raw: bytes, remembered: int | None = None) -> SpeculativeBpe:
    """The tokenizer of a file's content, with the words its worker has met; a bound on the words means that they go with the task."""
    if remembered:
        return SpeculativeBpe(json.loads(raw), remembered)
    return kept_by_worker(f"bpe {hash(raw)} {remembered}", lambda: SpeculativeBpe(json.loads(raw), remembered))


def names_of(raw: bytes) -> pa.Array:
    """The token of each id, the added ones included."""
    def read() -> pa.Array:
        spec = json.loads(raw)
        by_id = {i: t for t, i in spec["model"]["vocab"].items()} | {t["id"]: t["content"] for t in spec["added_tokens"]}
        return pa.array([by_id.get(i) for i in range(max(by_id) + 1)], pa.string())
    return kept_by_worker(f"bpe names {hash(raw)}", read)


def read_file(spark: SparkSession, path: str):
    with open(path, "rb") as f:
        return spark.sparkContext.broadcast(f.read())


def _mapped(docs: DataFrame, column: str, kind: str, source: str, start: Callable[[], Callable[[pa.Array], pa.Array]]) -> DataFrame:
    """Add a column; ``start`` gives a task what converts the arrays of its batches."""
    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        convert = start()
        for part in parts:
            for at in range(0, part.num_rows, TEXTS_AT_ONCE):
                piece = part.slice(at, TEXTS_AT_ONCE)
                names = piece.schema.names
                kept = [i for i, n in enumerate(names) if n != column]
                made = convert(piece.column(names.index(source)))
                yield pa.RecordBatch.from_arrays([*(piece.column(i) for i in kept), made], [*(names[i] for i in kept), column])
    return docs.mapInArrow(tidy(batches), docs.drop(column).withColumn(column, F.lit(None).cast(kind)).schema)


def encode(docs: DataFrame, path: str, text: str = "text", remembered: int | None = None) -> DataFrame:
    """Add ``ids``, the token ids of the whole text.  Fewer ``remembered`` words take less memory and more time."""
    raw = read_file(docs.sparkSession, path)

    def start():
        tokenizer = load(raw.value, remembered)
        return lambda texts: encoded(tokenizer, texts)

    def encoded(tokenizer: SpeculativeBpe, texts: pa.Array) -> pa.Array:
        flat, counts = tokenizer.encode_flat([t or "" for t in texts.to_pylist()])
        return pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(counts))).astype(np.int32)), pa.array(flat))
    return _mapped(docs, "ids", "array<int>", text, start)


def decode(encoded: DataFrame, path: str, ids: str = "ids") -> DataFrame:
    """Add ``decoded``, the text of the token ids."""
    raw = read_file(encoded.sparkSession, path)

    def start():
        names = names_of(raw.value)
        return lambda rows: decoded(names, rows)

    def decoded(names: pa.Array, rows: pa.Array) -> pa.Array:
        flat, sizes = rows.flatten(), pc.fill_null(pc.list_value_length(rows), 0).to_numpy()
        tokens = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)), names.take(flat))
        return pc.binary_join(tokens, " ")
    return _mapped(encoded, "decoded", "string", ids, start)
