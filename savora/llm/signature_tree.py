"""N-gram Jaccard join with signature trees.

Documents are sets of word shingles; two link when the sets' Jaccard similarity is at least ``threshold`` percent.

1. Documents with the same set are one class; only classes are compared.
2. Linked sets share one of their first shingles in any common order (prefix filter).  The order is
   by hash, with frequent shingles last.  Classes that share such a key form a group; groups with the same members are one.
3. Every member of a group is held against the smallest one; what links is joined into components.
4. Groups whose members are not in one component are searched with a signature tree.  Its leaves are the members; a node holds the OR of their
   bitmaps, the range of their sizes and of their components.  The tree is traversed against itself: a pair of nodes is dropped
   if the sizes exclude each other, if both hold one and the same component, or if the bits in common plus
   the shingles that share a bit cannot make the overlap that the smallest sizes need.  A bitmap has two to four bits for each shingle; linked sets
   differ by less than half in size, so only sets of one or of two neighbouring bitmap lengths stand in trees that are traversed together.
5. Surviving pairs are compared exactly.

Shingles are 64-bit hashes; sets are equal when their sizes and 128-bit digests are.  Large groups are cut into tiles, and
pairs of tiles are searched apart, so no group meets in one task.  Only the frequent shingles are
broadcast: at most ``FREQUENT_SHARE`` times the mean size of a document.

Defined cases: a text without words (or null) has no shingles and links with nothing, not even another one; a row with a null id
has its shingles counted, links with nothing and has no component; repeated rows each get the same row; an id is expected to name one text: where texts of one id differ, each
row follows its own; no rows give no rows.
"""

from __future__ import annotations

from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from savora.llm import byte_text
from savora.llm.common import slots, stored, tidy
from savora.llm.components import components

WIDTH = 5
THRESHOLD = 75
LEAST_BITS = 64
FANOUT = 8
TILE = 4096
FREQUENT_SHARE = 2000
KEYS_PER_BUCKET = 1 << 19
BATCH_LEAST = 4
BROADCAST_ROWS = 1_000_000
REMEMBERED_PAIRS = 1_000_000


def least_overlap(size: np.ndarray, threshold: int) -> np.ndarray:
    """Shingles any linked set must share with one of this size."""
    return (threshold * size + 99) // 100


def shingle_sets(texts: pa.Array, width: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of rows with their sets: (first row, behind the last, shingles sorted per row, bounds)."""
    for first, stop, data, offsets in byte_text.chunks(texts):
        starts, ends, bounds = byte_text.words(data, offsets, byte_text.WHITE)
        hashes, begins = byte_text.shingle_hashes(byte_text.word_hashes(data, starts, ends), bounds, width)
        for a, z in zip(begins[:-1].tolist(), begins[1:].tolist()):
            hashes[a:z].sort()
        fresh = np.ones(len(hashes), bool)
        fresh[1:] = hashes[1:] != hashes[:-1]
        fresh[begins[:-1][begins[:-1] < len(hashes)]] = True
        kept = np.concatenate(([0], np.cumsum(fresh)))
        yield first, stop, hashes[fresh], kept[begins]


def digests(sets: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit sums over each set."""
    def sums(x: np.ndarray) -> np.ndarray:
        total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(x, dtype=np.uint64)))
        return byte_text.keys_of(total[bounds[1:]] - total[bounds[:-1]], 5)
    return sums(byte_text.keys_of(sets, 6)), sums(byte_text.keys_of(sets, 7))


def bitmap(shingles: np.ndarray) -> bytes:
    """Bits of the shingles' hashes, in a length that is the next power of two of twice their number."""
    bits = max(LEAST_BITS, 1 << (2 * len(shingles) - 1).bit_length())
    flags = np.zeros(bits, np.uint8)
    flags[(byte_text.keys_of(shingles, 9) & np.uint64(bits - 1)).astype(np.int64)] = 1
    return np.packbits(flags, bitorder="little").tobytes()


def stretched(maps: list[bytes], size: int) -> np.ndarray:
    """Bitmaps as rows of ``size`` bytes; a shorter one is repeated, so that it covers what it covered."""
    return np.frombuffer(b"".join([m * (size // len(m)) for m in maps]), np.uint64).reshape(len(maps), size // 8)


def spare_of(maps: list[bytes], sizes: np.ndarray) -> np.ndarray:
    """Shingles of each set that share a bit with another."""
    return sizes - np.array([int.from_bytes(m, "little").bit_count() for m in maps], np.int64)


def describe(docs: DataFrame, doc_id: str, text: str, width: int) -> DataFrame:
    """Stored rows of two kinds: ``(doc_id, n, low, high, bitmap)`` per document, and ``(shingle, held)`` of shingles seen often in a batch."""
    spec = "doc_id bigint, n bigint, low bigint, high bigint, bitmap binary, shingle bigint, held bigint"
    schema = pa.schema([(name, pa.binary() if kind == "binary" else pa.int64()) for name, kind in (f.split() for f in spec.split(", "))])

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            ids, seen, often = part.column(0), set(), []
            for first, stop, sets, bounds in shingle_sets(part.column(1), width):
                low, high = digests(sets, bounds)
                none = pa.nulls(stop - first, pa.int64())
                maps = pa.array([bitmap(sets[a:z]) for a, z in zip(bounds[:-1].tolist(), bounds[1:].tolist())], pa.binary())
                yield pa.RecordBatch.from_arrays([ids.slice(first, stop - first), pa.array(np.diff(bounds)), pa.array(low.view(np.int64)),
                                                  pa.array(high.view(np.int64)), maps, none, none], schema=schema)
                for i, key in enumerate(low.tolist()):
                    if key not in seen:
                        seen.add(key)
                        often.append(sets[bounds[i]:bounds[i + 1]])
            if often:
                shingles, held = np.unique(np.concatenate(often), return_counts=True)
                some = held >= BATCH_LEAST
                none = pa.nulls(int(some.sum()), pa.int64())
                yield pa.RecordBatch.from_arrays([none, none, none, none, pa.nulls(len(none), pa.binary()), pa.array(shingles[some].view(np.int64)), pa.array(held[some])], schema=schema)
    return stored(docs.select(F.col(doc_id).cast("long"), text).mapInArrow(tidy(batches), spec), "described")


def key_groups(docs: DataFrame, text: str, frequent: DataFrame, n_buckets: int, width: int, threshold: int) -> DataFrame:
    """Stored groups ``(group, key, members)`` of two and more class keys, and all parts of keys that were dealt to several."""
    found = frequent.orderBy("shingle").toPandas()  # bounded, see FREQUENT_SHARE
    table = (found["shingle"].to_numpy(np.int64).view(np.uint64), found["held"].to_numpy(np.int64))
    order = np.argsort(table[0])
    shipped = docs.sparkSession.sparkContext.broadcast((table[0][order], table[1][order]))

    def keyed(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        often, counts = shipped.value
        for part in parts:
            seen, keys, classes = set(), [], []
            for _, _, sets, bounds in shingle_sets(part.column(0), width):
                low, _ = digests(sets, bounds)
                at = np.minimum(np.searchsorted(often, sets), max(len(often) - 1, 0))
                late = often[at] == sets if len(often) else np.zeros(len(sets), bool)
                sizes = np.diff(bounds)
                wanted = np.where(sizes > 0, sizes - least_overlap(sizes, threshold) + 1, 0)
                for i in np.flatnonzero(sizes).tolist():
                    if low[i] in seen:
                        continue
                    seen.add(low[i])
                    own, behind = sets[bounds[i]:bounds[i + 1]], late[bounds[i]:bounds[i + 1]]
                    first = own[~behind][:wanted[i]]
                    if len(first) < wanted[i]:
                        first = np.concatenate((first, own[behind][:wanted[i] - len(first)]))
                    keys.append(first)
                    classes.append(np.full(len(first), low[i], np.uint64))
            if not keys:
                continue
            key, owner = np.concatenate(keys), np.concatenate(classes)
            salt = np.zeros(len(key), np.uint64)
            if len(often):
                at = np.minimum(np.searchsorted(often, key), len(often) - 1)
                several = np.where(often[at] == key, 1 + counts[at] // (16 * TILE), 1).astype(np.uint64)
                salt = (owner >> np.uint64(7)) % several
            bucket = (byte_text.keys_of(key + salt, 8) % np.uint64(n_buckets)).astype(np.int64)
            order = np.lexsort((key, bucket))
            cuts = np.searchsorted(bucket[order], np.arange(n_buckets + 1))
            for b in np.flatnonzero(np.diff(cuts)).tolist():
                rows = order[cuts[b]:cuts[b + 1]]
                yield pa.RecordBatch.from_pydict({"bucket": pa.array([b], pa.int32()), "keys": pa.array([key[rows].tobytes()], pa.binary()),
                                                  "classes": pa.array([owner[rows].tobytes()], pa.binary())})

    def grouped(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        often, counts = shipped.value
        keys, owners, bucket = [], [], None

        def close() -> Iterator[pa.RecordBatch]:
            key, owner = np.concatenate(keys), np.concatenate(owners)
            order = np.lexsort((owner, key))
            key, owner = key[order], owner[order]
            fresh = np.ones(len(key), bool)
            fresh[1:] = (key[1:] != key[:-1]) | (owner[1:] != owner[:-1])
            key, owner = key[fresh], owner[fresh]
            starts = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
            ends = np.append(starts[1:], len(key))
            dealt = np.zeros(len(starts), bool)
            if len(often):
                at = np.minimum(np.searchsorted(often, key[starts]), len(often) - 1)
                dealt = (often[at] == key[starts]) & (counts[at] >= 16 * TILE)
            names, lists = [], []
            for g in np.flatnonzero((ends - starts > 1) | dealt).tolist():
                for a in range(starts[g], ends[g], TILE):
                    names.append(int(key[starts[g]].view(np.int64)) if dealt[g] or ends[g] - starts[g] > TILE else None)
                    lists.append(owner[a:min(a + TILE, ends[g])].view(np.int64))
            for a in range(0, len(lists), 4096):
                offsets = np.concatenate(([0], np.cumsum([len(x) for x in lists[a:a + 4096]]))).astype(np.int32)
                yield pa.RecordBatch.from_arrays([pa.array(names[a:a + 4096], pa.int64()),
                                                  pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(lists[a:a + 4096])))], ["key", "members"])

        for part in parts:
            for b, k, c in zip(part.column(0).to_pylist(), part.column(1), part.column(2)):
                if b != bucket and keys:
                    yield from close()
                    keys, owners = [], []
                bucket = b
                keys.append(np.frombuffer(k.as_py(), np.uint64))
                owners.append(np.frombuffer(c.as_py(), np.uint64))
        if keys:
            yield from close()

    rows = (docs.select(text).mapInArrow(tidy(keyed), "bucket int, keys binary, classes binary")
            .repartition(n_buckets, "bucket").sortWithinPartitions("bucket").mapInArrow(tidy(grouped), "key bigint, members array<bigint>"))
    # keys with the same members ask the same question
    return stored(rows.dropDuplicates(["key", "members"]).withColumn("group", F.monotonically_increasing_id()), "groups")


def own_texts(texts: DataFrame, width: int) -> DataFrame:
    """``(rep, text)`` of the rows ``(rep, text, expected)`` whose set is an expected one: an id may name other texts, too."""
    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            expected, right = part.column(2).to_pylist(), []
            for first, stop, sets, bounds in shingle_sets(part.column(1), width):
                low, high = digests(sets, bounds)
                found = zip(low.view(np.int64).tolist(), high.view(np.int64).tolist(), np.diff(bounds).tolist())
                right += [any((e["low"], e["high"], e["n"]) == f for e in own) for own, f in zip(expected[first:stop], found)]
            yield part.select([0, 1]).filter(pa.array(right, pa.bool_()))
    return texts.mapInArrow(tidy(batches), "rep bigint, text string")


class SignatureTree:
    """Leaves in order of size and bitmap; each level ORs FANOUT nodes of the one below."""

    def __init__(self, sizes: np.ndarray, maps: np.ndarray, spare: np.ndarray, labels: np.ndarray):
        self.order = np.lexsort((maps[:, 0], sizes))
        sizes, maps, spare, labels = sizes[self.order], maps[self.order], spare[self.order], labels[self.order]
        self.levels = [(maps, sizes, sizes, spare, labels, labels)]
        while len(self.levels[-1][0]) > 1:
            below = self.levels[-1]
            cuts = np.arange(0, len(below[0]), FANOUT)
            self.levels.append((np.bitwise_or.reduceat(below[0], cuts), np.minimum.reduceat(below[1], cuts), np.maximum.reduceat(below[2], cuts),
                                np.maximum.reduceat(below[3], cuts), np.minimum.reduceat(below[4], cuts), np.maximum.reduceat(below[5], cuts)))

    def level(self, depth: int):
        return self.levels[min(depth, len(self.levels) - 1)]


def possible(left, a: np.ndarray, right, b: np.ndarray, threshold: int) -> np.ndarray:
    """Whether any two sets below the nodes can link and are not yet in one component."""
    maps, small, large, spare, low, high = left
    maps2, small2, large2, spare2, low2, high2 = right
    fits = (100 * large[a] >= threshold * small2[b]) & (100 * large2[b] >= threshold * small[a])
    fits &= ~((low[a] == high[a]) & (low2[b] == high2[b]) & (low[a] == low2[b]))
    at = np.flatnonzero(fits)
    common = np.bitwise_count(maps[a[at]] & maps2[b[at]]).sum(1).astype(np.int64) + np.minimum(spare[a[at]], spare2[b[at]])
    fits[at] = common * (100 + threshold) >= threshold * (small[a[at]] + small2[b[at]])
    return fits


def dual_traversal(one: SignatureTree, other: SignatureTree | None, threshold: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Leaf pairs that may link: of two trees, or of one with itself."""
    two = other or one
    top = max(len(one.levels), len(two.levels)) - 1
    stack = [(top, np.zeros(1, np.int64), np.zeros(1, np.int64))]
    while stack:
        depth, a, b = stack.pop()
        left, right = one.level(depth), two.level(depth)
        kept = possible(left, a, right, b, threshold)
        if depth == 0 and other is None:
            kept &= a != b
        a, b = a[kept], b[kept]
        if not len(a):
            continue
        if depth == 0:
            yield one.order[a], two.order[b]
            continue
        # children of both nodes; a tree that is lower keeps its root until the other has come down
        wide = [FANOUT if depth < len(t.levels) else 1 for t in (one, two)]
        x = a[:, None] * wide[0] + np.arange(wide[0])[None, :]
        y = b[:, None] * wide[1] + np.arange(wide[1])[None, :]
        x, y = np.repeat(x, wide[1], axis=1).ravel(), np.tile(y, (1, wide[0])).ravel()
        inside = (x < len(one.level(depth - 1)[0])) & (y < len(two.level(depth - 1)[0]))
        if other is None:
            inside &= x <= y
        x, y = x[inside], y[inside]
        for cut in range(0, len(x), 1 << 15):
            stack.append((depth - 1, x[cut:cut + (1 << 15)], y[cut:cut + (1 << 15)]))


class Given:
    """Pairs that were given before, packed into one sorted array: each member has a number of its own here."""

    def __init__(self):
        self.numbers: dict[int, int] = {}
        self.pairs = np.zeros(0, np.int64)

    def new(self, u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The pairs that were not given yet, once each, as (smaller, larger)."""
        u, v = np.minimum(u, v), np.maximum(u, v)
        members, where = np.unique(np.concatenate((u, v)), return_inverse=True)
        for m in members.tolist():
            self.numbers.setdefault(m, len(self.numbers))
        own = np.array([self.numbers[m] for m in members.tolist()], np.int64)[where]
        packed, first = np.unique(own[:len(u)] << 32 | own[len(u):], return_index=True)
        at = np.minimum(np.searchsorted(self.pairs, packed), max(len(self.pairs) - 1, 0))
        fresh = self.pairs[at] != packed if len(self.pairs) else np.ones(len(packed), bool)
        if len(self.pairs) > REMEMBERED_PAIRS:  # only a pair given twice can come of it
            self.pairs = np.zeros(0, np.int64)
        self.pairs = np.sort(np.concatenate((self.pairs, packed[fresh])), kind="stable")
        return u[first[fresh]], v[first[fresh]]


def tree_pairs(members: DataFrame, threshold: int) -> DataFrame:
    """Candidate pairs ``(u, v)`` of every tile: rows ``(tile, side, rep, label, n, bitmap, route)``; a tile with two sides is searched across.

    Similar members meet in many tiles.  Tiles of one ``route``, their smallest members, go to one task, which gives a pair once.
    """
    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tile, route, held, given = None, None, [], Given()

        def close() -> Iterator[pa.RecordBatch]:
            side, rep, label, n = (np.concatenate([h[i] for h in held]) for i in range(4))
            maps = [m for h in held for m in h[4]]
            length = np.array([len(m) for m in maps])
            spare = spare_of(maps, n)

            def tree(rows: np.ndarray, size: int) -> SignatureTree:
                return SignatureTree(n[rows], stretched([maps[i] for i in rows], size), spare[rows], label[rows])
            across = bool(side.any())
            for one in np.unique(length).tolist():
                for two in (one, 2 * one):
                    first = [np.flatnonzero((length == one) & (side == s)) for s in ((0, 1) if across and one != two else (0,))]
                    second = [np.flatnonzero((length == two) & (side == s)) for s in ((1, 0) if across else (0,))]
                    for x, y in zip(first, second):
                        if not (len(x) and len(y)):
                            continue
                        left = tree(x, two)
                        for i, j in dual_traversal(left, None if one == two and not across else tree(y, two), threshold):
                            u, v = given.new(rep[x[i]], rep[y[j]])
                            if len(u):
                                yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], ["u", "v"])

        for part in parts:
            tiles = part.column(0).to_numpy()
            columns = [part.column(i).to_numpy() for i in range(1, 5)]
            maps, routes = part.column(5).to_pylist(), part.column(6).to_numpy()
            cuts = np.concatenate(([0], np.flatnonzero(tiles[1:] != tiles[:-1]) + 1, [len(tiles)]))
            for a, z in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
                if z > a:
                    if tiles[a] != tile and held:
                        yield from close()
                        held = []
                    if routes[a] != route:
                        route, given = routes[a], Given()
                    tile = tiles[a]
                    held.append([*(c[a:z] for c in columns), maps[a:z]])
        if held:
            yield from close()
    dealt = (members.select("tile", F.col("side").cast("long"), "rep", "label", "n", "bitmap", "route")
             .repartition("route").sortWithinPartitions("route", "tile"))
    return dealt.mapInArrow(tidy(batches), "u bigint, v bigint").distinct()


def plausible(pairs: DataFrame, signatures: DataFrame, threshold: int) -> DataFrame:
    """Pairs whose sizes and bitmaps allow a link."""
    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            ids, sizes = [part.column(i).to_numpy() for i in (0, 1)], [part.column(i).to_numpy() for i in (2, 4)]
            maps = [part.column(i).to_pylist() for i in (3, 5)]
            lengths = [np.array([len(m) for m in side], np.int64) for side in maps]
            spare = [spare_of(m, n) for m, n in zip(maps, sizes)]
            fits = np.zeros(part.num_rows, bool)
            for size in np.unique(np.maximum(*lengths)).tolist():
                near = np.flatnonzero((np.maximum(*lengths) == size) & (2 * np.minimum(*lengths) >= size))
                for a in range(0, len(near), 1024):
                    at = near[a:a + 1024]
                    sides = [(stretched([m[i] for i in at], size), n[at], n[at], x[at], d[at], d[at]) for m, n, x, d in zip(maps, sizes, spare, ids)]
                    fits[at] = possible(sides[0], np.arange(len(at)), sides[1], np.arange(len(at)), threshold)
            yield part.select([0, 1]).filter(pa.array(fits))

    def side(name: str, n: str, bitmap: str) -> DataFrame:
        return signatures.select(F.col("rep").alias(name), F.col("n").alias(n), F.col("bitmap").alias(bitmap))
    rows = pairs.join(side("u", "n1", "b1"), "u").join(side("v", "n2", "b2"), "v").select("u", "v", "n1", "b1", "n2", "b2")
    return rows.mapInArrow(tidy(batches), "u bigint, v bigint").distinct()


def verified(pairs: DataFrame, texts: DataFrame, classes: DataFrame, width: int, threshold: int) -> DataFrame:
    """Stored pairs whose exact Jaccard similarity reaches the threshold; ``texts`` holds ``(rep, text)`` of all rows."""
    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for at in range(0, part.num_rows, 512):
                piece = part.slice(at, 512)
                sides = [[sets[a:z] for _, _, sets, bounds in shingle_sets(piece.column(i), width)
                          for a, z in zip(bounds[:-1].tolist(), bounds[1:].tolist())] for i in (2, 3)]
                links = []
                for x, y in zip(*sides):
                    common = len(np.intersect1d(x, y, assume_unique=True))
                    links.append(common > 0 and 100 * common >= threshold * (len(x) + len(y) - common))
                yield piece.select([0, 1]).filter(pa.array(links, pa.bool_()))
    pairs = stored(pairs, "pairs")
    ends = pairs.select("u", "v", F.explode(F.array("u", "v")).alias("rep"))
    wanted = pairs.select(F.col("u").alias("rep")).unionByName(pairs.select(F.col("v").alias("rep"))).distinct()
    few = wanted.count() <= BROADCAST_ROWS  # else Spark shuffles both sides, with the same result
    expected = classes.join(wanted, "rep", "left_semi").groupBy("rep").agg(F.collect_list(F.struct("low", "high", "n")).alias("expected"))
    own = own_texts(texts.join(F.broadcast(expected) if few else expected, "rep").select("rep", "text", "expected"), width)
    both = (ends.join(own, "rep").groupBy("u", "v")
            .agg(F.max(F.when(F.col("rep") == F.col("u"), F.col("text"))).alias("t1"), F.max(F.when(F.col("rep") == F.col("v"), F.col("text"))).alias("t2")))
    return stored(both.mapInArrow(tidy(batches), "u bigint, v bigint"), "links")


def similar_components(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = WIDTH, threshold: int = THRESHOLD) -> DataFrame:
    """``(id, n_shingles, component_id)`` of every row; the component is the smallest id reachable over links."""
    raw = docs.select(doc_id, text)
    described = describe(raw, doc_id, text, width)
    per_row = described.filter(F.col("n").isNotNull()).select("doc_id", "n", "low", "high", "bitmap")
    classes = stored(per_row.filter((F.col("n") > 0) & F.col("doc_id").isNotNull())
                     .groupBy("low", "high", "n").agg(F.min("doc_id").alias("rep"), F.first("bitmap").alias("bitmap")), "classes")
    totals = classes.agg(F.count("*"), F.sum("n")).first()
    often = max(16, (totals[0] or 0) // FREQUENT_SHARE)
    frequent = (described.filter(F.col("shingle").isNotNull()).groupBy("shingle").agg(F.sum("held").alias("held")).filter(F.col("held") >= often))
    buckets = slots((totals[1] or 0) * (100 - threshold) // 100, KEYS_PER_BUCKET, least=raw.sparkSession.sparkContext.defaultParallelism)
    groups = key_groups(raw.filter(F.col(doc_id).isNotNull()), text, frequent, buckets, width, threshold)
    members = stored(groups.select("group", "key", F.explode("members").alias("low")).join(classes.select("low", "rep"), "low")
                     .select("group", "key", "rep").distinct(), "members")
    texts = raw.select(F.col(doc_id).cast("long").alias("rep"), F.col(text).alias("text"))
    maps = classes.select("rep", "n", "bitmap")

    centres = members.groupBy("group", "key").agg(F.min("rep").alias("u"))
    stars = members.join(centres.select("group", "u"), "group").select("u", F.col("rep").alias("v"))
    tops = centres.filter("key IS NOT NULL").groupBy("key").agg(F.min("u").alias("top"))
    between = centres.filter("key IS NOT NULL").join(tops, "key").select(F.col("top").alias("u"), F.col("u").alias("v"))
    star_pairs = plausible(stars.unionByName(between).filter("u <> v").distinct(), maps, threshold)
    first = verified(star_pairs, texts, classes, width, threshold)
    labels = components(first)

    labelled = stored(members.join(labels.withColumnRenamed("node", "rep"), "rep", "left")
                      .select("group", "key", "rep", F.coalesce("component", "rep").alias("label")), "labelled")
    name = F.xxhash64(F.col("key").isNull(), F.coalesce("key", "group"))
    labelled = labelled.withColumn("name", name)
    mixed = (labelled.groupBy("name").agg(F.min("label").alias("a"), F.max("label").alias("b"), F.collect_set("group").alias("groups"))
             .filter("a <> b").select("name", "groups"))
    # each part of a key with itself and with every later part
    smallest = centres.select("group", F.col("u").alias("smallest"))
    parts = mixed.select("name", F.explode("groups").alias("one"), "groups").select("name", "one", F.explode("groups").alias("two")).filter("one <= two")
    side = [F.struct(F.lit(i).alias("side"), F.col(c).alias("group")) for i, c in enumerate(("one", "two"))]
    sides = (parts.join(smallest.select(F.col("group").alias("one"), F.col("smallest").alias("s1")), "one")
             .join(smallest.select(F.col("group").alias("two"), F.col("smallest").alias("s2")), "two")
             .withColumns({"tile": F.xxhash64("name", "one", "two"), "route": F.xxhash64("s1", "s2")})
             .select("tile", "route", F.explode(F.when(F.col("one") == F.col("two"), F.array(side[0])).otherwise(F.array(*side))).alias("x")).select("tile", "route", "x.*"))
    tiles = sides.join(labelled.drop("name"), "group").join(maps, "rep").select("tile", "side", "rep", "label", "n", "bitmap", "route")
    second = verified(tree_pairs(tiles, threshold), texts, classes, width, threshold)
    found = components(first.unionByName(second))
    by_class = classes.join(found.withColumnRenamed("node", "rep"), "rep", "left").select("low", "high", "n", F.coalesce("component", "rep").alias("component_id"))
    linked = (F.col("n") > 0) & F.col("doc_id").isNotNull()
    return (per_row.drop("bitmap").join(by_class, ["low", "high", "n"], "left")
            .select(F.col("doc_id").alias(doc_id), F.col("n").alias("n_shingles"), F.when(linked, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id")))


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """One row of each component: the one with the smallest id.  Rows without an id stay."""
    found = stored(similar_components(docs, doc_id, text, **options), "components")

    def ids(rows: DataFrame) -> DataFrame:
        rows = rows.select(doc_id)
        return F.broadcast(rows) if rows.count() <= BROADCAST_ROWS else rows  # beyond that Spark shuffles, with the same result
    kept = ids(found.filter(F.col(doc_id) == F.col("component_id")).distinct())
    repeated = ids(found.filter(F.col(doc_id).isNotNull()).groupBy(doc_id).count().filter("count > 1"))
    stay = docs.join(kept, doc_id, "left_semi")
    whole = stay.join(repeated, doc_id, "left_semi").select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), doc_id, text)
    first = F.row_number().over(Window.partitionBy(doc_id).orderBy(text))
    one = whole.withColumn("_rank", first).filter("_rank = 1").select("_row.*")
    return stay.join(repeated, doc_id, "left_anti").select(docs.columns).unionByName(one).unionByName(docs.filter(F.col(doc_id).isNull()))
