"""Exact search for the highest inner products with M-trees.

1. Vectors become whole numbers; equal ones are one entry that keeps as many of its smallest ids as a result can hold.
2. Entries are dealt to the nearest of some sampled pivots (the sample is bounded, every entry is indexed) and, per pivot, into parts of about ``TREE`` entries.  Each
   part is an M-tree, stored as one row: pages of entries, over them nodes with a pivot, the covering radius, the distance to the parent's pivot and the
   range of lengths.  The metric is the angle between directions, for which the triangle inequality holds.
3. No entry below a node scores more than |query| x length x cos(angle to the pivot - radius).  Before the angle to a child's pivot is computed, the stored distance to the
   parent's pivot bounds it; within a page the stored distances select the entries that are computed at all.
4. Each query first searches the most promising tree, then, with the scores found as floor, every tree whose bound reaches it.  Within a tree it always goes on with the
   node of the highest bound.  Queries travel in blocks, and those of a block that stand at the same node are computed together.

Scores are exact: sums in floating point are used only where they cannot round.  Bounds are widened by more than their rounding.

Defined cases: rows without id or vector, and vectors that hold a null or a number that is not finite, neither ask nor answer; vectors of different
lengths of list are not compared; the zero vector scores 0, also as a query; equal scores are ranked by id; repeated rows are rows of their own, and a query leaves out
itself, not its repetition; a score beyond 64 bits fails the job; other columns are not read; no rows give no rows.
"""

from __future__ import annotations

from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from savora.llm.common import slots, stored

SCALE = 256
TOP = 5
TREE = 4096
PAGE = 256
FANOUT = 16
CELLS = 4096
BLOCK_BITS = 10
SLACK = 1e-6
NODE = np.dtype([("pivot", "i8"), ("radius", "f8"), ("to_parent", "f8"), ("longest", "f8"), ("shortest", "f8"), ("first", "i8"), ("children", "i8"), ("start", "i8"), ("stop", "i8")])


def lengths_of(vectors: np.ndarray) -> np.ndarray:
    return np.sqrt((vectors.astype(float) ** 2).sum(axis=1))


def directions(vectors: np.ndarray) -> np.ndarray:
    """Unit vectors; the zero vector points along the first axis, so that all angles belong to one metric."""
    lengths = lengths_of(vectors)
    out = vectors / np.where(lengths > 0, lengths, 1)[:, None]
    out[lengths == 0, :1] = 1
    return out


def angles(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(a @ b.T, -1, 1))


def summable(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both as floating point where no inner product of theirs can round, else as numbers without bounds."""
    reach = a.shape[1] * max(np.abs(a).max(initial=0), 1) * float(max(np.abs(b).max(initial=0), 1))
    return (a.astype(float), b.astype(float)) if reach < 2 ** 53 else (a.astype(object), b.astype(object))


def highest(angle: np.ndarray, reach: np.ndarray, longest: np.ndarray, shortest: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The most that an entry within ``reach`` of a pivot can score for a query at ``angle`` to it."""
    cosine = np.cos(np.maximum(angle - reach - SLACK, 0))
    return length * (np.where(cosine > 0, longest, shortest) * cosine + longest * 1e-9) + 1e-9


def build(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(order of the entries, nodes with the root first and children side by side, angle of each entry to its page's pivot)."""
    units, lengths = directions(vectors), lengths_of(vectors)
    order, to_pivot = np.empty(len(vectors), np.int64), np.empty(len(vectors))
    rows, nodes, above = [np.arange(len(vectors))], [], [None]
    starts = [0]
    for at, own in enumerate(rows):
        pivot = own[int(np.argmax(units[own] @ units[own].sum(axis=0)))]
        apart = angles(units[own], units[pivot:pivot + 1])[:, 0]
        start, parent = starts[at], above[at]
        node = [pivot, apart.max(), angles(units[pivot:pivot + 1], units[parent:parent + 1])[0, 0] if parent is not None else 0.0, lengths[own].max(), lengths[own].min(),
                len(rows), 0, start, start + len(own)]
        if len(own) <= PAGE:
            by_angle = np.argsort(apart, kind="stable")
            order[start:start + len(own)], to_pivot[start:start + len(own)] = own[by_angle], apart[by_angle]
        else:
            n = min(FANOUT, -(-len(own) // PAGE))
            seeds = units[own[np.linspace(0, len(own) - 1, n).astype(int)]]
            nearest = np.argmax(units[own] @ seeds.T, axis=1)
            parts = [own[nearest == i] for i in np.unique(nearest)]
            if len(parts) == 1:
                parts = np.array_split(own, n)
            for part in parts:
                rows.append(part)
                above.append(pivot)
                starts.append(start)
                start += len(part)
            node[6] = len(parts)
        nodes.append(tuple(node))
    table = np.array(nodes, NODE)
    place = np.empty(len(vectors), np.int64)
    place[order] = np.arange(len(vectors))
    table["pivot"] = place[table["pivot"]]
    return order, table, to_pivot


class Tree:
    """An M-tree and the ids of its entries."""

    def __init__(self, vectors: np.ndarray, nodes: np.ndarray, to_pivot: np.ndarray, ids: list[list[int]]):
        self.vectors, self.nodes, self.to_pivot, self.ids = vectors, nodes, to_pivot, ids
        self.pivots = directions(vectors[nodes["pivot"]])
        self.computed = 0

    def search(self, queries: np.ndarray, floors: np.ndarray, k: int) -> list[list[tuple[int, int]]]:
        """The ``k`` best ``(-score, id)`` of each query that score at least its floor, best first."""
        nodes, units, lengths = self.nodes, directions(queries), lengths_of(queries)
        queries, entries = summable(queries, self.vectors)
        best: list[list[tuple[int, int]]] = [[] for _ in queries]
        floors = floors.copy()
        angle = np.zeros((len(queries), len(nodes)))
        angle[:, 0] = angles(units, self.pivots[:1])[:, 0]
        bound = np.full(angle.shape, -np.inf)  # of nodes that wait to be visited
        root = nodes[0]
        bound[:, 0] = highest(angle[:, 0], root["radius"], root["longest"], root["shortest"], lengths)
        active = np.arange(len(queries))
        while len(active):
            chosen = bound[active].argmax(axis=1)
            going = (bound[active, chosen] >= floors[active]) & (bound[active, chosen] > -np.inf)
            active, chosen = active[going], chosen[going]
            bound[active, chosen] = -np.inf
            for at in np.unique(chosen).tolist():
                asking, node = active[chosen == at], nodes[at]
                if node["children"]:
                    children = np.arange(node["first"], node["first"] + node["children"])
                    below = nodes[children]
                    near = np.abs(angle[asking, at][:, None] - below["to_parent"])
                    worth = highest(near, below["radius"], below["longest"], below["shortest"], lengths[asking, None]) >= floors[asking, None]
                    for j, child in enumerate(children.tolist()):
                        some = asking[worth[:, j]]
                        if len(some):
                            angle[some, child] = angles(units[some], self.pivots[child:child + 1])[:, 0]
                            bound[some, child] = highest(angle[some, child], below["radius"][j], below["longest"][j], below["shortest"][j], lengths[some])
                else:
                    self._page(node, angle[asking, at], asking, queries, entries, lengths, floors, best, k)
        return best

    def _page(self, node, angle: np.ndarray, asking: np.ndarray, queries: np.ndarray, entries: np.ndarray, lengths: np.ndarray, floors: np.ndarray,
              best: list, k: int) -> None:
        with np.errstate(divide="ignore", invalid="ignore"):
            needed = (floors[asking] - 1e-6) / (lengths[asking] * node["longest"] * (1 + 1e-9))
        # an entry further from the query than this scores less than the floor; below 0 the shortest entry might still reach it
        far = np.where(needed > 0, np.arccos(np.clip(needed, -1, 1)), np.pi) + 2 * SLACK
        stored = self.to_pivot[node["start"]:node["stop"]]
        start = node["start"] + int(np.searchsorted(stored, (angle - far).min(), "left"))
        stop = node["start"] + int(np.searchsorted(stored, (angle + far).max(), "right"))
        if start >= stop:
            return
        scores = queries[asking] @ entries[start:stop].T
        self.computed += scores.size
        hits, places = np.nonzero(scores >= floors[asking, None])
        cuts = np.searchsorted(hits, np.arange(len(asking) + 1))
        for at in np.unique(hits).tolist():
            i, row, good = asking[at], scores[at], places[cuts[at]:cuts[at + 1]]
            if len(good) > k:
                good = good[row[good] >= np.sort(row[good])[-k]]
            found = best[i] + [(-int(row[j]), v) for j in good.tolist() for v in self.ids[start + j]]
            found.sort()
            best[i] = found[:k]
            if len(best[i]) == k:
                floors[i] = max(floors[i], -best[i][-1][0])


def _matrix(lists: pa.ListArray, dims: int) -> np.ndarray:
    return lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(lists), dims)


def whole_vectors(rows: DataFrame, vec_id: str, vector: str, scale: int) -> DataFrame:
    """``(vec_id, dims, vector)`` of the rows that take part, as whole numbers."""
    sound = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    doubles = rows.select(F.col(f"`{vec_id}`").cast("long").alias("vec_id"), F.col(f"`{vector}`").cast("array<double>").alias("v"))
    return doubles.filter(F.col("vec_id").isNotNull() & F.col("v").isNotNull() & sound).select(
        "vec_id", F.size("v").alias("dims"), F.transform("v", lambda x: F.floor(x * scale).cast("long")).alias("vector"))


def entries(vectors: DataFrame, kept: int) -> DataFrame:
    """Stored ``(dims, vector, ids)``: each distinct vector once, with its smallest ids."""
    nth = F.row_number().over(Window.partitionBy("dims", "vector").orderBy("vec_id"))
    few = vectors.withColumn("nth", nth).filter(F.col("nth") <= kept)
    return stored(few.groupBy("dims", "vector").agg(F.sort_array(F.collect_list("vec_id")).alias("ids")), "entries")


def trees(points: DataFrame) -> DataFrame:
    """Stored M-trees, one row each, of all entries."""
    spark, n = points.sparkSession, points.count()
    sample = points.orderBy(F.xxhash64("vector"), "vector").limit(min(CELLS, slots(n, TREE))).select("dims", "vector").collect()
    seeds = {d: directions(np.array([r["vector"] for r in sample if r["dims"] == d], np.int64).reshape(-1, d)) for d in {r["dims"] for r in sample}}
    pivots = spark.sparkContext.broadcast(seeds)

    def dealt(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            cells = np.zeros(part.num_rows, np.int64)
            dims = part.column(0).to_numpy()
            for d in np.unique(dims).tolist():
                if d in pivots.value:
                    here = np.flatnonzero(dims == d)
                    cells[here] = (directions(_matrix(part.column(1).take(pa.array(here)), d)) @ pivots.value[d].T).argmax(axis=1)
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(cells)], [*part.schema.names, "cell"])
    celled = stored(points.mapInArrow(dealt, "dims int, vector array<bigint>, ids array<bigint>, cell bigint"), "celled")
    sizes = celled.groupBy("dims", "cell").agg(F.ceil(F.count("*") / TREE).alias("parts"))
    split = celled.join(sizes, ["dims", "cell"]).withColumn("part", F.pmod(F.xxhash64("vector"), "parts"))

    def grown(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        dims = table.column("dims")[0].as_py()
        vectors = _matrix(table.column("vector").combine_chunks(), dims)
        order, nodes, to_pivot = build(vectors)
        root = nodes[0]
        ids = table.column("ids").take(pa.array(order))
        one = {"dims": [dims], "pivot": [vectors[order[root["pivot"]]].tolist()], "radius": [float(root["radius"])], "longest": [float(root["longest"])],
               "shortest": [float(root["shortest"])], "vectors": [vectors[order].tobytes()], "nodes": [nodes.tobytes()], "to_pivot": [to_pivot.tobytes()], "ids": [ids.to_pylist()]}
        types = [pa.int32(), pa.list_(pa.int64()), pa.float64(), pa.float64(), pa.float64(), pa.binary(), pa.binary(), pa.binary(), pa.list_(pa.list_(pa.int64()))]
        return pa.table([pa.array(v, t) for v, t in zip(one.values(), types)], names=list(one))
    rows = split.groupBy("dims", "cell", "part").applyInArrow(grown, "dims int, pivot array<bigint>, radius double, longest double, shortest double, vectors binary, "
                                                                      "nodes binary, to_pivot binary, ids array<array<bigint>>")
    return stored(rows.withColumn("tree", F.monotonically_increasing_id()), "trees")


def _directory(forest: DataFrame) -> DataFrame:
    """The roots of all trees, up to 1,024 in a row."""
    root = F.struct("tree", "pivot", "radius", "longest", "shortest")
    return forest.groupBy("dims", F.shiftright("tree", BLOCK_BITS).alias("shelf")).agg(F.collect_list(root).alias("roots"))


def _blocks(queries: DataFrame) -> DataFrame:
    """Up to 1,024 queries in a row, in the order of their keys."""
    one = F.struct("key", "vector", "floor", "seed")
    return queries.groupBy("dims", F.shiftright("key", BLOCK_BITS).alias("block")).agg(F.sort_array(F.collect_list(one)).alias("queries"))


def _floors(column: pa.Array) -> np.ndarray:
    """Floors as numbers; without one any score will do."""
    return np.array([-np.inf if v is None else v for v in column.to_pylist()], float)


def promising(queries: DataFrame, forest: DataFrame) -> DataFrame:
    """``(dims, block, tree, keys)``: without floors the best tree of each query, with floors all others that can reach it."""
    def bounds(row: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, pa.Array, np.ndarray]:
        dims = row.column(0)[0].as_py()
        asked, roots = row.column(2).flatten(), row.column(3).flatten()
        vectors, pivots = _matrix(asked.field(1), dims), _matrix(roots.field(1), dims)
        radius, longest, shortest = (roots.field(i).to_numpy() for i in (2, 3, 4))
        bound = highest(angles(directions(vectors), directions(pivots)), radius, longest, shortest, lengths_of(vectors)[:, None])
        return bound, asked.field(0).to_numpy(), asked, roots.field(0).to_numpy()

    def first(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for i in range(part.num_rows):
                bound, keys, _, names = bounds(row := part.slice(i, 1))
                best = bound.argmax(axis=1)
                n = len(keys)
                yield pa.RecordBatch.from_arrays([pa.array(np.repeat(row.column(0).to_numpy(), n)), pa.array(np.repeat(row.column(1).to_numpy(), n)), pa.array(keys),
                                                  pa.array(names[best]), pa.array(bound[np.arange(n), best])], ["dims", "block", "key", "tree", "bound"])

    def others(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for i in range(part.num_rows):
                bound, keys, asked, names = bounds(row := part.slice(i, 1))
                wanted = (bound >= _floors(asked.field(2))[:, None]) & (asked.field(3).to_numpy()[:, None] != names)
                some = np.flatnonzero(wanted.any(axis=0))
                lists = [keys[wanted[:, j]].tolist() for j in some]
                yield pa.RecordBatch.from_arrays([pa.array(np.repeat(row.column(k).to_numpy(), len(some))) for k in (0, 1)] + [pa.array(names[some]), pa.array(lists, pa.list_(pa.int64()))],
                                                 ["dims", "block", "tree", "keys"])
    met = _blocks(queries).join(_directory(forest), "dims").select("dims", "block", "queries", "roots")
    if "seed" in queries.columns and dict(queries.dtypes)["seed"] == "bigint":
        return met.mapInArrow(others, "dims int, block bigint, tree bigint, keys array<bigint>")
    seeds = met.mapInArrow(first, "dims int, block bigint, key bigint, tree bigint, bound double").groupBy("dims", "block", "key").agg(F.max_by("tree", F.struct("bound", "tree")).alias("tree"))
    return seeds.groupBy("dims", "block", "tree").agg(F.collect_list("key").alias("keys"))


def searched(asks: DataFrame, queries: DataFrame, forest: DataFrame, k: int) -> DataFrame:
    """``(key, tree, score, vec_id)``: up to ``k`` results of each query in each tree it asks."""
    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for i in range(part.num_rows):
                row = part.slice(i, 1)
                dims, tree = row.column(0)[0].as_py(), row.column(1)[0].as_py()
                vectors, nodes, to_pivot = (row.column(c)[0].as_py() for c in (4, 5, 6))
                to_pivot = np.frombuffer(to_pivot, float)
                found = Tree(np.frombuffer(vectors, np.int64).reshape(len(to_pivot), dims), np.frombuffer(nodes, NODE), to_pivot, row.column(7)[0].as_py())
                asked = row.column(3).flatten()
                keys = asked.field(0).to_numpy()
                some = np.flatnonzero(np.isin(keys, row.column(2).flatten().to_numpy()))
                best = found.search(_matrix(asked.field(1), dims)[some], _floors(asked.field(2))[some], k)
                flat = [(key, s, v) for key, b in zip(keys[some].tolist(), best) for s, v in b]
                yield pa.RecordBatch.from_arrays([pa.array([f[0] for f in flat], pa.int64()), pa.array([tree] * len(flat), pa.int64()), pa.array([-f[1] for f in flat], pa.int64()),
                                                  pa.array([f[2] for f in flat], pa.int64())], ["key", "tree", "score", "vec_id"])
    rows = asks.join(_blocks(queries), ["dims", "block"]).join(forest.drop("dims"), "tree")
    return rows.select("dims", "tree", "keys", "queries", "vectors", "nodes", "to_pivot", "ids").mapInArrow(batches, "key bigint, tree bigint, score bigint, vec_id bigint")


def _best(found: DataFrame, k: int) -> DataFrame:
    nth = F.row_number().over(Window.partitionBy("key").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("nth", nth).filter(F.col("nth") <= k)


def search(rows: DataFrame, every: int, top: int = TOP, scale: int = SCALE, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the ``top`` other rows with the highest inner product, for rows whose id ``every`` divides."""
    k = top + 1  # a query may find itself
    vectors = whole_vectors(rows, vec_id, vector, scale)
    forest = trees(entries(vectors, k))
    asking = vectors.filter(F.col("vec_id") % every == 0)
    distinct = stored(asking.select("dims", "vector").distinct(), "asking")
    distinct = distinct.repartition(slots(distinct.count(), 1 << BLOCK_BITS))
    queries = stored(distinct.withColumn("key", F.monotonically_increasing_id()), "queries")

    plain = queries.withColumns({"floor": F.lit(None).cast("long"), "seed": F.lit(None).cast("string")})
    seeds = stored(promising(plain, forest), "seeds")
    near = stored(searched(seeds, plain, forest, k), "near")
    floors = near.groupBy("key").agg(F.when(F.count("*") == k, F.min("score")).alias("floor"))
    seed = seeds.select(F.explode("keys").alias("key"), F.col("tree").alias("seed"))
    floored = stored(queries.join(seed, "key").join(floors, "key", "left"), "floored")
    rest = searched(promising(floored, forest), floored, forest, k)

    best = _best(near.unionByName(rest), k).groupBy("key").agg(F.sort_array(F.collect_list(F.struct((-F.col("score")).alias("minus"), F.col("vec_id").alias("id")))).alias("found"))
    own = asking.select("dims", "vector", F.col("vec_id").alias("query_id")).join(queries, ["dims", "vector"]).join(best, "key")
    itself = F.array_position(F.col("found.id"), F.col("query_id"))
    others = own.withColumn("itself", itself).withColumn("found", F.expr(f"slice(filter(found, (x, i) -> i + 1 <> itself), 1, {top})"))
    return others.select("query_id", F.posexplode("found").alias("place", "one")).select(
        "query_id", (F.col("place") + 1).cast("int").alias("rank"), F.col("one.id").alias("vec_id"), (-F.col("one.minus")).alias("score"))
