"""K-Means from many starts at once: one pass over the points moves the centres of every start that still moves."""

from __future__ import annotations

from dataclasses import dataclass, field
from types import SimpleNamespace
from typing import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, functions as F

TOLERANCE = 1e-4  # a start rests once no centre moves farther
REST = 1e-9       # the chosen one goes on to here: its centres are the means of their members
GAPS_PER_TASK = 500_000


@dataclass(frozen=True)
class Model:
    centres: np.ndarray
    cost: float
    output: str = "cluster"
    summary: SimpleNamespace = field(init=False)

    def __post_init__(self):
        object.__setattr__(self, "summary", SimpleNamespace(trainingCost=self.cost))

    def clusterCenters(self) -> list[np.ndarray]:
        return list(self.centres)

    def named(self, output: str) -> Model:
        return Model(self.centres, self.cost, output)

    def transform(self, df: DataFrame) -> DataFrame:
        """Add the number of the nearest centre, the smaller one on a tie."""
        point = vector_to_array("features")
        gaps = F.array(*[F.aggregate(F.zip_with(point, F.array(*[F.lit(float(x)) for x in c]), lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda a, x: a + x)
                         for c in self.centres])
        return df.withColumn("_gaps", gaps).withColumn(self.output, (F.array_position("_gaps", F.array_min("_gaps")) - 1).cast("int")).drop("_gaps")


def fit(vectors: DataFrame, starts: Sequence[tuple[int, int]], most: int) -> list[Model]:
    """A model for each start (k, seed), after at most ``most`` moves.  Fewer distinct points than ``k`` give fewer centres."""
    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield pa.RecordBatch.from_arrays([pa.array([batch.column(0).flatten().to_numpy().tobytes()], pa.binary()), pa.array([batch.num_rows])], ["x", "n"])
    gaps, context = vectors.count() * sum(k for k, _ in starts), vectors.sparkSession.sparkContext
    tasks = min(2 * context.defaultParallelism, 1 + gaps // GAPS_PER_TASK)
    # a block has its points as columns, and a last row of ones
    blocks = vectors.select(vector_to_array("features").alias("v")).repartition(tasks).mapInArrow(packed, "x binary, n long").rdd.map(
        lambda r: np.vstack([np.frombuffer(r["x"]).reshape(r["n"], -1).T, np.ones(r["n"])])).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        centres = _first(blocks, starts)
        centres, costs = _moved(blocks, centres, TOLERANCE, most)
        sizes = sorted({k for k, _ in starts})
        best = [min((i for i, s in enumerate(starts) if s[0] == k), key=lambda i: costs[i]) for k in sizes]
        for i, c, cost in zip(best, *_moved(blocks, [centres[i] for i in best], REST, most)):
            centres[i], costs[i] = c, cost
        return [Model(c, cost) for c, cost in zip(centres, costs)]
    finally:
        blocks.unpersist()


def _first(blocks: RDD, starts: Sequence[tuple[int, int]]) -> list[np.ndarray]:
    """Every centre is a point drawn in proportion to its squared distance from the centres before it.

    Each point draws the time until it is called, of that rate, and the earliest one becomes the centre."""
    most = {seed: max(k for k, other in starts if other == seed) for _, seed in starts}  # those of a seed begin alike: the longest has them all
    centres = {seed: np.zeros((0, 0)) for seed in most}
    for step in range(max(most.values(), default=0)):
        due = [(seed, centres[seed]) for seed, k in most.items() if step < k and len(centres[seed]) == step]

        def earliest(part: int, points: Iterator[np.ndarray]) -> Iterator[tuple]:
            for number, block in enumerate(points):
                x = block[:-1]
                for seed, known in due:
                    wait = np.random.default_rng([seed, step, part, number]).exponential(size=x.shape[1])
                    if len(known):
                        rate = np.min([((x - c[:, None]) ** 2).sum(axis=0) for c in known], axis=0)
                        wait = np.where(rate > 0, wait / np.where(rate > 0, rate, 1), np.inf)
                    at = int(np.argmin(wait))
                    if np.isfinite(wait[at]):
                        yield seed, (float(wait[at]), x[:, at].tolist())
        for seed, (_, point) in blocks.mapPartitionsWithIndex(earliest).reduceByKey(min, 1).collect():
            centres[seed] = np.vstack([*centres[seed], point])
    return [centres[seed][:k] for k, seed in starts]


def _moved(blocks: RDD, centres: list[np.ndarray], tolerance: float, most: int) -> tuple[list[np.ndarray], list[float]]:
    """Centres at rest and their costs: sums of squared distances to the nearest one."""
    def sums_of(some: list[np.ndarray]) -> list[list]:
        def partial(points: Iterator[np.ndarray]) -> Iterator[list]:
            total = None
            sides = [np.column_stack([-2 * c, (c * c).sum(axis=1)]) for c in some]  # a point's squared norm is the same to all centres
            for x in points:
                found, norms = [], float((x[:-1] * x[:-1]).sum())
                for side in sides:
                    gaps = side @ x
                    least = gaps.min(axis=0)
                    member = gaps == least
                    own = member.astype(float)
                    if member.sum() != x.shape[1]:
                        own *= member.cumsum(axis=0) == 1  # of equally near centres the first
                    sums = own @ x.T
                    found.append([sums[:, -1], sums[:, :-1], max(0.0, float(least.sum()) + norms)])
                total = found if total is None else [[p + q for p, q in zip(a, b)] for a, b in zip(total, found)]
            if total is not None:
                yield total
        parts = blocks.mapPartitions(partial).collect()
        return [[sum(p[i][j] for p in parts) for j in range(3)] for i in range(len(some))]
    centres, moving = list(centres), list(range(len(centres)))
    for _ in range(most):
        if not moving:
            break
        still = []
        for i, (n, total, _) in zip(moving, sums_of([centres[i] for i in moving])):
            means = np.where(n[:, None] > 0, total / np.maximum(n, 1)[:, None], centres[i])  # a centre without members stays
            if ((means - centres[i]) ** 2).sum(axis=1).max() > tolerance ** 2:
                still.append(i)
            centres[i] = means
        moving = still
    return centres, [cost for _, _, cost in sums_of(centres)]
