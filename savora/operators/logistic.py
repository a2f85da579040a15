"""Logistic regression on sparse rows by Newton steps, whose inner solves are conjugate gradients.

The columns of the matrix lie in the tasks, and coefficients are sums of training rows: ``a`` says how much of each.
A pass sends one number per row to the tasks and one back, however many columns there are.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Callable, Generator, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.sql import DataFrame, functions as F

from savora.sources import shared

MAX_STEPS, MAX_INNER = 100, 1000
CELLS_PER_TASK, CELLS_PER_BLOCK = 500_000, 1_000_000
NUMBERS_AT_ONCE = 30_000_000   # on the driver: fits whose vectors exceed this take turns
NUMBERS_PER_ROW = 20           # of a fit in work
NUMBERS_TO_DRIVER = 1_000_000  # more than that, from all tasks, are added up before they leave the executors


@dataclass
class Fit:
    coefficients: np.ndarray
    intercept: float
    steps: int = 0
    passes: int = 0


@dataclass
class Solved:
    fits: list[Fit]
    sums: np.ndarray            # per fit and row: how much of the row, at its plain length, the coefficients hold
    margins: np.ndarray | None  # per fit and row


def fit_parts(cells: DataFrame, y: np.ndarray, learns: np.ndarray, c: float, tol: float, margins: bool = False) -> Solved:
    """Several fits over parts of the same rows, with balanced classes; ``margins`` asks for those of all rows, learnt from or not.

    Minimises ``sum(w * loss) / sum(w) + |coefficients|^2 / (2 * c * sum(w))``; the intercept is free.  ``cells`` has the columns of the
    matrix (idf, starts, at, tf), packed, many to a row: ``idf`` has a number for each fit, 0 where the column does not take part, and ``at``
    are the rows in which it has ``tf`` counts.  A row under a fit has ``(1 + log(tf)) * idf``, scaled to unit length.  ``learns`` says
    per row and fit whether it learns from it.  One pass over the cells serves all fits.  Ends when a step promises less than ``tol`` of
    the loss.  Newton steps are taken on the rows as they are: on columns scaled to equal deviation rare terms stretch the problem
    and it takes some five times the passes.
    """
    n, fits = learns.shape
    context, per_block = cells.sparkSession.sparkContext, CELLS_PER_BLOCK

    def joined(rows: Iterator) -> Iterator[tuple[np.ndarray, ...]]:
        def block(parts: list[list[np.ndarray]]) -> tuple[np.ndarray, ...]:
            idf, starts, at, tf = zip(*parts)
            # many columns have the same weights: these are kept once, and columns have their place
            known, of = np.unique(np.concatenate(idf).reshape(-1, fits), axis=0, return_inverse=True)
            tf = np.concatenate(tf)
            lengths = np.concatenate([np.diff(s) for s in starts])
            return (np.ascontiguousarray(known.T), *(x.astype(np.min_scalar_type(int(x.max(initial=0)))) for x in (of.ravel(), lengths)),
                    np.concatenate(at), tf.astype(np.min_scalar_type(int(tf.max(initial=0)))))
        held, size = [], 0
        for r in rows:
            held.append([np.frombuffer(x, t) for x, t in zip(r, (np.float64, np.int64, np.int32, np.int32))])
            size += len(held[-1][2])
            if size >= per_block:
                yield block(held)
                held, size = [], 0
        if size:
            yield block(held)
    many = (cells.select(F.sum(F.octet_length("at"))).first()[0] or 0) // 4
    # as many parts as tasks before they are kept: parts joined later lie on several executors, and every pass would fetch them
    blocks = cells.select("idf", "starts", "at", "tf").coalesce(int(min(context.defaultParallelism, many // CELLS_PER_TASK + 1))).rdd.mapPartitions(joined).persist(StorageLevel.MEMORY_AND_DISK)  # an RDD: each pass would plan a table again

    def summed(of_block: Callable[..., None], columns: int) -> np.ndarray:
        def partial(parts: Iterator[tuple[np.ndarray, ...]]) -> Iterator[np.ndarray]:
            total = np.zeros((columns, n))
            for known, of, lengths, at, tf in parts:
                lengths = lengths.astype(np.int64)
                x = (np.log(np.arange(1, 257.0)) + 1.0)[tf - 1] if tf.dtype == np.uint8 else np.log(tf) + 1.0
                of_block(total, known, of, lengths, np.cumsum(lengths) - lengths, at.astype(np.int64), x)
            yield total
        return _added(blocks.mapPartitions(partial), tasks, columns, n)

    def pulled(a: np.ndarray, which: list[int]) -> np.ndarray:
        """Of every row, the inner product with the sum of rows that ``a`` stands for; rows at their plain length."""
        asked = context.broadcast((a, which))

        def of_block(total: np.ndarray, known: np.ndarray, of: np.ndarray, lengths: np.ndarray, starts: np.ndarray, at: np.ndarray, x: np.ndarray) -> None:
            a, which = asked.value
            for i, f in enumerate(which):
                pull = np.add.reduceat(x * a[i][at], starts) * (known[f] ** 2)[of]
                total[i] += np.bincount(at, x * np.repeat(pull, lengths), total.shape[1])
        try:
            return summed(of_block, len(which))
        finally:
            asked.destroy()

    def squares(total: np.ndarray, known: np.ndarray, of: np.ndarray, lengths: np.ndarray, starts: np.ndarray, at: np.ndarray, x: np.ndarray) -> None:
        for f, idf in enumerate(known):
            total[f] += np.bincount(at, (x * np.repeat(idf[of], lengths)) ** 2, total.shape[1])
    try:
        tasks = max(1, blocks.getNumPartitions())
        lengths = summed(squares, fits)
        scale = np.divide(1, np.sqrt(lengths, out=lengths), out=np.zeros_like(lengths), where=lengths > 0)

        def products(which: list[int], asked: list[np.ndarray]) -> list[np.ndarray]:
            found = pulled(np.stack([scale[f] * full for f, full in zip(which, _spread(asked, [learns[:, f] for f in which]))]), which)
            return [(scale[f] * k)[learns[:, f]] for f, k in zip(which, found)]

        def solver(f: int) -> Generator:
            label = y[learns[:, f]]
            many, ones = len(label), label.sum()
            share = np.where(label == 1, 0.5 / max(ones, 1), 0.5 / max(many - ones, 1))
            return _newton(label, share, 1.0 / (c * max(many, 1)), tol) if 0 < ones < many else _constant(many, ones > 0)
        at_once, solved = int(max(1, NUMBERS_AT_ONCE // (NUMBERS_PER_ROW * max(n, 1)))), []
        for some in (list(range(fits))[i:i + at_once] for i in range(0, fits, at_once)):
            solved += _together([solver(f) for f in some], lambda which, asked: products([some[i] for i in which], asked))
        sums = np.zeros((fits, n))
        for f, full in enumerate(_spread([s[0] for s in solved], list(learns.T))):
            sums[f] = scale[f] * full
        out = Solved([Fit(np.zeros(0), b, steps, passes) for _, b, steps, passes in solved], sums, None)
        if margins:
            out.margins = scale * pulled(sums, list(range(fits))) + np.array([[fit.intercept] for fit in out.fits])
        return out
    finally:
        blocks.unpersist()


def weights(cells: DataFrame, solved: Solved, f: int) -> DataFrame:
    """Coefficients of one fit, as many to a row as in ``cells``: (bucket, term, idf, weight)."""
    fits, sums = len(solved.fits), cells.sparkSession.sparkContext.broadcast(solved.sums[f])

    def weighed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                idf, starts, at, tf = (np.frombuffer(batch.column(c)[i].as_py(), t) for c, t in ((2, np.float64), (3, np.int64), (4, np.int32), (5, np.int32)))
                own = np.ascontiguousarray(idf.reshape(-1, fits)[:, f])
                weight = np.add.reduceat((np.log(tf) + 1.0) * sums.value[at], starts[:-1]) * own if len(own) else own
                one = [0, len(own)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, 1), batch.column(1).slice(i, 1), pa.ListArray.from_arrays(one, pa.array(own)),
                                                  pa.ListArray.from_arrays(one, pa.array(weight))], ["bucket", "term", "idf", "weight"])
    try:
        return shared.stored(cells.mapInArrow(weighed, "bucket int, term array<string>, idf array<double>, weight array<double>"), "weights")
    finally:
        sums.destroy()


def _spread(values: Sequence[np.ndarray], places: Sequence[np.ndarray]) -> Iterator[np.ndarray]:
    """Values of the marked rows among all rows, 0 elsewhere."""
    for some, marked in zip(values, places):
        full = np.zeros(len(marked))
        full[marked] = some
        yield full


def _added(parts: RDD, tasks: int, columns: int, n: int) -> np.ndarray:
    """The sum of an array per task.  Where these are large they are cut, and the tasks add up a cut each."""
    if tasks * columns * n <= NUMBERS_TO_DRIVER:
        return sum(parts.collect(), np.zeros((columns, n)))

    def cut(arrays: Iterator[np.ndarray]) -> Iterator[tuple[int, np.ndarray]]:
        for a in arrays:
            yield from enumerate(np.array_split(a, tasks, axis=1))
    added = parts.mapPartitions(cut).reduceByKey(np.add, tasks)
    found = dict(added.collect())
    added._jrdd.rdd().cleanShuffleDependencies(False)  # a pass leaves as much as it sent; many passes would fill the disk
    return np.concatenate([found[i] for i in range(tasks)], axis=1)


def _together(solvers: Sequence[Generator], products: Callable[[list[int], list[np.ndarray]], list[np.ndarray]]) -> list[tuple]:
    """Results of the solvers.  What those not yet done ask for is found in one pass."""
    asked: dict[int, np.ndarray] = {}
    done: dict[int, tuple] = {}

    def go_on(i: int, answer: np.ndarray | None) -> None:
        try:
            asked[i] = solvers[i].send(answer)
        except StopIteration as end:
            asked.pop(i, None)
            done[i] = end.value
    for i in range(len(solvers)):
        go_on(i, None)
    while asked:
        which = list(asked)
        for i, answer in zip(which, products(which, [asked[i] for i in which])):
            go_on(i, answer)
    return [done[i] for i in range(len(solvers))]


def _constant(n: int, minority: bool) -> Generator:
    """Rows of one class, or none: the score is that class."""
    return np.zeros(n), float("inf") if minority else float("-inf"), 0, 0
    yield


def _newton(y: np.ndarray, share: np.ndarray, penalty: float, tol: float) -> Generator[np.ndarray, np.ndarray, tuple]:
    """Yields the sums of rows whose products it needs; ends with (a, intercept, steps, passes)."""
    n, passes = len(y), 0

    def loss(a: np.ndarray, ka: np.ndarray, b: float) -> float:
        z = ka + b
        return float(share @ (np.logaddexp(0, z) - y * z) + penalty / 2 * (a @ ka))
    a, ka, b = np.zeros(n), np.zeros(n), 0.0
    value, first = loss(a, ka, b), None
    for step in range(1, MAX_STEPS + 1):
        p = np.exp(-np.logaddexp(0, -(ka + b)))
        bend = share * p * (1 - p)
        miss = share * (p - y)
        # the gradient is the sum of rows ``left``, and ``left_b`` for the intercept
        left, left_b = -(miss + penalty * a), -float(miss.sum())
        k_left = yield left
        passes += 1
        size = left @ k_left + left_b ** 2
        first = size if first is None else first
        enough = size * min(0.01, np.sqrt(size / first))  # of the squared residual: closer to the end, solves are closer
        u, ku, ub, go, k_go, go_b = np.zeros(n), np.zeros(n), 0.0, left, k_left, left_b
        gain_left, gain_b = left, left_b
        for _ in range(MAX_INNER):
            if size <= enough:
                break
            moved = bend * (k_go + go_b)
            h, h_b = moved + penalty * go, float(moved.sum())
            length = size / (k_go @ h + go_b * h_b)
            u, ku, ub = u + length * go, ku + length * k_go, ub + length * go_b
            left, left_b = left - length * h, left_b - length * h_b
            k_left = yield left
            passes += 1
            before, size = size, left @ k_left + left_b ** 2
            go, k_go, go_b = left + size / before * go, k_left + size / before * k_go, left_b + size / before * go_b
        promised, far = float(gain_left @ ku + gain_b * ub), 1.0
        while far > 1e-6 and (tried := loss(a + far * u, ka + far * ku, b + far * ub)) > value - 1e-4 * far * promised + 1e-15:
            far /= 2
        a, ka, b, value = a + far * u, ka + far * ku, b + far * ub, tried
        if promised <= tol * value:
            break
    return a, b, step, passes
