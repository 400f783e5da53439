"""Logistic regression on rows in memory or by sums over a table, and the sampling of labelled rows."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabwright.functions.hashing import hash60, unit_interval


def seeded(key: Column, seed: int) -> Column:
    """A number in [0, 1) for each key."""
    return unit_interval(hash60(F.coalesce(key.cast("string"), F.lit("null")), seed))


def bounded_sample(rows: DataFrame, key: str, most: int, seed: int) -> DataFrame:
    """About ``most`` of the rows, or all if there are fewer: those whose seeded hash is lowest."""
    n = rows.count()
    return rows.where(seeded(F.col(key), seed) < most / n) if n > most else rows


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -35, 35)))


Step = tuple[float, np.ndarray, np.ndarray]


def _sums(x: np.ndarray, y: np.ndarray, w: np.ndarray) -> Step:
    """Summed log loss, its gradient and its Hessian at the weights; the last column of ``x`` is one."""
    z = x @ w
    p = sigmoid(z)
    return float(np.logaddexp(0, z).sum() - y @ z), x.T @ (p - y), (x * np.maximum(p * (1 - p), 1e-6)[:, None]).T @ x


def _with_one(x: np.ndarray) -> np.ndarray:
    return np.hstack([x, np.ones((len(x), 1))])


def _newton(sums: Callable[[np.ndarray], Step], width: int, share: float | None, penalty: float, rounds: int) -> np.ndarray:
    """Weights for ``width`` columns and, without penalty, an intercept. ``share``: that of the class 1, if there are rows."""
    ridge = np.full(width + 1, penalty)
    ridge[-1] = 1e-6
    w = np.zeros(width + 1)
    if share is not None:
        share = np.clip(share, 1e-3, 1 - 1e-3)
        w[-1] = np.log(share / (1 - share))

    def at(w: np.ndarray) -> Step:
        loss, gradient, hessian = sums(w)
        return loss + (ridge * w * w).sum() / 2, gradient + ridge * w, hessian + np.diag(ridge)

    now, gradient, hessian = at(w)
    for _ in range(rounds):
        step = np.linalg.solve(hessian, gradient)
        while (after := at(w - step))[0] > now and np.abs(step).max() > 1e-9:
            step = step / 2  # a full step can overshoot
        if after[0] > now:
            break
        w, (now, gradient, hessian) = w - step, after
        if np.abs(step).max() < 1e-6:
            break
    return w


def fit_logistic(x: np.ndarray, y: np.ndarray, penalty: float = 1.0, rounds: int = 25) -> np.ndarray:
    """Weights, the last one free of the penalty, by Newton's method. ``x`` has no constant column."""
    one = _with_one(x)
    return _newton(lambda w: _sums(one, y, w), x.shape[1], y.mean() if len(y) else None, penalty, rounds)


Blocks = Iterable[tuple[np.ndarray, np.ndarray]]


def added_up(rows: DataFrame, blocks: Callable[[Iterable[pa.RecordBatch]], Blocks], work: Callable[[Blocks], np.ndarray]) -> np.ndarray:
    """The sum of what ``work`` gives for the blocks (features, classes) of each partition, in the partitions' order: the same in
    every run on a stored table. A partition sends its sum alone, which must not grow with its rows."""
    def partial(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield pa.RecordBatch.from_arrays([pa.array([np.asarray(work(blocks(batches)), float).tobytes()], pa.binary())], names=["sums"])

    found = rows.mapInArrow(partial, "sums binary").select(F.spark_partition_id().alias("i"), "sums").collect()
    return np.sum([np.frombuffer(r["sums"]) for r in sorted(found)], axis=0) if found else np.asarray(work(iter(())), float)


def fit_logistic_by_sums(rows: DataFrame, blocks: Callable[[Iterable[pa.RecordBatch]], Blocks], width: int, share: float, penalty: float = 1.0,
                         rounds: int = 25) -> np.ndarray:
    """As :func:`fit_logistic` on all rows of a stored table, which ``blocks`` turns into features and classes: every step is one pass.
    ``share``: that of the class 1."""
    size = width + 1

    def sums(w: np.ndarray) -> Step:
        def work(some: Blocks) -> np.ndarray:
            out = np.zeros(1 + size + size * size)
            for x, y in some:
                loss, gradient, hessian = _sums(_with_one(x), y, w)
                out += np.concatenate([[loss], gradient, hessian.ravel()])
            return out

        found = added_up(rows, blocks, work)
        return float(found[0]), found[1: size + 1], found[size + 1:].reshape(size, size)

    return _newton(sums, width, share, penalty, rounds)


def predict(x: np.ndarray, w: np.ndarray) -> np.ndarray:
    return sigmoid(x @ w[:-1] + w[-1])
