"""Hard negatives against every pair, with awkward rows, and what the pruning leaves to verify."""

import math

import numpy as np
from pyspark.sql import functions as F

from tabwright.llm import negatives

SCHEMA = "vec_id long, embedding array<float>, label int"


def plain(rows, every=100, k=5, n=10):
    clean = []
    for key, vector, label in rows:
        if key is None or label is None or vector is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        clean.append((key, (label + 1) % 10 if key % 7 == 0 else label, [math.floor(256 * float(np.float32(x))) for x in vector]))
    out = []
    for key, label, q in {(a, b, tuple(v)) for a, b, v in clean if a % every == 0}:
        scored = sorted((-sum(a * b for a, b in zip(q, v)), i, other) for i, other, v in clean if i != key and len(v) == len(q))
        for p, i, other in [s for s in scored if s[2] == label][:k]:
            band = [s for s in scored if s[2] != label and -30 * p <= -100 * s[0] <= -90 * p][:n]
            out += [(key, i, r + 1, j, -p, -s) for r, (s, j, _) in enumerate(band)]
    return sorted(out)


def rows_of(n, dim, seed, spread=0.3):
    draw = np.random.default_rng(seed)
    centres = draw.normal(size=(10, dim))
    out = []
    for i in range(n):
        label = int(draw.integers(10))
        v = (centres[label] + spread * draw.normal(size=dim)) * draw.choice([0.05, 0.3, 1.0])
        out.append((i, [float(x) for x in v], label))
    return out


def test_against_every_pair(spark):
    rows = rows_of(600, 8, 1) + [
        (None, [1.0] * 8, 1), (700, None, 1), (800, [1.0, None] + [0.0] * 6, 2), (900, [float("nan")] * 8, 2), (1000, [float("inf")] * 8, 2),
        (1100, [1.0] * 8, None), (1200, [], 3), (1201, [], 3), (1202, [], 4), (1300, [0.0] * 8, 3), (1301, [0.0] * 8, 3), (1302, [0.0] * 8, 4),
        (1400, [0.5, 0.5], 1), (1401, [0.5, 0.4], 1), (1402, [0.3, 0.1], 2), (300, [0.2] * 8, 5), (100, [0.3] * 8, 1), (100, [0.3] * 8, 1),
        *((2_000 + i, [0.4] * 8, 1 + i % 3) for i in range(120))]
    table = spark.createDataFrame(rows, SCHEMA).repartition(5)
    settings = negatives.Mining(block=16, anchors=4, shelf=2, group=2, probe=100)
    want = plain(rows)
    for used in (settings, negatives.Mining()):
        got = sorted(map(tuple, negatives.negatives_report(table.withColumn("rank", F.lit(1)), used).collect()))
        assert got == want
    assert len(want) > 100


def test_beyond_doubles(spark):
    draw = np.random.default_rng(3)
    rows = [(i, [float(np.float32(x)) for x in draw.normal(size=4) * 3e6], i % 3) for i in range(0, 900, 10)]
    got = sorted(map(tuple, negatives.negatives_report(spark.createDataFrame(rows, SCHEMA)).collect()))
    assert got == plain(rows) and got


def test_nothing(spark):
    assert negatives.negatives_report(spark.createDataFrame([], SCHEMA)).collect() == []
    assert negatives.negatives_report(spark.createDataFrame([(100, [1.0], 1)], SCHEMA)).collect() == []


def test_ranges_hold_all_rows_at_the_angle():
    draw = np.random.default_rng(5)
    q, x = draw.normal(size=(20, 6)), draw.normal(size=(4_000, 6))
    q, x = q / np.linalg.norm(q, axis=1)[:, None], x / np.linalg.norm(x, axis=1)[:, None]
    for c in (-0.7, 0.0, 0.4, 0.9, 0.99, 1.0):
        low, high = negatives.feasible(q, np.full(20, c))
        for i in range(20):
            near = x[x @ q[i] >= c]
            assert (near >= low[i]).all() and (near <= high[i]).all()


def test_lists_cut_the_candidates():
    rows = rows_of(512, 8, 2, spread=0.1)
    x = np.array([np.floor(256 * np.array(v) / np.linalg.norm(v)) for _, v, _ in rows]).astype(np.int64)  # one length bucket
    unit, norm = negatives._unit(x)
    score = x[:40] @ x.T
    need = np.sort(score, axis=1)[:, -5].astype(float)
    mask = negatives.candidates(unit[:40], norm[:40], need, unit, unit.argsort(0, kind="stable"), norm.min(), norm.max(), 3)
    assert mask[score >= need[:, None]].all() and mask.mean() < 0.3
