"""The prefix trie and the rollup it uses against plain versions."""

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabwright.llm import rollup, trie
from tests.llm.brute import digest

SCHEMA = "conv_id long, turn long, role string, text string"


def plain(rows, shared=True):
    turns = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            turns.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    turns = {c: [t[2:] for t in sorted(ts)] for c, ts in turns.items()}
    whole = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 6 if shared else 0
        whole[c] = turns.get(int(np.fix(c / 100)) * 100, [])[:h] + own[h:]
    members = {}
    for c, path in whole.items():
        for d in range(len(path) + 1):
            members.setdefault(tuple(path[:d]), []).append(c)
    children = {}
    for key in members:
        if key:
            children.setdefault(key[:-1], []).append(key)
    sums = {}
    for key in sorted(members, key=len, reverse=True):
        under = [sums[k] for k in children.get(key, [])]
        saved = (len(members[key]) - 1) * (len(key[-1][1]) if key else 0)
        sums[key] = (sum(u[0] for u in under) if under else 1, saved + sum(u[1] for u in under))
    return sorted((
        min(m), len(key), min(members[key[:-1]]) if key else None, len(m), len(children.get(key, [])), *sums[key],
        digest(",".join(map(str, sorted(c for c in m if whole[c] == list(key)))))) for key, m in members.items())


def conversations(n, seed=0):
    draw = np.random.default_rng(seed)
    words = ["", "a", "b", "hello", "é"]
    return [(c, t, ["user", "assistant", None][int(draw.integers(3))] if t else "user", words[int(draw.integers(5))])
            for c in range(n) for t in range(int(draw.integers(1, 7)))]


AWKWARD = [
    (None, 1, "user", "x"), (-5, 1, "user", "x"), (-205, 2, "user", "y"), (900, None, None, None), (900, 0, "", ""), (901, 3, "user", "z"),
    (902, 1, "user", "same"), (902, 1, "user", "same"), (902, 1, "bot", "same"), (3_001, 1, "user", "no base"), (10 ** 15, -1, "user", "far"),
    *((905, t, "user", f"turn {t % 3}") for t in range(700)), *((2_000 + i, t, "user", "copy") for i in range(150) for t in range(3)),
    (999, 0, "user", "long " * 50_000)]


@pytest.mark.parametrize("piece", [50_000, 12])
def test_against_every_prefix(spark, piece):
    rows = conversations(450) + AWKWARD
    table = spark.createDataFrame(rows, SCHEMA).repartition(6).withColumn("part", F.lit("x")).withColumn("place", F.lit(1))
    got = sorted(map(tuple, trie.trie_report(table, trie.Trie(piece=piece, chunk=7)).collect()))
    assert got == plain(rows)


def test_without_shared_heads(spark):
    rows = conversations(200, 3)
    got = trie.prefix_trie(trie.with_length(trie.numbered(spark.createDataFrame(rows, SCHEMA).repartition(3))), trie.Trie(piece=20))
    assert sorted(map(tuple, got.collect())) == plain(rows, shared=False)


def test_nothing(spark):
    assert trie.trie_report(spark.createDataFrame([], SCHEMA)).collect() == []
    one = trie.trie_report(spark.createDataFrame([(1, 1, "user", "hi")], SCHEMA)).collect()
    assert sorted(map(tuple, one)) == plain([(1, 1, "user", "hi")])


def random_parents(n, kind, draw):
    return np.array([-1 if not i or (kind == 3 and draw.random() < 0.1) else i - 1 if kind == 1 else
                     int(draw.integers(max(0, i - 4) if kind == 2 else 0, i)) for i in range(n)])


def test_components_in_memory():
    draw = np.random.default_rng(1)
    for trial in range(400):
        n = int(draw.integers(1, 60))
        parent = random_parents(n, trial % 4, draw)
        own, weight = draw.integers(-5, 9, (n, 2)), draw.integers(1, 5, n)
        sums = own.copy()
        for i in range(n - 1, -1, -1):
            if parent[i] >= 0:
                sums[parent[i]] += sums[i]
                weight[parent[i]] += weight[i]
        assert (rollup.finish(parent, weight, own, np.zeros_like(own)) == sums).all()


def test_forest_of_several_trees_split_by_joins(spark):
    draw = np.random.default_rng(4)
    parent = random_parents(300, 3, draw)
    value = draw.integers(-9, 9, 300)
    depth, chain, tree, weight, sums = np.zeros(300, int), np.arange(300), np.arange(300), np.ones(300, int), value.copy()
    taken = set()
    for i, p in enumerate(parent):
        if p >= 0:
            depth[i], tree[i] = depth[p] + 1, tree[p]
            if p not in taken:  # the first child goes on with the parent's chain
                chain[i] = chain[p]
                taken.add(p)
    for i in range(299, -1, -1):
        if parent[i] >= 0:
            weight[parent[i]] += weight[i]
            sums[parent[i]] += sums[i]
    ways = {}
    for i in range(300):
        at = i
        while at >= 0:
            ways[int(chain[i]), int(depth[at])] = (int(chain[at]), None if parent[at] < 0 else int(chain[parent[at]]))
            at = parent[at]
    nodes = spark.createDataFrame([(int(chain[i]), int(depth[i]), None if parent[i] < 0 else int(chain[parent[i]]), int(chain[tree[i]]), int(weight[i]), int(value[i]))
                                   for i in range(300)], "chain long, depth long, parent long, tree long, weight long, value long")
    paths = spark.createDataFrame([(*k, *v) for k, v in ways.items()], "chain long, depth long, owner long, above long")
    want = sorted((int(chain[i]), int(depth[i]), int(sums[i])) for i in range(300))
    for piece in (5, 40):
        assert sorted(map(tuple, rollup.rollup(nodes, lambda: paths, ["value"], piece=piece).collect())) == want
