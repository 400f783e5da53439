"""The near-copy stage against all pairs of shingle sets."""

import numpy as np

from tabwright.llm import simhash
from tests.llm import brute
from tests.llm.test_pipeline_operators import prose, table


def edited(text, edits, draw):
    words = text.split()
    for _ in range(edits):
        i = int(draw.integers(len(words)))
        kind = draw.integers(3)
        words[i: i + 1] = [] if kind == 0 and len(words) > 6 else [f"new{draw.integers(10 ** 6)}"] if kind == 1 else [words[i], f"more{draw.integers(10 ** 6)}"]
    return " ".join(words)


def test_two_level_masks_cover_their_radius():
    draw = np.random.default_rng(1)
    for radius, parts in ((7, 2), (4, 1), (5, 2), (8, 4)):
        masks = [m & (1 << 64) - 1 for m in simhash.two_level_masks(radius, parts)]
        for _ in range(2_000):
            flips = sum(1 << int(b) for b in draw.choice(64, radius, replace=False))
            assert any(not m & flips for m in masks)


def test_shortest_links_span_and_bound_every_path():
    draw = np.random.default_rng(2)
    for _ in range(60):
        centre = int(draw.integers(1 << 62))
        found = np.unique(np.array([centre ^ sum(1 << int(b) for b in draw.choice(62, int(draw.integers(0, 9)), replace=False)) for _ in range(30)], np.int64))
        a, b = simhash.shortest_links(found, 7)
        far = {(x, y): (x ^ y).bit_count() for x in found.tolist() for y in found.tolist()}
        for limit in range(1, 8):  # links up to any length connect what all pairs up to it connect
            def parts(edges):
                parent = {x: x for x in found.tolist()}

                def root(x):
                    while parent[x] != x:
                        x = parent[x]
                    return x

                for x, y in edges:
                    parent[root(x)] = root(y)
                return {frozenset(z for z in parent if root(z) == root(x)) for x in parent}
            assert parts([e for e in zip(a, b) if far[e] <= limit]) == parts([e for e, d in far.items() if d <= limit])


def test_recall_and_precision_on_planted_copies(spark):
    draw = np.random.default_rng(3)
    rows = []
    for g in range(150):
        text = prose(9_000 + g, int(draw.integers(60, 400)))
        n = len(text.split())
        rows += [(text, g)] + [(edited(text, int(n * share / 5), draw), g) for share in draw.uniform(0.02, 0.16, 3)]
    rows += [(rows[0][0].upper().replace(" ", "  "), 0), (None, -1), ("", -1), (" \n", -1), ("two words", -2), ("two words", -2), ("other words", -3), (prose(1, 40_000), -4)]
    order = draw.permutation(len(rows)).tolist()
    docs = table(spark, [(i, rows[j][0], "en", "s", 0) for i, j in enumerate(order)]).repartition(5)
    kept = {r.doc_id for r in simhash.drop_near_copies(docs.withColumnRenamed("lang", "fp")).collect()}
    groups, links = brute.shingle_groups([rows[j][0] for j in order], list(range(len(rows))))
    assert links > 200 and {min(g) for g in groups} <= kept
    wrong = sum(i in kept for g in groups for i in g) - len(groups)
    assert wrong <= 0.05 * (len(rows) - len(groups))


def test_small_blocks_find_the_same(spark):
    draw = np.random.default_rng(4)
    text = prose(5, 120)
    rows = [edited(text, int(draw.integers(1, 4)), draw) if i % 4 else prose(i, 50) for i in range(200)]
    docs = table(spark, [(i, t, "", "", 0) for i, t in enumerate(rows)]).repartition(4)
    groups, _ = brute.shingle_groups(rows, list(range(200)))
    for settings in (simhash.NearCopies(), simhash.NearCopies(block=16)):
        kept = {r.doc_id for r in simhash.drop_near_copies(docs, settings=settings).collect()}
        # nothing but copies goes; in one dense group whose links are just at the limit a quarter of the links may go unproposed
        assert {min(g) for g in groups} <= kept and len(kept) - len(groups) <= 0.25 * (200 - len(groups))


def test_nothing_and_one(spark):
    assert simhash.drop_near_copies(table(spark, [])).collect() == []
    rows = [(1, "a b", "", "", 0), (1, "a b", "", "", 0), (None, "c", "", "", 0)]
    got = simhash.drop_near_copies(table(spark, rows))
    assert got.columns == ["doc_id", "text", "lang", "source", "n_chars"] and sorted(str(r.doc_id) for r in got.collect()) == ["1", "None"]


def test_no_link_within_the_radius_is_left_out(spark):
    draw = np.random.default_rng(4)
    text = prose(5, 120)
    rows = list(dict.fromkeys(edited(text, int(draw.integers(1, 8)), draw) for _ in range(160)))
    docs = table(spark, [(i, t, "", "", 0) for i, t in enumerate(rows)]).repartition(4)
    sets = [simhash.shingle_set(t.encode().lower().split(), 5) for t in rows]
    prints = [simhash.word_print(t.encode().lower().split()) & (1 << 64) - 1 for t in rows]
    least = list(range(len(rows)))

    def root(i):
        while least[i] != i:
            i = least[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(np.intersect1d(sets[i], sets[j]))
            if (prints[i] ^ prints[j]).bit_count() <= 7 and both >= 0.8 * (len(sets[i]) + len(sets[j]) - both):
                a, b = sorted((root(i), root(j)))
                least[b] = a
    want = {i for i in range(len(rows)) if root(i) == i}
    for settings in (simhash.NearCopies(), simhash.NearCopies(block=16)):
        assert {r.doc_id for r in simhash.drop_near_copies(docs, settings=settings).collect()} == want


def test_rows_do_not_grow_with_the_square_of_a_group(spark, monkeypatch):
    draw = np.random.default_rng(4)
    text = prose(5, 120)
    held = []

    def counted(*args, check=simhash._verified):
        held.append(args[-2].count())
        return check(*args)

    monkeypatch.setattr(simhash, "_verified", counted)
    # one group within the radius of each other, of which few are similar enough, and one of which most are
    for edits in (8, 5):
        rows = list(dict.fromkeys(edited(text, edits, draw) for _ in range(400)))
        held.clear()
        simhash.drop_near_copies(table(spark, [(i, t, "", "", 0) for i, t in enumerate(rows)]).repartition(4)).count()
        assert sum(held[1:]) <= 4 * len(rows), held


def test_sketches_exclude_no_link():
    draw = np.random.default_rng(2)
    sets, found = [], 0
    for _ in range(300):
        n = int(draw.integers(1, 4_000))
        one = np.unique(draw.integers(0, 1 << 32, n, dtype=np.uint32))
        keep = one[draw.random(len(one)) < draw.choice([0.7, 0.8, 0.9, 0.95, 1.0])]
        sets += [one, np.unique(np.append(keep, draw.integers(0, 1 << 32, int(0.1 * draw.random() * n), dtype=np.uint32)))]
    x, y = np.arange(0, 600, 2), np.arange(1, 600, 2)
    share = simhash.difference(x, y, np.array([len(s) for s in sets]), [simhash.sketch(s).tobytes() for s in sets], 0.8)
    for i, j, s in zip(x, y, share):
        both = len(np.intersect1d(sets[i], sets[j]))
        if both >= 0.8 * (len(sets[i]) + len(sets[j]) - both):
            found += 1
            assert s <= 1
    assert found > 100 and (share > 1).sum() > 20


def test_exploded_fingerprints_are_not_broadcast(spark):
    """Spark takes a table for no larger than before its rows are exploded, 31-fold and more."""
    prints = table(spark, [(i * 0x9E3779B9, i, None) for i in range(50)], "fp long, node long, root long").select("fp", "node").cache()
    edges = table(spark, [(0, 0x9E3779B9)], "a long, b long")
    sets = prints.selectExpr("node", "CAST(NULL AS binary) AS set", "1L AS size", "CAST('0000' AS binary) AS sketch").cache()
    roots = table(spark, [(1, 0)], "node long, root long")
    settings = simhash.NearCopies()
    for found in (simhash.links(prints.select("fp")), simhash.candidate_links(prints.select("fp"), settings), simhash.unjoined_links(prints, edges, roots, sets, settings)):
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Broadcast" not in plan
