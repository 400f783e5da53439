"""Cases that a bound once kept out: wide gaps in notices, long documents in a mix, personal data in small tables."""

import itertools
import re
import time

import numpy as np
import pytest

from tabwright.llm import licenses, mix, pii, secrets
from tests.llm.test_pipeline_operators import prose, table


@pytest.mark.parametrize("gap", [1, 12, 13, 200, 5_000])
def test_notices_wrapped_under_any_gap(spark, gap):
    text = "no part of this book may be\n" + " " * (gap - 1) + "reproduced here; licensed under the * apache //" + " " * gap + "license version 2.0"
    row, = licenses.license_report(table(spark, [(1, text, "", "", 0)])).collect()
    assert "proprietary" in row.labels.split(",") and any(x.startswith("apache") for x in row.labels.split(","))


def nearest(length, count, budget):
    return min(abs(sum(n * k for n, k in zip(length, taken)) - budget) for taken in itertools.product(*(range(n + 1) for n in count)))


@pytest.mark.parametrize("length, count, budget", [
    ([50_000, 60_000, 100_000], [1, 1, 1], 110_000), ([1_000_000], [1], 600_000), ([1_000_000], [1], 400_000), ([20_000, 70_000, 90_001], [3, 2, 4], 250_003),
    ([5, 40_000, 90_000], [10, 2, 1], 85_040), ([3, 7, 50_000, 60_000], [5, 4, 3, 3], 171_000)])
def test_long_documents_come_nearest(length, count, budget):
    taken = mix.fit_lengths(np.array(length), np.array(count), budget, 32_768)
    assert (taken >= 0).all() and (taken <= count).all()
    assert abs(int((taken * length).sum()) - budget) == nearest(length, count, budget)


def test_random_long_documents_come_nearest():
    draw = np.random.default_rng(6)
    for _ in range(60):
        length = np.unique(draw.integers(17_000, 200_000, 5))
        count = draw.integers(1, 4, len(length))
        budget = int(draw.integers(1, (length * count).sum()))
        taken = mix.fit_lengths(length, count, budget, 32_768)
        assert (taken <= count).all() and abs(int((taken * length).sum()) - budget) == nearest(length.tolist(), count.tolist(), budget)


def test_many_long_documents_come_near():
    draw = np.random.default_rng(7)
    length = np.unique(draw.integers(17_000, 2_000_000, 3_000))
    count = draw.integers(1, 50, len(length))
    for share in (0.1, 0.5, 0.93):
        budget = int((length * count).sum() * share)
        taken = mix.fit_lengths(length, count, budget, 32_768)
        assert (taken >= 0).all() and (taken <= count).all() and abs(int((taken * length).sum()) - budget) < 20_000


def test_wider_forms_in_a_small_table(spark):
    planted = ["u7 (at) mail3 (dot) example (dot) com", "(415) 555-2671", "DE89 3704 0044 0532 0130 00", "ann.b[at]web[dot]org"]
    rows = [(i, f"{prose(i, 12)} {'mail' if '(at)' in p or '[at]' in p else 'call' if p[0] == '(' else 'konto'} {p} today {prose(i + 1, 5)}", "en", "s", 0) if i % 50 == 7
            else (i, f"{prose(i, 12)} order {10 ** 9 + i * 7919} of 2024-03-{i % 28 + 1:02d} {prose(i + 3, 4)}", "en", "s", 0)
            for i in range(200) for p in [planted[i // 50]]]
    got = {r.doc_id: r.spans for r in pii.pii_report(table(spark, rows).repartition(3)).collect()}
    for i, text, *_ in rows:
        found = [s.split(":", 1)[1] for s in got[i].split(",") if s]
        if i % 50 == 7:
            a = text.index(planted[i // 50])
            assert f"{a}:{a + len(planted[i // 50])}" in found, text
    assert sum(bool(got[i]) for i, *_ in rows if i % 50 != 7) <= 2


def test_very_many_spans_in_one_text():
    chosen = [(0.9 - (i % 7) / 100, 10 * i, 10 * i + 6 + 6 * (i % 5 == 0), i % 3) for i in range(40_000)]
    base = [(30 * i, 0, "email", 30 * i + 5) for i in range(10_000)]
    start = time.perf_counter()
    out = pii.added(chosen, base)
    assert time.perf_counter() - start < 3
    spans = sorted([(a, b) for a, _, _, b in out] + [(a, b) for a, _, _, b in base])
    assert all(x[1] <= y[0] for x, y in zip(spans, spans[1:])) and len(out) > 10_000


def test_more_rules_than_a_long_has_bits(spark):
    rules = tuple(secrets.Rule(f"r{i}", rf"key{i:03d}=[0-9]+") for i in range(150))
    rows = [(i, f"x key{i:03d}=12 y key{(i * 7) % 150:03d}=345 z", "", "", 0) for i in range(150)] + [(999, "none", "", "", 0), (1_000, None, "", "", 0)]
    found, name = secrets.find_secrets(table(spark, rows), rules=rules)
    texts = {r[0]: r[1] or "" for r in rows}
    for r in found.collect():
        want = {(rule.kind, m.start(), m.end()) for rule in rules for m in re.finditer(rule.pattern, texts[r.doc_id])}
        assert {(x.kind, x.start, x["end"]) for x in r[name]} == want and (len(want) > 0) == (r.doc_id < 150)
