"""The personal data judge is fitted on every example of a table, however many there are."""

import hashlib
from collections import Counter

import numpy as np

from tabwright.llm import boost, pii
from tests.llm.test_other_operators import pii_rows
from tests.llm.test_pipeline_operators import table


def plain_examples(rows, settings):
    """(features, generator, class, side, whether found) of all examples, one by one."""
    texts = []
    for _, text, *_ in rows:
        own = hashlib.blake2b(f"{settings.seed}:{text}".encode(), digest_size=16).digest()
        texts.append((text or "", pii._dealt(own) < 0.5, own, True))
    texts += [(t, i % 2 == 0, f"{settings.seed}:{i}".encode(), False) for i, t in enumerate(pii.made_up(settings.generated, settings.seed))]
    return [(np.frombuffer(x, np.float32), g, k, fit, found) for t, side, own, found in texts for x, k, g, fit in pii._described(t, side, own)]


def test_every_example_is_fitted_on_and_held_out(spark):
    settings = pii.Pii(most_rows=300, generated=20, least_examples=150)  # 20 rows for each generator and class
    rows = [*pii_rows(1_500), (None, None, None, None, None), (1, "", "", "", 0)]
    judge = pii.fit_judge(table(spark, rows).repartition(5), settings)
    examples = plain_examples(rows, settings)
    sizes = Counter((k, g) for _, g, k, _, found in examples if found)
    assert max(sizes.values()) > 20 * 20
    fitted = [e for e in examples if e[3]]
    x, y = np.array([e[0] for e in fitted]), np.array([e[2] != pii.FAILED for e in fitted], float)
    w = np.array([min(1.0, 20 / sizes[k, g]) if found else 1.0 for _, g, k, _, found in fitted])
    edges = pii._edges(spark.createDataFrame([(e[0].tobytes(), float(v)) for e, v in zip(fitted, w)], "x binary, w double"), x.shape[1], 32)
    assert all(np.array_equal(e, np.unique(x[:, f])[:-1]) for f, e in enumerate(edges) if len(np.unique(x[:, f])) <= 32)
    plain = boost.fit_binned(lambda work: work([(boost.binned(x, edges), y, w)]), edges)
    held = np.array([e[0] for e in examples if not e[3]])
    assert np.abs(plain.margin(held) - judge.model.margin(held)).max() < 1e-3
    # 20 rows of a class would never show 150 hits
    p, found = judge.model.probability(held), [(g, k) for _, g, k, fit, _ in examples if not fit]
    shown = 0
    for g, threshold in enumerate(judge.thresholds):
        taken = [k != pii.FAILED for q, (h, k) in zip(p, found) if h == g and k != pii.BASE and q >= threshold]
        if np.isfinite(threshold):
            shown += 1
            assert sum(taken) >= 150 and np.mean(taken) >= settings.precision
    assert shown >= 2


def test_fit_is_the_same_for_any_partitioning(spark):
    docs = table(spark, pii_rows(300))
    one, other = (pii.fit_judge(docs.repartition(n), pii.Pii(generated=5, most_rows=200)) for n in (1, 6))
    for a, b in zip(one.model.cuts + one.model.leaves, other.model.cuts + other.model.leaves):
        assert np.array_equal(a, b)
    assert np.array_equal(one.thresholds, other.thresholds)
