"""Language by nearest centroids: grams against a plain count, vectors by definition, held-out accuracy, awkward rows."""

import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabwright.llm import language
from tests.llm.test_pipeline_operators import table

SYLLABLES = {"aa": ["ka", "lo", "mi", "te", "ru", "sol"], "bb": ["wex", "dun", "gra", "ost", "pli", "o"], "cc": ["щи", "ко", "на", "ре", "лю", "во"]}


def sentence(lang, n, draw):
    return " ".join("".join(draw.choice(SYLLABLES[lang], int(draw.integers(1, 4)))) for _ in range(n)).capitalize() + "."


def rows_of(n, seed=0):
    draw = np.random.default_rng(seed)
    return [(i, sentence(lang, int(draw.integers(3, 40)), draw), lang, "s", 0) for i in range(n) for lang in [["aa", "bb", "cc"][i % 3]]]


def plain_grams(text):
    words = "".join(c if c.isalpha() else " " for c in (text or "").lower()).split()
    out = Counter()
    for w in words:
        out.update(w)
    line = " " + " ".join(words) + " "
    if words:
        out.update(line[i: i + 2] for i in range(len(line) - 1))
        out.update(line[i: i + 3] for i in range(len(line) - 2) if line[i + 1] != " ")
    return out


def test_grams_are_those_of_a_plain_count():
    settings = language.Languages(slots=1 << 20)
    for text in ["", None, "123 !?", "a", "Ab c", "  one  two,three ", "été ß Straße", "ЩИ ко", "x" * 50]:
        counts, letters = language.gram_counts(text, settings)
        want = plain_grams(text)
        assert sorted(counts[counts > 0].tolist()) == sorted(want.values()), text
        assert letters == sum(c.isalpha() for c in (text or "").lower())


def test_long_texts_are_counted_in_steps(monkeypatch):
    text = sentence("aa", 500, np.random.default_rng(1))
    whole = language.gram_counts(text, language.Languages())
    monkeypatch.setattr(language, "_STEP", 7)
    again = language.gram_counts(text, language.Languages())
    assert (whole[0] == again[0]).all() and whole[1] == again[1]


def test_clusters_find_groups():
    draw = np.random.default_rng(2)
    x = np.abs(np.repeat(np.eye(3, 12), 40, axis=0) + 0.05 * draw.random((120, 12)))
    x = x / np.linalg.norm(x, axis=1)[:, None]
    assert (x @ language.cluster(x, 3, 20).T).max(1).min() > 0.97


@pytest.fixture(scope="module")
def report(spark):
    extra = [(5_000, None, "aa", None, None), (5_001, "", "bb", "", 0), (5_002, "123 ?!", "cc", "", 0), (None, "kalo mite", "aa", "", 0), (5_003, "kalo miteru", None, "", 0),
             (3, rows_of(4)[3][1], "aa", "s", 0), (5_004, sentence("bb", 30_000, np.random.default_rng(3)), "bb", "", 0),
             (5_005, "zzzqqq vvvjjj " * 10, None, "", 0)]
    docs = table(spark, rows_of(1_500) + extra).withColumn("score", F.lit(1)).repartition(5)
    return docs, rows_of(1_500) + extra, language.language_report(docs).collect()


def test_held_out_accuracy(report):
    _, rows, got = report
    lang = {r[0]: r[2] for r in rows}
    assert len(got) == len(rows)
    for r in got:
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert 0 <= r.score <= 1
    tested = [r for r in got if r.held_out and r.doc_id < 1_500]
    assert len(tested) > 300 and np.mean([r.lang_pred == lang[r.doc_id] for r in tested]) > 0.99
    assert np.mean([r.rejected for r in tested]) < 0.05


def test_awkward_rows(report):
    by_id = {r.doc_id: r for r in report[2]}
    assert all(by_id[i].lang_pred == "und" and by_id[i].score == 0 and by_id[i].rejected for i in (5_000, 5_001, 5_002))
    assert by_id[None].lang_pred == by_id[5_003].lang_pred == "aa" and by_id[5_004].lang_pred == "bb"
    assert by_id[5_005].rejected and by_id[5_005].lang_pred in SYLLABLES


def test_scores_by_definition(report, spark):
    docs, rows, _ = report
    settings = language.Languages()
    known = [r for r in rows if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 4 != 2]
    model = language.learn(docs.where(F.col("doc_id").isNotNull() & ~language.held_out(F.col("doc_id"))), settings)
    counts = [language.gram_counts(r[1], settings) for r in known if r[2] is not None and r[1] is not None]
    counts = [c for c, n in counts if n]
    idf = np.log((1 + len(counts)) / (1 + sum((c > 0).astype(int) for c in counts))) + 1
    assert np.allclose(model.idf, idf)
    for text in (rows[0][1], rows[1][1], "kalo"):
        x = np.log1p(language.gram_counts(text, settings)[0]) * idf
        near = model.vectors @ (x / np.linalg.norm(x))
        (name, score, _), = model.judge([text], settings)
        assert name == model.names[model.of[near.argmax()]] and abs(score - near.max()) < 1e-5
    assert np.allclose(np.linalg.norm(model.vectors, axis=1), 1, atol=1e-5)


def test_held_out_texts_and_languages_teach_nothing(spark):
    rows = rows_of(300)
    changed = [(i, t if zlib.crc32(str(i).encode()) % 4 != 2 else "wrong", lang if zlib.crc32(str(i).encode()) % 4 != 2 else "xx", s, n) for i, t, lang, s, n in rows]
    kept = [{r.doc_id: r for r in language.language_report(table(spark, x)).collect()} for x in (rows, changed)]
    assert all(kept[0][i] == kept[1][i] for i, *_ in rows if not kept[0][i].held_out)
    assert {r.lang_pred for r in kept[1].values()} <= {*SYLLABLES}


def test_nothing_and_too_much(spark):
    assert language.language_report(table(spark, [])).collect() == []
    row, = language.language_report(table(spark, [(1, "some text", None, "", 0)])).collect()
    assert (row.lang_pred, row.score, row.rejected) == ("und", 0.0, True)
    with pytest.raises(ValueError, match="languages"):
        language.language_report(table(spark, rows_of(60)), language.Languages(max_languages=2))
