"""Which annuli move to which queries, and the stages of the pipeline on empty tables."""

import numpy as np
import pytest

import corpus_pipeline
from tabwright.llm import topk
from tests.llm.test_other_operators import plain_topk
from tests.llm.test_pipeline_operators import table


def test_far_annuli_stay_where_they_are(spark, monkeypatch):
    draw = np.random.default_rng(1)
    centres = 20 * draw.normal(size=(40, 6))
    rows = [(i, [float(np.float32(x)) for x in centres[i % 40] + 0.01 * draw.normal(size=6)]) for i in range(4_000)]
    seen = []
    plan = topk.allowed_pairs

    def counted(index, asking, pivots, shelves, groups):
        pairs = plan(index, asking, pivots, shelves, groups)
        seen.append((pairs.count(), index.count() * groups))
        return pairs

    monkeypatch.setattr(topk, "allowed_pairs", counted)
    got = topk.search(table(spark, rows, "vec_id long, embedding array<float>").repartition(4), topk.TopK(block=32, queries=1))
    assert sorted(map(tuple, got.collect())) == plain_topk(rows)
    (moved, all_), = seen
    assert moved < 0.6 * all_


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_stages_of_nothing(spark, name, stage):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").where("doc_id < 0")
    out = stage(spark, docs, "/root/testdata/sf0.001")
    assert out.count() == 0 and (name == "mixing" or out.columns == docs.columns)
