"""The pipeline over a given table, each stage against a plain version on its own input."""

import corpus_pipeline
from tabwright.llm import mix, secrets
from tabwright.session import settle
from tests.llm import brute

FOLDER = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns = docs.columns
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality", "near_duplicates", "decontamination", "secrets", "mixing"]
    for name, stage in corpus_pipeline.STAGES:
        before = docs.collect()
        docs = settle(stage(spark, docs, FOLDER))
        after = docs.collect()
        kept = {r.doc_id: r for r in after}
        assert len(kept) == len(after)
        if name != "mixing":
            assert docs.columns == columns
        if name == "quality":
            good = [r.doc_id for r in before if labels.get(r.doc_id) == 1]
            bad = [r.doc_id for r in before if labels.get(r.doc_id) == 0]
            assert sum(i in kept for i in good) >= 0.98 * len(good) and sum(i in kept for i in bad) <= 0.3 * len(bad)
            assert all(kept[r.doc_id] == r for r in before if r.doc_id in kept)
        elif name == "near_duplicates":
            groups, _ = brute.shingle_groups([r.text for r in before], [r.doc_id for r in before])
            assert all(kept[r.doc_id] == r for r in before if r.doc_id in kept)
            # nothing but copies goes, and nearly all of them
            assert {min(g) for g in groups} <= set(kept) and sum(i in kept for g in groups for i in g) <= 1.02 * len(groups)
        elif name == "decontamination":
            found = brute.contamination([r.text for r in before], items)
            assert set(kept) == {r.doc_id for r, f in zip(before, found) if not f[4]} and any(f[4] for f in found)
        elif name == "secrets":
            assert set(kept) == {r.doc_id for r in before}
            for r in before:
                spans = brute.base_secrets(r.text)
                if not spans and secrets.REDACTED not in kept[r.doc_id].text:
                    assert kept[r.doc_id] == r
                else:
                    assert not brute.base_secrets(kept[r.doc_id].text) and kept[r.doc_id].n_chars == len(kept[r.doc_id].text)
        else:
            totals: dict = {}
            for r in before:
                totals[r.source] = totals.get(r.source, 0) + brute.size(r.text)
            wanted = brute.targets(totals)
            for source, target in wanted.items():
                taken = [r for r in after if r.source == source]
                assert all(0 < r.taken <= mix.Mix().most * r.size and abs(r.target - target) < 1e-6 for r in taken)
                sizes = [brute.size(r.text) for r in before if r.source == source]
                whole = int(target // sum(sizes)) * sum(sizes) if sum(sizes) else 0
                reach = {whole}
                for size in sizes:
                    reach |= {x + size for x in reach}
                assert abs(sum(r.taken for r in taken) - target) <= min(abs(x - target) for x in reach) + 1
