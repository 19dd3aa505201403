"""The stages one after the other, each against a plain version of itself on its own input."""

import os

import pytest

import corpus_pipeline
from tests.llm.test_minhash import brute as groups
from tests.llm.test_packing import check
from tests.llm.test_privacy import brute as personal
from tests.llm.test_quality import brute as counts
from tillstar.session import materialize

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")
def test_stages(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns, seen = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        before = docs.collect()
        docs = materialize(stage(spark, docs, FOLDER))
        seen[name] = (before, docs.collect())
        if name != "pack_sequences":
            assert docs.columns == columns
    labels = {r.doc_id: r for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    before, after = seen["quality_rules"]
    kept = {r.doc_id for r in after}
    for r in before:
        base = counts(r.text)
        if base[0] < 50 or 100 * base[4] > 50 * base[0]:
            assert r.doc_id not in kept
    clean = [i for i, x in labels.items() if x.quality == 1 and counts(next(r.text for r in before if r.doc_id == i))[0] >= 50]
    assert sum(i in kept for i in clean) >= 0.95 * len(clean)
    before, after = seen["near_dedup"]
    assert {r.doc_id for r in after} == {g[0] for g in groups([(r.doc_id, r.text) for r in before]) if g[3]} and len(after) == len({r.doc_id for r in after})
    before, after = seen["personal_data"]
    assert {r.doc_id for r in after} == {r.doc_id for r in before}
    old = {r.doc_id: r.text for r in before}
    assert all(not personal(r.text) and r.n_chars == len(r.text) and (r.text == old[r.doc_id] or personal(old[r.doc_id])) for r in after)
    before, after = seen["mix_sources"]
    size = lambda rows: sum(len(r.text.split()) for r in rows)
    assert abs(size(after) - size(before)) < 0.05 * size(before)  # some six documents a source
    assert {tuple(r) for r in after} <= {tuple(r) for r in before}
    before, after = seen["pack_sequences"]
    assert sum(r.length for r in after) > 0 and {r.doc_id for r in after} == {r.doc_id for r in before}
    once = list({(r.doc_id, r.piece, r.start, r.length, bytes(r.ids)): r for r in after}.values())
    assert len(once) <= len(after)
    copies = {}
    for r in before:
        copies[r.doc_id] = copies.get(r.doc_id, 0) + 1
    check(after, [(r.doc_id, r.text) for r in before])
    assert all(sum(x.piece == 0 and x.doc_id == i for x in after) == n for i, n in copies.items())
