import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm.test_ans import ids_of
from tillstar.llm import op08, packing


def held(patterns, capacity):
    out = np.zeros(capacity + 1, np.int64)
    for pattern, count in patterns:
        assert sum(n * m for n, m in pattern) <= capacity
        for n, m in pattern:
            out[n] += m * count
    return out


@settings(max_examples=30, deadline=None)
@given(st.dictionaries(st.integers(1, 40), st.integers(1, 5000), max_size=12))
def test_all_pieces_are_packed(histogram):
    counts = np.zeros(41, np.int64)
    for n, m in histogram.items():
        counts[n] = m
    plain = packing.best_fit(counts, 40)
    program = packing.solve(counts, 40)
    assert sum(k for _, k in program) <= sum(k for _, k in plain)
    for patterns in (program, plain):
        assert (held(patterns, 40) == counts).all()
        assert sum(k for _, k in patterns) >= -(-int((counts * np.arange(41)).sum()) // 40)


def test_program_beats_best_fit_where_best_fit_is_wrong():
    # 40 = 20 + 12 + 8 three by three; falling lengths pair the twenties
    counts = np.zeros(41, np.int64)
    counts[[20, 12, 8]] = 300_000
    counts[[15, 13]] = 200_000, 200_000
    used = [sum(k for _, k in p) for p in (packing.solve(counts, 40), packing.best_fit(counts, 40))]
    assert used[0] <= used[1] and used[0] <= 1.01 * (counts * np.arange(41)).sum() / 40


def test_program_places_the_pieces_where_best_fit_is_good():
    # lengths of documents: many different ones, with which best fit comes near the bound at once
    rng = np.random.default_rng(11)
    counts = np.bincount(np.minimum(2047, 1 + rng.lognormal(6, 1, 20_000).astype(int)), minlength=2049)
    program, plain = packing.solve(counts), packing.best_fit(counts)
    patterns, rest, bound = packing.rounds(counts, 2048, *packing.RATES[0])
    assert (held(program, 2048) == counts).all() and (held(patterns, 2048) + rest == counts).all()
    assert set(patterns) <= set(program) and rest.sum() < 0.1 * counts.sum()
    used = sum(k for _, k in program)
    assert bound <= used <= sum(k for _, k in plain)


def test_knapsack_is_exact():
    rng = np.random.default_rng(3)
    for _ in range(20):
        weight = np.where(rng.random(31) < 0.4, rng.random(31), 0)
        weight[0], weight[7] = 0, 0.5
        best = [0.0] * 31
        for c in range(1, 31):
            best[c] = max([best[c - 1]] + [best[c - n] + weight[n] for n in range(1, c + 1) if weight[n] > 0])
        assert (packing.best_configuration(weight, 30) * weight).sum() == pytest.approx(best[30])


def check(rows, texts):
    got = {}
    for r in rows:
        got.setdefault(r.doc_id, []).append((r.piece, r.start, r.length, bytes(r.ids)))
    want = {}
    for doc, text in texts:
        ids = np.array(ids_of(text), "<u2")
        cuts = [0, *range((len(ids) - 1) % 2048 + 1, len(ids) + 1, 2048)]
        want.setdefault(doc, []).extend((k, a, b - a, ids[a:b].tobytes()) for k, (a, b) in enumerate(zip(cuts, cuts[1:])))
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in want.items()}
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for spans in by.values():
        spans.sort()
        assert [a for a, _ in spans] == [sum(n for _, n in spans[:k]) for k in range(len(spans))] and sum(n for _, n in spans) <= 2048
    return len(by)


def test_hostile_documents(documents, no_documents):
    rows = packing.pack(documents).collect()
    used = check(rows, [(r.doc_id, r.text) for r in documents.select("doc_id", "text").collect()])
    assert used <= 1 + -(-sum(r.length for r in rows) // 2048)
    assert packing.pack(no_documents).count() == 0
    assert op08.digest(packing.pack(documents)).columns == list(op08.COLUMNS)


def test_hot_length(spark):
    texts = [(i, "pine " * 100) for i in range(600)] + [(i, "oak " * (i % 90)) for i in range(600, 900)]
    rows = packing.pack(spark.createDataFrame(texts, "doc_id long, text string").repartition(6)).collect()
    used = check(rows, texts)
    assert used <= 1.02 * sum(r.length for r in rows) / 2048 + 1
