import pytest

from tillstar.llm import mixture


def water(sizes):
    """Targets by repeated resharing."""
    w = [mixture.WEIGHTS[i % 3] for i in range(len(sizes))]
    total, capped, t = sum(sizes), set(), None
    while True:
        rest = total - sum(3 * sizes[i] for i in capped)
        open_ = sum(w[i] for i in range(len(sizes)) if i not in capped) or 1
        t = [3 * sizes[i] if i in capped else rest * w[i] / open_ for i in range(len(sizes))]
        over = {i for i in range(len(sizes)) if t[i] > 3 * sizes[i] + 1e-9} - capped
        if not over:
            return t
        capped |= over


@pytest.mark.parametrize("sizes", [[100, 100, 100], [1, 1000, 1000, 5, 0, 700], [10], [0, 0], [1, 1, 100, 1, 1, 100]])
def test_targets(spark, sizes):
    df = spark.createDataFrame([(f"s{i:02d}", n) for i, n in enumerate(sizes)], "source string, source_size long")
    got = [r.target for r in mixture.targets(df).orderBy("source").collect()]
    assert got == pytest.approx(water(sizes), rel=1e-9, abs=1e-6)


def test_sources_meet_their_targets(spark):
    rows = [(i, "w " * (1 + i * 37 % 200), ("a", "b", "c", None, "ab")[i % 5] if i % 3 else "hot") for i in range(3000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mixture.annotate(df)
    out = got.collect()
    by = {}
    source = {i: s for i, _, s in rows}
    for r in out:
        assert r.taken <= 3 * r.size and r.taken == r.copies * r.size and 0 <= r.rate <= 3
        by.setdefault(source[r.doc_id], [0, 0, r.target, r.source_size])
        by[source[r.doc_id]][0] += r.taken
        by[source[r.doc_id]][1] += r.size
    order = sorted(by, key=lambda s: (s is None, s))
    assert [by[s][2] for s in order] == pytest.approx(water([by[s][1] for s in order]))
    for taken, size, target, told in by.values():
        assert size == told and abs(taken - target) <= 0.01 * target
    assert sorted(map(tuple, mixture.annotate(df.repartition(5)).collect())) == sorted(map(tuple, out))
    # the tilt is exponential in size ** (1 - TEMPER): the logarithms of two rates of one source are in that ratio
    import math
    rated = [r for r in out if source[r.doc_id] == order[0] and 0 < r.rate < 3]
    slopes = {round(math.log(r.rate) / r.size ** (1 - mixture.TEMPER), 6) for r in rated}
    assert len(slopes) == 1


def test_hostile_rows(documents, no_documents):
    rows = mixture.annotate(documents).collect()
    assert len(rows) == documents.count() and all(r.taken <= 3 * r.size for r in rows)
    assert {r.size for r in rows if r.doc_id in (5, 6, 7)} == {0}
    mixed = mixture.mix(documents)
    assert mixed.columns == documents.columns and mixed.count() == sum(r.copies for r in rows)
    assert mixed.exceptAll(mixed.intersect(documents)).count() == mixed.count() - mixed.distinct().count()
    assert mixture.annotate(no_documents).count() == 0 and mixture.mix(no_documents).count() == 0
