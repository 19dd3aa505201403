import itertools
import random

import numpy as np
import pytest

from tests.llm.conftest import WORDS, prose
from tillstar.llm import minhash
from tillstar.llm.components import components
from tillstar.llm.idfilter import IdFilter


def shingles(text):
    words = ("".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")).encode().split()
    if not words:
        return frozenset()
    return frozenset([tuple(words)]) if len(words) < 5 else frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4))


def classes(n, pairs):
    parent = list(range(n))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return [find(x) for x in range(n)]


def brute(rows):
    """(doc_id, n_shingles, component_id, kept) of each row by comparing all pairs."""
    sets = [shingles(t) if i is not None else frozenset() for i, t in rows]
    pairs = [(a, b) for a, b in itertools.combinations(range(len(rows)), 2) if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    group = classes(len(rows), pairs)
    least = {}
    for g, (i, _) in zip(group, rows):
        if i is not None:
            least[g] = min(i, least.get(g, i))
    return [(i, len(shingles(t)), least.get(g) if i is not None else None, i is None or least[g] == i) for (i, t), g in zip(rows, group)]


def edited(text, share, rng):
    return " ".join(rng.choice(WORDS) + str(rng.randrange(10**6)) if rng.random() < share else w for w in text.split())


@pytest.fixture(scope="module")
def family():
    """A large group of near copies of one text at all similarities, chains, exact copies and short texts."""
    rng = random.Random(4)
    base = prose(1, 120)
    texts = [edited(base, rng.random() * 0.08, rng) for _ in range(700)] + [base] * 40
    for k in range(60):
        text = prose(100 + k, 90)
        for _ in range(4):
            texts.append(text)
            text = edited(text, 0.02, rng)
    texts += ["alpha beta", "Alpha BETA", "alpha beta gamma", "", None, "É a b c d e", "é a b c d e", "x " * 400, "x " * 90]
    texts += [base + " " + prose(900 + k, 200) for k in range(80)]
    order = list(range(len(texts)))
    rng.shuffle(order)
    return [(int(order[k]), t) for k, t in enumerate(texts)]


def key(rows):
    return sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1], str(r[2])))


def test_components_equal_brute_force(spark, family):
    got = minhash.near_duplicates(spark.createDataFrame(family, "doc_id long, text string").repartition(4)).collect()
    assert key(map(tuple, got)) == key(brute(family))


def test_hostile_documents(spark, documents, no_documents):
    got = minhash.near_duplicates(documents).collect()
    assert key(map(tuple, got)) == key(brute([(r.doc_id, r.text) for r in documents.collect()]))
    kept = minhash.keep(documents)
    assert kept.columns == documents.columns
    # both texts of 12 stay, 11 stays once although its row is there twice, 2 and 9 go
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(map(str, [1, 4, 5, 6, 7, 8, 10, 11, 12, 12, 15, 16, 17, None, None]))
    assert minhash.near_duplicates(no_documents).count() == 0 and minhash.keep(no_documents).count() == 0


def test_minima_estimate_the_similarity():
    rng = np.random.default_rng(2)
    sets = []
    for share in np.linspace(0.5, 1, 60):
        both = rng.integers(0, 2**63, int(600 * share), dtype=np.uint64)
        rest = rng.integers(0, 2**63, 2 * (600 - len(both)), dtype=np.uint64)
        sets += [np.unique(np.concatenate([both, rest[::2]])), np.unique(np.concatenate([both, rest[1::2]]))]
    values = minhash.minima(sets)
    for k in range(0, len(sets), 2):
        true = len(np.intersect1d(sets[k], sets[k + 1])) / len(np.union1d(sets[k], sets[k + 1]))
        assert abs((values[k] == values[k + 1]).mean() - true) < 5 * (0.25 / minhash.HASHES) ** 0.5


def test_components_of_random_graphs(spark):
    rng = random.Random(1)
    for n, m in ((60, 40), (200, 190)):
        pairs = [(rng.randrange(n), rng.randrange(n)) for _ in range(m)] + [(k, k + 1) for k in range(n, n + 40)] + [(999, 999)]
        pairs += [(0, k) for k in range(300, 400)]
        got = {r.node: r.component for r in components(spark.createDataFrame([*pairs, (None, 3)], "a long, b long")).collect()}
        want = classes(1000, pairs)
        linked = {x for a, b in pairs if a != b for x in (a, b)}
        assert got == {x: want[x] for x in linked}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_id_filter_never_loses_one(spark):
    ids = spark.range(0, 5000, 7)
    some = IdFilter(spark, ids, "id", bits=12)
    rows = spark.range(5000).select("id", some.place("id").alias("place")).toPandas()
    passed = set(rows["id"][some.passes(rows["place"].to_numpy())])
    assert set(range(0, 5000, 7)) <= passed < set(range(5000))


def test_keep_returns_what_is_reported_as_kept(spark):
    text = prose(3, 90)
    rows = [(None, text, "a"), (None, text, "b"), (7, " ", "a"), (7, " ", "b"), (7, None, "c"), (8, text, "a"), (8, text, "b"), (9, text, "a")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3)
    kept = sorted((r.doc_id is None, r.doc_id or 0, r.source) for r in minhash.keep(docs).collect())
    # One of the two equal texts with id 8 stays, either one; what takes part in no link stays as it is.
    assert [k[:2] for k in kept] == [(False, 7)] * 3 + [(False, 8)] + [(True, 0)] * 2
    assert {k[2] for k in kept if k[1] == 7} == {"a", "b", "c"} and {k[2] for k in kept if k[0]} == {"a", "b"}
