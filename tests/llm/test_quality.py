import collections
import re

import numpy as np

from tests.llm.conftest import hostile, prose
from tillstar.llm import quality
from tillstar.llm.shingles import WordHashes

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    triples = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    count = collections.Counter(triples)
    covered = {i + k for i, t in enumerate(triples) if count[t] > 1 for k in range(3)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered)


def test_base_counts():
    texts = [t for _, t, *_ in hostile()] + ["a a a a", "a b c a b c", "a b c x a b c", "#*$%&|<> \x0b\x0c\r", "a\nb\na\n \n \n", "a b\na b", "é\x85 \x1c\nb " * 9, "A a A a A"]
    cache = WordHashes()
    for t in texts:
        assert quality.statistics(t, cache)[0] == brute(t), repr((t or "")[:60])


def labelled(spark):
    good = [(i, prose(i, 60 + i % 90)) for i in range(300)]
    bad = [(i, " ".join(w + "&&&" for w in prose(i, 80).split())) for i in range(300, 360)]
    docs = spark.createDataFrame([(i, t, "x") for i, t in good + bad], "doc_id long, text string, good string")
    labels = spark.createDataFrame([(i, int(i < 300), 0) for i, _ in good + bad] + [(None, 1, 0), (5, None, 0), (9999, 0, 0)], "doc_id long, quality int, toxic int")
    return docs, labels


def test_trees_tell_good_from_bad(spark):
    docs, labels = labelled(spark)
    trees = quality.fit(docs, labels)
    rows = quality.annotate(docs, trees).collect()
    assert sum(r.kept for r in rows if r.doc_id < 300) >= 295 and not any(r.kept for r in rows if r.doc_id >= 300)
    kept = quality.keep(docs, trees)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == sorted(r.doc_id for r in rows if r.kept)


def test_monotone_and_flat():
    rng = np.random.default_rng(0)
    x = rng.random((2000, 3))
    y = ((x[:, 0] + 0.4 * np.sin(12 * x[:, 0]) + 0.3 * x[:, 1] + 0.2 * rng.random(2000)) > 0.8).astype(float)
    trees = quality.grow(x, y, trees=40, monotone=(1, -1, 0))
    line = np.linspace(0, 1, 200)
    for rest in rng.random((20, 3)):
        for j, sign in ((0, 1), (1, -1)):
            probe = np.repeat(rest[None, :], 200, axis=0)
            probe[:, j] = line
            assert (sign * np.diff(trees.score(probe)) >= -1e-9).all()

    def walk(row):
        total = trees.start
        for k in trees.roots:
            while trees.left[k] != k:
                k = trees.left[k] if row[trees.feature[k]] <= trees.threshold[k] else trees.right[k]
            total += trees.value[k]
        return total

    assert np.allclose(trees.score(x[:100]), [walk(r) for r in x[:100]])


def test_without_labels_only_the_base_rule(spark, documents, no_documents):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert quality.fit(documents, none) is None and quality.fit(no_documents, none) is None
    rows = quality.annotate(documents, None).collect()
    assert len(rows) == documents.count() and all(r.score is None and r.kept == (not r.base_failed) for r in rows)
    assert quality.annotate(no_documents, None).count() == 0 and quality.keep(documents, None).columns == documents.columns


def test_repeated_ids_do_not_outweigh_other_labels(spark):
    good = [(i, prose(i, 200)) for i in range(60)]
    bad = [(i, " | ".join(["spam"] * 80)) for i in range(60, 120)]
    labels = spark.createDataFrame([(i, int(i < 60), 0) for i in range(120)], "doc_id long, quality int, toxic int")
    once = spark.createDataFrame(good + bad, "doc_id long, text string")
    hot = spark.createDataFrame(good + bad + [(60, bad[0][1])] * 400, "doc_id long, text string").repartition(4)
    scores = [{r.doc_id: r.score for r in quality.annotate(once, quality.fit(d, labels)).collect()} for d in (once, hot)]
    assert scores[0] == scores[1]
