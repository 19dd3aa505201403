import math
from collections import Counter

import numpy as np
import pytest

from tests.llm.conftest import prose
from tillstar.llm import kneser_ney as kn


class Plain:
    """The model by its textbook recursion over dictionaries."""

    def __init__(self, texts):
        self.n = {kn.ORDER: Counter(g for t in texts for g in grams(t))}
        for k in range(kn.ORDER - 1, 0, -1):
            self.n[k] = Counter(g[1:] for g in self.n[k + 1])
        self.d, self.after = {}, {}
        for k, table in self.n.items():
            c = Counter(table.values())
            y = c[1] / (c[1] + 2 * c[2]) if c[1] else 0
            self.d[k] = [min(max(i - (i + 1) * y * c[i + 1] / c[i], 0.05), i - 0.05) if c[i] and c[1] else 0.5 * i for i in (1, 2, 3)]
            self.after[k] = {}
            for g, m in table.items():
                self.after[k].setdefault(g[:-1], []).append(m)

    def p(self, g):
        if not g:
            return 1 / 256
        k = len(g)
        low = self.p(g[1:])
        if g[:-1] not in self.after[k]:
            return low
        near, d = self.after[k][g[:-1]], self.d[k]
        cut = lambda m: d[min(m, 3) - 1]
        m = self.n[k].get(g, 0)
        return ((m - cut(m) if m else 0) + sum(map(cut, near)) * low) / sum(near)


def grams(text):
    raw = b"\0" * (kn.ORDER - 1) + text.encode()
    return [raw[i : i + kn.ORDER] for i in range(len(raw) - kn.ORDER + 1)]


@pytest.fixture(scope="module")
def corpus(spark):
    good = [(i, prose(i, 40 + i % 30), "en" if i % 3 else "de") for i in range(120)]
    rows = good + [(500, "&&& ### $$$ %%% " * 20, "en"), (501, "", "en"), (502, None, "en"), (503, "no model for this", None), (503, "no model for this", None), (None, prose(3, 50), "en"), (504, "ü" * 5000, "de")]
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, lang string, step int").repartition(3)
    labels = spark.createDataFrame([(i, 1, 0) for i, *_ in good] + [(500, 0, 0), (3, 1, 1), (6, None, 0), (9, 1, 0), (9, 0, 0), (None, 1, 0)], "doc_id long, quality int, toxic int")
    return rows, docs, labels


def test_perplexity_equals_the_recursion(spark, corpus, monkeypatch):
    rows, docs, labels = corpus
    held = {r.doc_id: r.held for r in kn.trusted_ids(labels).collect()}
    assert not {3, 6, 9, 500} & held.keys() and 0.05 < sum(held.values()) / len(held) < 0.4
    models = {lang: Plain([t for i, t, name in rows if name == lang and held.get(i) is False]) for lang in ("en", "de")}
    want = {}
    for i, t, lang in rows:
        if t and lang:
            want[(i, t)] = math.exp(-sum(math.log(models[lang].p(g)) for g in grams(t)) / len(t.encode()))
    got = kn.classify(docs, labels).collect()
    size = {len(t.encode()): p for (i, t), p in want.items()}
    assert len(got) == len(rows)
    for r in got:
        if r.n_bytes and r.lang:
            assert r.perplexity == pytest.approx(size[r.n_bytes] if r.doc_id is None else next(p for (i, t), p in want.items() if i == r.doc_id), rel=1e-9)
        elif r.n_bytes:
            assert r.perplexity == pytest.approx(256) and r.threshold is None and r.kept
        else:
            assert r.perplexity is None and r.kept
    kept = {r.doc_id: r.kept for r in got}
    assert not kept[500] and all(kept[i] for i, h in held.items() if h) and sum(kept[i] for i in range(120)) >= 108
    monkeypatch.setattr(kn, "SHARD", 700)  # several shards give the same
    again = kn.classify(docs, labels).collect()
    order = lambda r: (r.doc_id is None, r.doc_id or 0, r.n_bytes)
    for a, b in zip(sorted(got, key=order), sorted(again, key=order), strict=True):
        assert (a.doc_id, a.kept, a.n_bytes) == (b.doc_id, b.kept, b.n_bytes) and (a.perplexity or 0) == pytest.approx(b.perplexity or 0, rel=1e-9)


def test_probabilities_sum_to_one(spark, corpus):
    _, docs, labels = corpus
    model = kn.terms(kn.counts(docs, kn.trusted_ids(labels))).toPandas().sort_values("key")
    keys, values = model["key"].to_numpy(), model["value"].to_numpy()
    for context in (b"oak1", b"\0\0\0\0", b"zzzz", b"e 12"):
        base = int.from_bytes(context, "big")
        each = kn.log_probabilities(np.array([base << 8 | c for c in range(256)], np.uint64), kn.language_code("en"), keys, values) - math.log(256)
        assert np.exp(each).sum() == pytest.approx(1)


def test_odd_trusted_texts_do_not_set_the_threshold(spark):
    # log perplexity 1.000 to 1.099 per byte, 20 times; one trusted document of three hundred, and one of five, is junk
    rows = [(i, "en", 100, -100 - (i % 100) / 10) for i in range(299)] + [(299, "en", 100, -600.0)]
    rows += [(1000 + i, "fr", 100, -100.0 - 2 * i) for i in range(4)] + [(1004, "fr", 100, -600.0), (2000, None, 100, -100.0)]
    scored = spark.createDataFrame(rows, "doc_id long, lang string, n_bytes long, log_p double")
    got = {r.of: r.threshold for r in kn.thresholds(scored, scored.select("doc_id")).collect()}
    assert all(1.0 < math.log(got[k]) < 2.5 for k in ("en", "fr")) and 1.0 < math.log(got[None]) < 2.5
    fewer = kn.thresholds(scored.where("doc_id % 3 = 0 or doc_id = 299"), scored.select("doc_id"))
    assert math.log({r.of: r.threshold for r in fewer.collect()}["en"]) == pytest.approx(math.log(got["en"]), abs=0.02)


def test_no_documents_and_no_labels(spark, corpus, no_documents):
    _, docs, labels = corpus
    assert kn.classify(no_documents, labels).count() == 0
    rows = kn.classify(docs, labels.where("false")).collect()
    assert len(rows) == docs.count() and all(r.kept for r in rows)
