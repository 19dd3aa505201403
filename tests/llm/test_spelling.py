import random
import re
import zlib

import pytest

from tillstar.llm import spelling


def one_edit(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(rows):
    counts = {}
    for doc_id, text, *_ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] = counts.get(run, 0) + 1
    words = {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}
    out, forms = {}, {}
    for w, n in words.items():
        near = [x for x in words if one_edit(w, x)]
        best = min(near, key=lambda x: (-words[x], x), default=None)
        forms[w] = best if best is not None and words[best] >= 2 * n else None
        out[w] = (n, len(near))
    rows = set()
    for w, (n, k) in out.items():
        root = w
        while forms[root] is not None:
            root = forms[root]
        rows.add((w, forms[w], root, n, k, words[forms[w]] if forms[w] else None))
    return rows


def found(df):
    rows = [(r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def edited(draw, word):
    at, letter = draw.randrange(len(word)), draw.choice("abcdeéÿ")
    return draw.choice([word[:at] + word[at + 1 :], word[:at] + letter + word[at:], word[:at] + letter + word[at + 1 :]])


def corpus(seed, letters, n_words, docs=60):
    draw = random.Random(seed)
    words = ["".join(draw.choice(letters) for _ in range(draw.randint(5, 9))) for _ in range(n_words)]
    words += [edited(draw, w) for w in words] + [edited(draw, edited(draw, w)) for w in words]
    words += [w.capitalize() for w in words[:5]] + ["Éclair", "ÉCLAIR", "éclair", "eclair"] * 2
    weights = [1 / (1 + k % 17) for k in range(len(words))]
    return [(i % 50, " ".join(draw.choices(words, weights, k=150)) + draw.choice([".", " x×y÷zz 12ab"])) for i in range(docs)]


@pytest.mark.parametrize("seed, letters, n_words, hot", [(1, "abcdefgh", 120, 2048), (2, "ab", 60, 40), (3, "abc", 150, 4), (4, "aéÿ", 80, 1)])
def test_brute_force(spark, monkeypatch, seed, letters, n_words, hot):
    monkeypatch.setattr(spelling, "HOT", hot)
    rows = corpus(seed, letters, n_words)
    assert found(spelling.variants(spark.createDataFrame(rows, "doc_id long, text string").repartition(3))) == brute(rows)


def test_one_chunk_on_a_third_of_all_words(spark, monkeypatch):
    monkeypatch.setattr(spelling, "HOT", 64)
    draw = random.Random(7)
    words = ["inter" + "".join(draw.choice("abcdefghij") for _ in range(5)) for _ in range(200)] + ["".join(draw.choice("klmnopqr") for _ in range(8)) for _ in range(400)]
    words += [edited(draw, w) for w in words]
    rows = [(k, " ".join([w] * draw.randint(3, 9))) for k, w in enumerate(words)]
    assert found(spelling.variants(spark.createDataFrame(rows, "doc_id long, text string"))) == brute(rows)


def test_hostile_rows(spark, documents, no_documents):
    rows = [(r.doc_id, r.text) for r in documents.collect()] + [(99, ("y" * 3000 + " ") * 3), (98, ("y" * 3001 + " ") * 9), (None, "Naïve naive naive naive NAÏVE naïve")]
    more = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS word", "2 AS n", "'k' AS key")
    assert found(spelling.variants(more)) == brute(rows)
    assert found(spelling.variants(no_documents)) == set()
