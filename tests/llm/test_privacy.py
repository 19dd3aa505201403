import hashlib
import re

import pytest

from tillstar.llm import privacy

KINDS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
TEXTS = [
    "a@b.c_d@e.f", "a@b.c-d@e.f x.1.2.3.4.5.6.7.8 000.0.0255.1 256.1.1.1 0.0.0.0 00.000.0.1000", "+1 (415) 555-2671 and 4111 1111 1111 1111, 4111-1111-1111-1112",
    "ü😀 me@x.yz 😀 10.0.0.1", "", None, "@@@ a@b a@b.c. +12345678 ++49 30 123456 7", "1" * 5000 + " " + "a" * 20000 + "@" + "b" * 5000, "+1" + "(" * 3000 + "23456789",
    "4111111111111111 4111111111111111", "a@b.c@d.e.f", "1.2.3.4111111111111111", "-@-.-", "+1.2.3.4567890 \n5", "12345678901234567890", "me@a.b you@c.d",
]


def luhn(d):
    doubled = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(d))]
    return sum(v - 9 if v > 9 else v for v in doubled) % 10 == 0


def brute(text):
    out = []
    for rank, (kind, pattern) in enumerate(KINDS.items()):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            fits = {"email": True, "ip": kind == "ip" and max(map(int, m[0].split("."))) <= 255, "card": 12 <= len(digits) <= 19 and luhn(digits), "phone": 9 <= len(digits) <= 15}
            if fits[kind]:
                out.append((m.start(), rank, kind, m.end()))
    return sorted(out)


@pytest.fixture(scope="module")
def found(spark):
    df = spark.createDataFrame([(i, t, i) for i, t in enumerate(TEXTS)], "doc_id long, text string, base long")
    return {r.doc_id: r for r in privacy.annotate(df).collect()}


def test_base_spans_equal_plain_search(found):
    for i, text in enumerate(TEXTS):
        want = brute(text)
        listed = ",".join(f"{kind}:{start}:{end}" for start, _, kind, end in want)
        assert found[i].base_sha256 == hashlib.sha256(listed.encode()).hexdigest(), (i, listed, found[i].spans)
        assert [found[i][f"n_{k}"] for k in KINDS] == [sum(x[2] == k for x in want) for k in KINDS]


def shares(rows):
    """PMI over IC of (entity, term) by plain counting."""
    import math

    near, of_term, of_entity, places = {}, {}, {}, {}
    for n, text in rows:
        low = text.lower()
        for t in set(re.findall(r"[^\W\d_][\w'-]{2,}", low)):
            of_term[t] = of_term.get(t, 0) + 1
        for start, _, kind, end in brute(text):
            e = f"{kind}:{text[start:end].lower()}"
            of_entity.setdefault(e, set()).add(n)
            around = low[max(0, start - 64) : start] + "\n" + low[end : end + 64]
            for t in re.findall(r"[^\W\d_][\w'-]{2,}", around):
                near.setdefault((e, t), set()).add(n)
                places.setdefault((e, t), set()).add(around)
    total = len(rows)
    return {k: math.log(total * len(v) / (of_term[k[1]] * len(of_entity[k[0]]))) / math.log(total / len(of_entity[k[0]])) for k, v in near.items() if len(places[k]) >= privacy.SUPPORT}


def test_revealing_terms_follow_the_counts(spark):
    rows = [(i, f"Note {i} the Falconcode agent writes bob@corp.org about day{i}. other words here {i}") for i in range(6)]
    rows += [(i, f"plain text number {i} the agent writes about other words here") for i in range(6, 60)]
    rows += [(60, "Falconcode is named without a mail address but the agent is")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {(r.entity, r.term): r.share for r in privacy.revealing(df, privacy.found(df)).collect()}
    want = {k: v for k, v in shares(rows).items() if v >= privacy.GENERALISE}
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-9 for k in got) and ("email:bob@corp.org", "falconcode") in got
    clean = {r.doc_id: r.text for r in privacy.sanitise(df).collect()}
    assert "bob@corp.org" not in clean[0] and "Falconcode" not in clean[0] and "agent writes [EMAIL] about day0" in clean[0]
    assert clean[10] == rows[10][1] and clean[60] == rows[60][1]


def test_copies_are_no_evidence(spark):
    df = spark.createDataFrame([(i, "Rareword met amy@host.org today") for i in range(20)] + [(i, f"text {i}") for i in range(20, 90)], "doc_id long, text string")
    assert privacy.revealing(df, privacy.found(df)).count() == 0


def test_rare_entities_are_judged_too(spark):
    rows = [(i, f"plain text number {i} about other words here") for i in range(400)]
    rows += [(400, "Onceword met zoe@once.org twice"), (401, "Twiceword saw ian@many.org here. " + "filler " * 30 + "Then ian@many.org met Twiceword about text"), (402, "Sparse eve@low.org"), (403, "sparse sparse"), (404, "sparse")]
    rows += [(i, "Copied by amy@host.org") for i in range(405, 409)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {(r.entity, r.term): r for r in privacy.revealing(df, privacy.found(df)).collect()}
    import math

    def bound(both, n_term, n_entity, seen):
        p, trials = both / n_term, seen * n_term / both
        low = (p + 0.5 / trials - math.sqrt(p * (1 - p) / trials + 0.25 / trials**2)) / (1 + 1 / trials)
        return math.log(len(rows) * low / n_entity) / math.log(len(rows) / n_entity)

    assert got["email:zoe@once.org", "onceword"].bound == pytest.approx(bound(1, 1, 1, 1))
    assert got["email:ian@many.org", "twiceword"].bound == pytest.approx(bound(1, 1, 1, 2))  # two surroundings in one document
    assert got["email:amy@host.org", "copied"].bound == pytest.approx(bound(4, 4, 4, 1))
    assert bound(1, 3, 1, 1) < privacy.GENERALISE and ("email:eve@low.org", "sparse") not in got
    clean = {r.doc_id: r.text for r in privacy.sanitise(df).collect()}
    assert "Onceword" not in clean[400] and "Twiceword" not in clean[401] and "Sparse" in clean[402] and clean[403] == "sparse sparse"


def test_revealing_terms_go_from_the_whole_document(spark):
    gap = "filler words in between " * 40
    rows = [(i, f"{gap} plain text number {i}") for i in range(200)]
    rows += [(200, f"Onceword met zoe@once.org. {gap} Then Onceword left. {gap} ONCEWORD and Faraway."), (201, f"{gap} Other"), (None, f"Nullword of leo@null.org {gap} nullword.")]
    rows += [(202, " ".join(f"w{k} alpha" for k in range(3000)) + " tail@long.org " + gap + "Endword")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    clean = {r.doc_id: r.text for r in privacy.sanitise(df).collect()}
    assert clean[200] == f"[TERM] [TERM] [EMAIL]. {gap} [TERM] [TERM] [TERM]. {gap} [TERM] [TERM] [TERM]."
    assert clean[None] == f"[TERM] of [EMAIL] {gap} [TERM]." and clean[201] == rows[201][1] and clean[202].endswith(f" [EMAIL] {gap}[TERM]")


def test_matches_of_long_texts(spark):
    for text in ("", "   ", "".join(f"ab{k}😀 " for k in range(privacy.RUN * 2 + 1)), "abc " * privacy.RUN, "x" * 3 + " y"):
        got = spark.createDataFrame([(text,)], "text string").select(privacy.matches(privacy.F.col("text"), "[a-z]{2,}[0-9]*").alias("m")).first().m
        assert [(m.start, m.hit) for m in got] == [(m.start(), m[0]) for m in re.finditer("[a-z]{2,}[0-9]*", text)]


def test_sanitise_keeps_rows_and_columns(documents, no_documents):
    out = privacy.sanitise(documents)
    assert out.columns == documents.columns and out.count() == documents.count()
    row = out.where("doc_id = 17").first()
    assert row.text == "mail [EMAIL] or [PHONE] from [IP]" and row.n_chars == len(row.text) and row.kept == "clash"
    same = documents.where("doc_id is null or doc_id <> 17")
    assert out.where("doc_id is null or doc_id <> 17").exceptAll(same).count() == 0
    assert privacy.sanitise(no_documents).count() == 0 and privacy.annotate(no_documents).count() == 0
