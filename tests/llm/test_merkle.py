from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from tillstar.llm import merkle
from tillstar.llm.op13 import op13_merkle_manifest


def h(text):
    return sha256(text.encode()).hexdigest()


def leaf(doc_id, text, lang, source, n_chars, *_):
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text)))


def levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([h("".join(out[-1][k : k + 3])) for k in range(0, len(out[-1]), 3)])
    return out


def brute(rows, changed):
    """Every version is a tree made anew as a whole."""
    groups = {}
    for r in rows:
        groups.setdefault(r[3], []).append(r)
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in names:
        groups[s].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(*r)))
        trees[s] = levels([leaf(*r) for r in groups[s]])
    top = levels([trees[s][-1][0] for s in names])
    out = []
    for g, s in enumerate(names):
        for i, r in enumerate(groups[s]):
            proof, k = "", i
            for tree, at in ((trees[s], i), (top, g)):
                for level in tree[:-1]:
                    run = level[at - at % 3 : at - at % 3 + 3]
                    proof += "".join(x for j, x in enumerate(run) if j != at % 3)
                    at //= 3
            new = leaf(r[0], changed(r), *r[2:])
            mine = levels([*trees[s][0][:k], new, *trees[s][0][k + 1 :]])
            all_ = levels([*top[0][:g], mine[-1][0], *top[0][g + 1 :]])
            copied = [level[k // 3**n] for n, level in enumerate(mine) if n] + [level[g // 3**n] for n, level in enumerate(all_) if n]
            out.append((r[0], leaf(*r), trees[s][-1][0], top[-1][0], h(proof), all_[-1][0], all_[-1][0] == top[-1][0], copied if changed(r) != r[1] else None))
    return sorted(out, key=str)


def got(df):
    return sorted([(r.doc_id, r.leaf, r.subroot, r.root, r.proof_sha256, r.folded_root, r.verified, r.copied) for r in df.collect()], key=str)


def check(spark, rows, schema, levels=merkle.LEVELS):
    out = got(merkle.manifest(spark.createDataFrame(rows, schema).repartition(3), F.when(F.col("doc_id") % 2 == 0, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text")), levels))
    assert out == brute(rows, lambda r: r[1].replace("\n", "") if r[0] is not None and r[0] % 2 == 0 and r[1] is not None else r[1])
    return out


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.mark.parametrize("few", [1, 2, 7])
def test_brute_force(spark, few):
    rows = [(k, f"line {k}\nmore\n" if k % 3 else f"no break {k}", "en", f"s{k % 2 * (k % 5)}" if k % 17 else None, k) for k in range(190)]
    rows += [(5, "again\n", "en", "s0", 1), (5, "again\n", "en", "s0", 1), (None, "x\ny", None, "s0", None), (1000, "lone\n", "en", "lone", 5), (1001, "é\n", "en", "\U0001f600", 2), (1002, "é\n", "en", "￿", 2)]
    rows += [(2000 + k, None if k % 2 else "a\nb", "en", f"many{k}", 3) for k in range(30)]
    out = check(spark, rows, SCHEMA, few)
    assert any(r[6] for r in out) and any(not r[6] for r in out)


def test_hostile_rows(spark, documents, no_documents):
    check(spark, [tuple(r) for r in documents.collect()], documents.schema)
    assert merkle.manifest(no_documents).count() == 0


def test_nothing_changed_verifies(spark, documents):
    assert all(r.verified and r.copied is None for r in merkle.manifest(documents).collect())


def test_one_row_of_one_source(spark):
    (row,) = merkle.manifest(spark.createDataFrame([(4, "a\n", "en", None, 1)], SCHEMA), F.lit("b")).collect()
    assert row.root == row.subroot == row.leaf and row.proof_sha256 == h("") and not row.verified and row.copied == []


def test_the_query_runs_over_the_given_rows(spark):
    rows = op13_merkle_manifest(spark, "/root/testdata/sf0.001").collect()
    given = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars").collect()]
    import zlib

    want = brute(given, lambda r: r[1].replace("\n", "") if zlib.crc32(str(r[0]).encode()) % 2 == 0 else r[1])
    assert sorted([tuple(r) for r in rows], key=str) == sorted([w[:7] for w in want], key=str)
