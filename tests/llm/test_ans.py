import functools
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tillstar.llm import ans, tokens


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(0, 400), min_size=1, max_size=3000), st.integers(0, 2**32 - 1))
def test_coder_round_trip(ids, seed):
    ids = np.array(ids, np.uint16)
    extra = np.random.default_rng(seed).integers(0, 2, 401)
    coder = ans.Coder(ans.frequencies(np.bincount(ids, minlength=401) + extra))
    coded = coder.encode(ids)
    assert (coder.decode(*coded, len(ids)) == ids).all()


def test_checkpoints_decode_on_their_own_and_size_is_near_entropy():
    ids = np.minimum(np.random.default_rng(1).zipf(1.3, 700_000), 50_000).astype(np.uint16)
    counts = np.bincount(ids, minlength=50_257)
    coder = ans.Coder(ans.frequencies(counts))
    coded = coder.encode(ids)
    n = len(coded[2]) // 8
    assert n == 3
    assert (np.concatenate([coder.decode(*coded, len(ids), first=k, last=k + 1) for k in range(n)]) == ids).all()
    p = counts[counts > 0] / len(ids)
    assert len(coded[0]) * 8 / len(ids) < 1.01 * -(p * np.log2(p)).sum()


@pytest.mark.parametrize("counts", [[0, 0], [5], [1, 10**12], [1] * 1000 + [10**9], [3, 0, 3]])
def test_frequencies_fill_the_scale(counts):
    counts = np.array(counts)
    scaled = ans.frequencies(counts)
    assert scaled.sum() in (0, 1 << ans.BITS) and ((scaled > 0) == (counts > 0)).all()


def ids_of(text):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokens.default_path())
    tokenizer.encode_special_tokens = True
    return tokenizer.encode(text or "", add_special_tokens=False).ids + [0]


def test_files_round_trip(spark, documents, no_documents, tmp_path):
    ans.write(documents, str(tmp_path / "files"))
    rows = ans.read(spark, str(tmp_path / "files")).orderBy("start").collect()
    given_ = documents.select("doc_id", "text").collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, bytes(r.ids)) for r in rows) == sorted(
        (g.doc_id is None, g.doc_id or 0, np.array(ids_of(g.text), "<u4").tobytes()) for g in given_)
    ids = [r.doc_id for r in rows]
    assert ids == sorted(ids, key=lambda i: (i is not None, i or 0))
    assert [r.start for r in rows] == [sum(x.n_tokens for x in rows[:k]) for k in range(len(rows))]
    ans.write(no_documents, str(tmp_path / "none"))
    assert ans.read(spark, str(tmp_path / "none")).count() == 0


def test_damage_is_found(spark, documents, tmp_path):
    ans.write(documents.where("doc_id = 4"), str(tmp_path / "a"))
    blocks = spark.read.parquet(str(tmp_path / "a" / "blocks"))
    broken = blocks.withColumn("crc32", F.col("crc32") + 1).collect()
    spark.createDataFrame(broken, blocks.schema).write.parquet(str(tmp_path / "b" / "blocks"))
    for part in ("table", "shards"):
        spark.read.parquet(str(tmp_path / "a" / part)).write.parquet(str(tmp_path / "b" / part))
    with pytest.raises(Exception, match="damaged"):
        ans.read(spark, str(tmp_path / "b")).collect()


def test_words_give_the_ids_of_the_text():
    encoder = tokens.Encoder(open(tokens.default_path(), encoding="utf-8").read())
    texts = ["", "a", "  a  b", " x\n y", "tab\tb c", "nb sp a", "é ü  <|endoftext|> b", "don't we'll 's 12 3a\n\nb", "trail ", "trail\n", "a \nb", "x　y z", "\x1cfoo bar!\x1c baz", "日本 語 テ", "a\x85 b", "\n"]
    assert [np.frombuffer(x, encoder.kind).tolist() for x in encoder.encode(texts)] == [ids_of(t) for t in texts]
    assert zlib.crc32(tokens.wide(encoder.encode(["a"])[0], encoder.kind)) == zlib.crc32(np.array(ids_of("a"), "<u4").tobytes())


PIECES = ["a", "é", "Z", "1", "²", " ", "  ", "\n", "\t", ".", "'s", "'", "日", "😀", "\xa0", "<|endoftext|>", "ß", "ª", "!?", "\r", "ɐ", "word", "Wörter"]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.none(), st.lists(st.sampled_from(PIECES), max_size=25).map("".join)), max_size=30), st.integers(1, 60))
def test_any_texts_in_any_runs(texts, run):
    encoder = _encoder()
    encoder.RUN, encoder.STEMS = run, 3  # many small runs; stems are forgotten all the time
    want = [] if not texts else [e.ids + [tokens.END] for e in encoder.tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)]
    assert [np.frombuffer(x, encoder.kind).tolist() for x in encoder.encode(texts)] == want


@functools.cache
def _encoder():
    return tokens.Encoder(open(tokens.default_path(), encoding="utf-8").read())


def test_very_long_text_is_a_run_of_its_own():
    encoder = _encoder()
    encoder.RUN, encoder.STEMS = 1 << 20, 300_000
    texts = ["short one", "many words, " * 100_000, "x" * 10_000, None, "last one"]
    assert [np.frombuffer(x, encoder.kind).tolist() for x in encoder.encode(texts)] == [ids_of(t) for t in texts]
