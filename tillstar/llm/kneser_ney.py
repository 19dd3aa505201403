"""Quality by perplexity under an interpolated modified Kneser-Ney model of trusted text.

The units are UTF-8 bytes, the order is ``ORDER``, and every language has counts of its own. Trusted documents are those
labelled good and not toxic; four fifths of them, by hash, train the model, the rest, which it has not seen, give each
language's threshold: the median of their log perplexity and ``FENCE`` times its spread, from the median to the upper quartile. Both
are interpolated and neither hangs on the extremes, so a few odd trusted texts do not move it, however many are held out. A spread known
from n documents is averaged with that of all languages, which weighs ``PRIOR`` documents. Documents at or below the threshold are kept.

All n-grams of all training texts are counted. The logarithm of an interpolated probability is a sum of terms that
each hang on one n-gram or one context (what a seen n-gram adds to backing off), so the table of terms can be cut into shards
by key and a document's score is the sum over shards. A shard has at most ``SHARD`` terms and is what a pass over the documents
holds; more terms mean more passes, not more memory.

Defined results: null or empty text has no perplexity and is kept; a null language is a language of its own; a language without
trusted text has no threshold and its documents are kept; null labels do not make a document trusted, and of repeated labels all must
agree; rows that repeat a ``doc_id`` are scored each and share its label; an empty table gives no rows; other columns are ignored, whatever
their names.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tillstar.llm.idfilter import IdFilter
from tillstar.session import materialize

ORDER = 5
FENCE = 10.0
PRIOR = 10
SHARD = 4_000_000
STEP = 1 << 22  # bytes of text whose n-grams are looked up together
_U = np.uint64
_GRAM = 8 * ORDER
_NO_LANGUAGE = "\0"


def language_code(name: str | None) -> int:
    return xxhash.xxh32_intdigest((_NO_LANGUAGE if name is None else name).encode()) & 0xFFFFF


def windows(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The ORDER bytes that end at each byte of the texts, packed, and where each text starts. Zero bytes stand before a text."""
    raw = [t.encode("utf-8", "surrogatepass") for t in texts]
    pad = b"\0" * (ORDER - 1)
    data = np.frombuffer(pad + pad.join(raw), np.uint8).astype(np.uint64)
    packed = data.copy()
    for k in range(1, ORDER):
        packed[k:] |= data[:-k] << _U(8 * k)
    sizes = np.fromiter(map(len, raw), np.int64, len(raw))
    firsts = np.cumsum(sizes + ORDER - 1) - sizes
    own = np.ones(len(data), bool)
    own[(firsts[:, None] - np.arange(1, ORDER)[None, :]).ravel()] = False
    return packed[own], np.cumsum(sizes) - sizes


def _chunks(texts: list[str | None], languages: list[str | None]):
    """(language, indices of texts) in runs of at most STEP characters, or one text."""
    by: dict[str | None, list[int]] = {}
    for i, (t, name) in enumerate(zip(texts, languages)):
        if t:
            by.setdefault(name, []).append(i)
    for name, places in by.items():
        run, size = [], 0
        for i in places:
            if run and size + len(texts[i]) > STEP:
                yield name, run
                run, size = [], 0
            run.append(i)
            size += len(texts[i])
        yield name, run


def trusted_ids(labels: DataFrame) -> DataFrame:
    """doc_id, held: the trusted documents, a fifth of them held out of the training."""
    good = labels.where("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.min(F.coalesce(F.col("quality"), F.lit(0))).alias("q"), F.max(F.coalesce(F.col("toxic"), F.lit(1))).alias("t"))
    return materialize(good.where("q > 0 and t = 0").select("doc_id", (F.pmod(F.xxhash64("doc_id", F.lit("held")), F.lit(5)) == 0).alias("held")))


def counts(documents: DataFrame, ids: DataFrame) -> DataFrame:
    """Stored: language, gram, n of all ORDER-grams of the documents in ``ids``."""
    chosen = IdFilter(documents.sparkSession, ids, "doc_id")

    def likely(batches):
        for batch in batches:
            yield batch.filter(pa.array(chosen.passes(batch.column("place").to_numpy(zero_copy_only=False)))).select(["doc_id", "lang", "text"])

    def run(batches):
        for batch in batches:
            texts, languages = batch.column("text").to_pylist(), batch.column("lang").to_pylist()
            for name, places in _chunks(texts, languages):
                grams, n = np.unique(windows([texts[i] for i in places])[0], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(grams), language_code(name), np.int32)), pa.array(grams.astype(np.int64)), pa.array(n.astype(np.int64))], ["language", "gram", "n"])

    narrow = documents.where("doc_id is not null and text is not null").select(F.col("doc_id").cast("long"), F.col("lang").cast("string"), "text", chosen.place().alias("place"))
    texts = narrow.mapInArrow(likely, "doc_id long, lang string, text string").join(ids.select("doc_id"), "doc_id", "left_semi")
    return materialize(texts.mapInArrow(run, "language int, gram long, n long").groupBy("language", "gram").agg(F.sum("n").alias("n")))


def _discounts(table: DataFrame) -> DataFrame:
    """language and the three discounts, from how many n-grams occur once to four times."""
    few = table.groupBy("language").agg(*(F.count(F.when(F.col("n") == k, 1)).cast("double").alias(f"n{k}") for k in (1, 2, 3, 4)))
    y = F.col("n1") / (F.col("n1") + 2 * F.col("n2"))
    # Without the counts that the formula divides by, the plain discount of its kind.
    each = [F.when((F.col(f"n{k}") > 0) & (F.col("n1") > 0), k - (k + 1) * y * F.col(f"n{k + 1}") / F.col(f"n{k}")).otherwise(0.5 * k) for k in (1, 2, 3)]
    return few.select("language", *(F.greatest(F.lit(0.05), F.least(F.lit(k - 0.05), d)).alias(f"d{k}") for k, d in zip((1, 2, 3), each)))


def terms(counted: DataFrame) -> DataFrame:
    """Stored: key, value. Key: language (20 bits), kind (4 bits), n-gram (40 bits); kind k is an n-gram of order k, kind 8 + k a context of order k."""
    tables = {ORDER: counted}
    for k in range(ORDER - 1, 0, -1):  # continuation counts: how many different bytes stand before
        tables[k] = tables[k + 1].groupBy("language", F.col("gram").bitwiseAND(F.lit((1 << 8 * k) - 1)).alias("gram")).agg(F.count(F.lit(1)).alias("n"))
        tables[k] = materialize(tables[k])
    parts, lower = [], None
    for k in range(1, ORDER + 1):
        discounts = materialize(_discounts(tables[k])).withColumnRenamed("language", "l")
        d = F.when(F.col("n") == 1, F.col("d1")).when(F.col("n") == 2, F.col("d2")).otherwise(F.col("d3"))
        rows = tables[k].join(discounts, F.col("language") == F.col("l")).withColumn("d", d).withColumn("context", F.shiftright("gram", 8))
        contexts = rows.groupBy("language", "context").agg(F.sum("n").alias("total"), (F.sum("d") / F.sum("n")).alias("back"))
        contexts = materialize(contexts).select(F.col("language").alias("cl"), F.col("context").alias("cc"), "total", "back")
        own = rows.join(contexts, (F.col("language") == F.col("cl")) & (F.col("context") == F.col("cc"))).withColumn("own", (F.col("n") - F.col("d")) / F.col("total"))
        if lower is None:
            own = own.withColumn("low", F.lit(1 / 256))
        else:
            suffix = lower.select(F.col("language").alias("sl"), F.col("gram").alias("sg"), F.col("p").alias("low"))
            own = own.join(suffix, (F.col("language") == F.col("sl")) & (F.col("gram").bitwiseAND(F.lit((1 << 8 * (k - 1)) - 1)) == F.col("sg")))
        lower = materialize(own.select("language", "gram", (F.col("own") + F.col("back") * F.col("low")).alias("p"), (F.col("back") * F.col("low")).alias("without")))
        parts.append(lower.select(_key(F.col("language"), k, F.col("gram")).alias("key"), F.log(F.col("p") / F.col("without")).alias("value")))
        parts.append(contexts.select(_key(F.col("cl"), 8 + k, F.col("cc")).alias("key"), F.log("back").alias("value")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return materialize(out)


def _key(language: Column, kind: int, gram: Column) -> Column:
    return F.shiftleft(language.cast("long"), 44).bitwiseOR(F.lit(kind << 40).cast("long")).bitwiseOR(gram)


def log_probabilities(grams: np.ndarray, language: int, keys: np.ndarray, values: np.ndarray) -> np.ndarray:
    """The shard's part of the log probability of the last byte of each gram."""
    out = np.zeros(len(grams))
    if not len(keys):
        return out
    for k in range(1, ORDER + 1):
        for kind, gram in ((k, grams & _U((1 << 8 * k) - 1)), (8 + k, (grams >> _U(8)) & _U((1 << 8 * (k - 1)) - 1))):
            wanted = (gram | _U(language << 44 | kind << 40)).astype(np.int64)
            at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
            out += np.where(keys[at] == wanted, values[at], 0.0)
    return out


def scores(documents: DataFrame, model: DataFrame) -> DataFrame:
    """Stored: doc_id, lang, row (a hash of the text), n_bytes, log_p; the terms of one shard at a time go to the tasks."""
    spark = documents.sparkSession
    shards = max(1, -(-model.count() // SHARD))
    rows = documents.select(F.col("doc_id").cast("long"), F.col("lang").cast("string"), "text", F.xxhash64("text").alias("row"))
    parts = []
    for s in range(shards):
        part = model.where(F.pmod(F.xxhash64("key"), F.lit(shards)) == s).toArrow()  # 16 bytes a term
        order = np.argsort(part["key"].to_numpy())
        shard = spark.sparkContext.broadcast((part["key"].to_numpy()[order], part["value"].to_numpy()[order]))

        def run(batches, shard=shard, base=-np.log(256) if s == 0 else 0.0):
            keys, values = shard.value
            for batch in batches:
                texts, languages = batch.column("text").to_pylist(), batch.column("lang").to_pylist()
                total, size = np.zeros(len(texts)), np.zeros(len(texts), np.int64)
                for name, places in _chunks(texts, languages):
                    grams, starts = windows([texts[i] for i in places])
                    codes, used = pd.factorize(grams)
                    each = base + log_probabilities(used, language_code(name), keys, values)
                    total[places] = np.add.reduceat(each[codes], starts)
                    size[places] = np.diff(np.append(starts, len(grams)))
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("lang"), batch.column("row"), pa.array(size), pa.array(total)], ["doc_id", "lang", "row", "n_bytes", "log_p"])

        parts.append(materialize(rows.mapInArrow(run, "doc_id long, lang string, row long, n_bytes long, log_p double")))
        shard.unpersist()
    if shards == 1:
        return parts[0]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    # Equal rows have equal parts, hence a count that says how many of each there are.
    summed = out.groupBy("doc_id", "lang", "row", "n_bytes").agg(F.sum("log_p").alias("log_p"), (F.count(F.lit(1)) / shards).cast("int").alias("copies"))
    return materialize(summed.select("doc_id", "lang", "row", "n_bytes", (F.col("log_p") / F.col("copies")).alias("log_p"), F.explode(F.array_repeat(F.lit(0), F.col("copies"))).alias("_")).drop("_"))


def thresholds(scored: DataFrame, held: DataFrame, fence: float = FENCE) -> DataFrame:
    """of (a language), threshold: ``fence`` spreads above the median, over steps of a thousandth of the held-out documents' log perplexity."""
    fine = F.ceil(-F.col("log_p") / F.col("n_bytes") * 1000)
    steps = (
        scored.where("n_bytes > 0").join(held.select(F.col("doc_id").alias("d")), F.col("doc_id") == F.col("d"), "left_semi")
        .groupBy("lang", fine.alias("step")).agg(F.count(F.lit(1)).alias("n"))
    )
    own = materialize(
        steps.groupBy("lang").agg(F.sum("n").alias("n"), F.percentile("step", F.array(F.lit(0.5), F.lit(0.75)), F.col("n")).alias("q"))
        .select(F.col("lang").alias("of"), "n", F.col("q")[0].alias("middle"), (F.col("q")[1] - F.col("q")[0]).alias("spread")))
    every = own.agg((F.sum(F.col("n") * F.col("spread")) / F.sum("n")).alias("usual"))
    spread = F.greatest(F.lit(1.0), (F.col("n") * F.col("spread") + PRIOR * F.col("usual")) / (F.col("n") + PRIOR))
    return own.crossJoin(F.broadcast(every)).select("of", F.exp((F.col("middle") + fence * spread) / 1000).alias("threshold"))


def classify(documents: DataFrame, labels: DataFrame, fence: float = FENCE) -> DataFrame:
    """doc_id, lang, n_bytes, perplexity (per byte), threshold, kept per document."""
    ids = trusted_ids(labels)
    scored = scores(documents, terms(counts(documents, ids.where("not held"))))
    limits = materialize(thresholds(scored, ids.where("held"), fence))
    perplexity = F.when(F.col("n_bytes") > 0, F.exp(-F.col("log_p") / F.col("n_bytes")))
    return scored.join(limits, F.col("lang").eqNullSafe(F.col("of")), "left").select(
        "doc_id", "lang", "n_bytes", perplexity.alias("perplexity"), "threshold", F.coalesce(perplexity <= F.col("threshold"), F.lit(True)).alias("kept"))
