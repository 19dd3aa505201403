"""Spelling variants: words one edit apart, found by asymmetric q-chunks.

Words are maximal runs of letters (``RUN``), lower-cased A-Z, with ``LEAST_CHARS`` code points and ``LEAST_SEEN`` occurrences or more. Of two words that
differ by one inserted, deleted or replaced code point the shorter one (of equally long ones the smaller) gives its two
disjoint chunks, the halves: an edit touches only one of them. The other word gives its positional grams of the lengths of such
chunks. Chunk and gram meet by an equi-join if they are equal and their places differ by at most one, and every pair is verified.

A chunk that very many words have (``HOT`` pairs and more) would give a product. Its words are not joined there: an edit outside the chunk leaves it
at the same end, so what stands beside it must be one edit apart, and the same halving is done on that rest, until no chunk is hot or
the rest is one letter, when only its other letters are left to meet.

Defined results: null and empty texts have no words; a null ``doc_id`` stands as nothing before the colon in what is hashed; rows that repeat count again;
ties in n go to the word that is smaller in code points; an empty table gives no rows; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import re
import zlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillstar.session import materialize

RUN = "[a-zÀ-ÿ]"
LEAST_CHARS, LEAST_SEEN = 5, 3
#: A run is changed where this divides its hash.
CHANGED = 97
HOT = 2048
_STORE = 200_000


def words_of(doc_id: int | None, text: str, found) -> dict[str, int]:
    """Occurrences of the words of one text."""
    out: dict[str, int] = {}
    for run in found(text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")):
        out[run] = out.get(run, 0) + 1
    start = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
    changed = [(run, h) for run in out if not (h := zlib.crc32(run.encode(), start)) % CHANGED]
    moved = [(run[: (at := h % len(run))] + run[at + 1 :], out.pop(run)) for run, h in changed]
    for word, n in moved:
        if len(word) >= LEAST_CHARS:
            out[word] = out.get(word, 0) + n
    return out


def counted(documents: DataFrame) -> DataFrame:
    """Stored: word, n. Counts are summed in the task before they are shuffled."""

    def batch(total: dict[str, int]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64())], ["word", "n"])

    def run(batches):
        # A run of fewer letters gives no word, whether changed or not.
        found, total = re.compile(f"{RUN}{{{LEAST_CHARS},}}").findall, {}
        for given in batches:
            for doc_id, text in zip(given.column("doc_id").to_pylist(), given.column("text")):
                for word, n in words_of(doc_id, text.as_py() or "", found).items():
                    total[word] = total.get(word, 0) + n
                if len(total) > _STORE:
                    yield batch(total)
                    total = {}
        yield batch(total)

    parts = documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "word string, n long")
    return materialize(parts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST_SEEN))


def _each(rows: DataFrame, choices: list[Column]) -> DataFrame:
    """Rows times those of ``choices`` (structs) that are not null."""
    return rows.withColumn("_one", F.explode(F.array_compact(F.array(*choices)))).select(*rows.columns, "_one.*")


def _part(text: str, start: Column, length: Column) -> Column:
    return F.col(text).substr(start.cast("int") + 1, length.cast("int"))


def _chunks(rows: DataFrame) -> DataFrame:
    """Both halves of ``rest``, with what remains beside them. At one letter the first half is empty and meets all of its group."""
    long = F.length("rest")
    half = F.floor(long / 2)
    return _each(rows, [
        F.struct(F.xxhash64("grp", long, F.lit(1), _part("rest", F.lit(0), half)).alias("key"), _part("rest", half, long).alias("beside"), long.alias("size")),
        F.struct(F.xxhash64("grp", long, F.lit(2), _part("rest", half, long)).alias("key"), _part("rest", F.lit(0), half).alias("beside"), long.alias("size")),
    ])


def _grams(rows: DataFrame) -> DataFrame:
    """Grams of ``rest`` within one place of where a rest of the same length, or one shorter, has its chunks.

    ``beside`` is null where the gram does not stand at the end where its chunk stands: such a pair, if it is near, also meets by a gram that does.
    """
    long, choices = F.length("rest"), []
    for less in (0, 1):
        size = long - less
        half = F.floor(size / 2)
        for kind, place, width in ((1, F.lit(0), half), (2, half, size - half)):
            for shift in (-1, 0, 1):
                if kind == 1 and shift < 0:
                    continue
                at = place + shift
                end = at == 0 if kind == 1 else at + width == long
                beside = _part("rest", at + width, long) if kind == 1 else _part("rest", F.lit(0), at)
                whole = (at >= 0) & (at + width <= long) & (size >= 1)
                choices.append(F.when(whole, F.struct(F.xxhash64("grp", size, F.lit(kind), _part("rest", at, width)).alias("key"), F.when(end, beside).alias("beside"))))
    return _each(rows, choices)


def near_pairs(words: DataFrame) -> DataFrame:
    """Stored: a, n_a, b, n_b for each pair of ``words`` (word, n; distinct words) one edit apart, once."""
    shorter = longer = words.select(F.lit(0).cast("long").alias("grp"), "word", "n", F.col("word").alias("rest"))
    found = []
    while True:
        chunks, grams = materialize(_chunks(shorter)), materialize(_grams(longer))
        of_chunks = chunks.where("size > 1").groupBy("key").agg(F.count(F.lit(1)).alias("c"))
        of_grams = grams.groupBy("key").agg(F.count(F.lit(1)).alias("g"))
        hot = materialize(of_chunks.join(of_grams, "key").where(F.col("c").cast("double") * F.col("g") >= HOT).select("key"))
        a = chunks.join(hot, "key", "left_anti").select("key", F.col("word").alias("a"), F.col("n").alias("n_a"))
        b = grams.join(hot, "key", "left_anti").select("key", F.col("word").alias("b"), F.col("n").alias("n_b"))
        once = (F.length("a") < F.length("b")) | ((F.length("a") == F.length("b")) & (F.col("a") < F.col("b")))
        pairs = a.join(b, "key").where(once & (F.levenshtein("a", "b", 1) == 1)).select("a", "n_a", "b", "n_b")
        found.append(materialize(pairs.distinct()))
        if hot.isEmpty():
            break
        onward = [F.col("key").alias("grp"), "word", "n", F.col("beside").alias("rest")]
        shorter = chunks.join(hot, "key", "left_semi").select(*onward)
        longer = grams.where("beside is not null").join(hot, "key", "left_semi").select(*onward).distinct()
    pairs = found[0]
    for more in found[1:]:
        pairs = pairs.unionByName(more)
    return materialize(pairs.distinct()) if len(found) > 1 else pairs


def roots(forms: DataFrame) -> DataFrame:
    """Stored: word, root, following ``forms`` (word, form), which lead to ever larger n, to the end. Each round doubles the steps."""
    now = materialize(forms.select("word", F.col("form").alias("root")))
    while True:
        ahead = now.select(F.col("word").alias("_word"), F.col("root").alias("_root"))
        following = materialize(now.join(ahead, F.col("root") == F.col("_word"), "left").select("word", F.coalesce("_root", "root").alias("root"), F.col("_root").isNotNull().alias("moved")))
        now = following.select("word", "root")
        if following.where("moved").isEmpty():
            return now


def variants(documents: DataFrame) -> DataFrame:
    """word, form, root, n, n_near, form_n of every word."""
    words = counted(documents)
    pairs = near_pairs(words)
    both = pairs.select(F.col("a").alias("word"), F.col("b").alias("near"), F.col("n_b").alias("near_n")).unionByName(
        pairs.select(F.col("b").alias("word"), F.col("a").alias("near"), F.col("n_a").alias("near_n")))
    best = both.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct(-F.col("near_n"), "near")).alias("best"))
    known = words.join(best, "word", "left")
    known = known.withColumn("form_n", -F.col("best.col1")).withColumn("form", F.when(F.col("form_n") >= 2 * F.col("n"), F.col("best.near")))
    stored = materialize(known.select("word", "form", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(F.col("form").isNotNull(), F.col("form_n")).alias("form_n")))
    ends = roots(stored.where("form is not null").select("word", "form"))
    return stored.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
