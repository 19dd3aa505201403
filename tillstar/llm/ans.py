"""Token ids as files coded with a static range asymmetric numeral system.

A folder holds ``table`` (one row: the frequency of every id on a scale of 2**BITS), ``blocks`` and ``shards``. A block codes the
ids of consecutive documents on its own, token i in lane i modulo the number of lanes, so that numpy steps
all lanes at once. Every ``EVERY`` steps a checkpoint keeps the lanes' states and the place in the stream: decoding can start
at any of them. A CRC-32 of the ids guards the block. Documents are in ascending order of doc_id through the
shards; ``shards`` has the number of ids in each, from which a document's place among all ids follows.

Blocks are rows of a Spark table of files: their writing survives lost executors, and tasks read them in parallel from
any store that Spark reads.

Defined results: null or empty text has the end id only; a null ``doc_id`` sorts first; rows that repeat a ``doc_id`` are documents of
their own, in the order of their texts' hashes; an empty table gives files without blocks and no rows; other columns are ignored,
whatever their names.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tillstar.llm import tokens
from tillstar.session import materialize

BITS = 20
LANES = 1024
EVERY = 256
BLOCK = 1 << 20
_LOW = np.uint64(1 << 31)
_U = np.uint64


def frequencies(counts: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Counts scaled to a sum of 2**bits, at least 1 where there is a count."""
    total = int(counts.sum())
    if not total:
        return np.zeros(len(counts), np.int64)
    scale = 1 << bits
    if int((counts > 0).sum()) > scale:
        raise ValueError("more different ids than the scale has room for")
    scaled = np.where(counts > 0, np.maximum(1, counts * (scale / total)).astype(np.int64), 0)
    order = np.argsort(-scaled, kind="stable")
    over = int(scaled.sum()) - scale
    if over < 0:
        scaled[order[0]] -= over
    while over > 0:  # take from the largest, a share of each in turn
        for k in order:
            cut = min(over, max(0, int(scaled[k]) - 1), max(1, int(scaled[k]) >> 4))
            scaled[k] -= cut
            over -= cut
            if not over:
                break
    return scaled


class Coder:
    def __init__(self, scaled: np.ndarray, bits: int = BITS):
        self.bits, self.f = bits, scaled.astype(np.uint64)
        self.cum = np.concatenate([[0], np.cumsum(scaled)[:-1]]).astype(np.uint64)
        self.slots = np.repeat(np.arange(len(scaled), dtype=np.uint32), scaled)

    def encode(self, ids: np.ndarray) -> tuple[bytes, bytes, bytes, int]:
        """Stream, checkpoint states, checkpoint places and the number of lanes."""
        lanes = max(1, min(LANES, len(ids) // 64))
        steps = -(-len(ids) // lanes)
        f, cum = self.f[ids], self.cum[ids]
        x = np.full(lanes, _LOW)
        words: list[np.ndarray] = []
        states: list[bytes] = []
        emitted: list[int] = []
        for t in range(steps - 1, -1, -1):
            a = t * lanes
            n = min(lanes, len(ids) - a)
            y, g, c = x[:n], f[a : a + n], cum[a : a + n]
            full = y >= g << _U(63 - self.bits)
            words.append((y[full] & _U(0xFFFFFFFF)).astype(np.uint32))
            y = np.where(full, y >> _U(32), y)
            high = y // g
            x[:n] = (high << _U(self.bits)) + (y - high * g) + c
            if t % EVERY == 0:
                states.append(x.astype("<u8").tobytes())
                emitted.append(sum(map(len, words)) if not emitted else emitted[-1] + sum(map(len, words[-EVERY:])))
        stream = np.concatenate(words[::-1]) if words else np.zeros(0, np.uint32)
        places = len(stream) - np.array(emitted[::-1], np.int64)
        return stream.astype("<u4").tobytes(), b"".join(states[::-1]), places.astype("<i8").tobytes(), lanes

    def decode(self, stream: bytes, states: bytes, places: bytes, lanes: int, total: int, first: int = 0, last: int | None = None) -> np.ndarray:
        """Ids from checkpoint ``first`` up to ``last`` (exclusive; None: to the end)."""
        words, at = np.frombuffer(stream, "<u4"), np.frombuffer(places, "<i8")
        saved = np.frombuffer(states, "<u8").reshape(-1, lanes)
        start, stop = first * EVERY * lanes, total if last is None or last >= len(at) else last * EVERY * lanes
        out = np.empty(stop - start, np.uint32)
        if not len(out):
            return out
        x, place, mask = saved[first].astype(np.uint64), int(at[first]), _U((1 << self.bits) - 1)
        for a in range(start, stop, lanes):
            n = min(lanes, total - a)
            y = x[:n]
            slot = y & mask
            s = self.slots[slot]
            out[a - start : a - start + n] = s
            y = self.f[s] * (y >> _U(self.bits)) + slot - self.cum[s]
            need = np.flatnonzero(y < _LOW)
            y[need] = (y[need] << _U(32)) | words[place : place + len(need)]
            place += len(need)
            x[:n] = y
        return out


BLOCK_SCHEMA = ("shard long, start long, n_tokens long, lanes int, crc32 long, doc_ids array<long>, lengths array<long>, "
                "stream binary, states binary, places binary")
_BLOCK_TYPES = {"shard": pa.int64(), "start": pa.int64(), "n_tokens": pa.int64(), "lanes": pa.int32(), "crc32": pa.int64(),
                "doc_ids": pa.list_(pa.int64()), "lengths": pa.list_(pa.int64()), "stream": pa.binary(), "states": pa.binary(), "places": pa.binary()}


def tokenised(documents: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """Stored: shard, start (in the shard), doc_id, ids in ascending order of doc_id.

    The range sort comes first, so its sampling reads ids only and each text is encoded once.
    """
    content = tokens.shared_tokenizer(documents.sparkSession, tokenizer)

    def run(batches):
        encoder = tokens.worker_encoder(content.value)
        shard, at = TaskContext.get().partitionId(), 0
        for batch in batches:
            ids = encoder.encode_column(batch.column("text"))
            sizes = pc.binary_length(ids).to_numpy() // encoder.kind.itemsize
            starts = at + np.cumsum(sizes) - sizes
            at += int(sizes.sum())
            yield pa.RecordBatch.from_arrays([pa.array([shard] * len(ids), pa.int64()), pa.array(starts), batch.column("doc_id"), pa.array(sizes), ids.cast(pa.binary())],
                                             ["shard", "start", "doc_id", "n_tokens", "ids"])

    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text")]
    rows = documents.select(F.col("doc_id").cast("long"), "text").repartitionByRange(*order).sortWithinPartitions(*order)
    return materialize(rows.mapInArrow(run, "shard long, start long, doc_id long, n_tokens long, ids binary"))


def _counted(ids: DataFrame, kind: np.dtype, size: int) -> np.ndarray:
    """Count per id; at most as many rows as the vocabulary has come to the driver."""

    def run(batches):
        total = np.zeros(size, np.int64)
        for batch in batches:
            total += np.bincount(np.frombuffer(b"".join(batch.column("ids").to_pylist()), kind), minlength=size)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(total[used], pa.int64())], ["id", "n"])

    rows = ids.select("ids").mapInArrow(run, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(size, np.int64)
    for r in rows:
        out[r["id"]] = r["n"]
    return out


def write(documents: DataFrame, folder: str, tokenizer: str | None = None) -> None:
    """Encode all texts into ``folder``."""
    spark = documents.sparkSession
    encoder = tokens.Encoder(tokens.shared_tokenizer(spark, tokenizer).value)
    kind, size = encoder.kind, encoder.tokenizer.get_vocab_size()
    ids = tokenised(documents, tokenizer)
    scaled = frequencies(_counted(ids, kind, size))
    table = spark.sparkContext.broadcast(scaled)
    spark.createDataFrame([(BITS, bytearray(scaled.astype("<i8").tobytes()))], "bits int, frequencies binary").coalesce(1).write.parquet(f"{folder}/table")
    ids.groupBy("shard").agg(F.sum("n_tokens").alias("n_tokens")).write.parquet(f"{folder}/shards")

    def block(coder, shard, start, docs, lengths, parts):
        flat = np.frombuffer(b"".join(parts), kind)
        stream, states, places, lanes = coder.encode(flat)
        values = (shard, start, len(flat), lanes, zlib.crc32(flat.astype("<u4").tobytes()), docs, lengths, stream, states, places)
        return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, _BLOCK_TYPES.values())], list(_BLOCK_TYPES))

    def run(batches):
        coder = Coder(table.value)
        shard = start = following = None
        docs, lengths, parts = [], [], []
        for batch in batches:
            for s, a, doc, n, x in zip(*(batch.column(c).to_pylist() for c in ("shard", "start", "doc_id", "n_tokens", "ids"))):
                if docs and (s != shard or a != following or following - start >= BLOCK):
                    yield block(coder, shard, start, docs, lengths, parts)
                    docs, lengths, parts = [], [], []
                if not docs:
                    shard, start = s, a
                docs.append(doc)
                lengths.append(n)
                parts.append(x)
                following = a + n
        if docs:
            yield block(coder, shard, start, docs, lengths, parts)

    ids.mapInArrow(run, BLOCK_SCHEMA).write.parquet(f"{folder}/blocks")


def _documents(batches: Iterator[pa.RecordBatch], scaled: np.ndarray, bits: int) -> Iterator[pa.RecordBatch]:
    coder = None
    for batch in batches:
        for r in batch.to_pylist():
            coder = coder or Coder(scaled, bits)
            ids = coder.decode(r["stream"], r["states"], r["places"], r["lanes"], r["n_tokens"])
            raw = ids.astype("<u4").tobytes()
            if zlib.crc32(raw) != r["crc32"]:
                raise ValueError(f"block at {r['start']} of shard {r['shard']} is damaged")
            lengths = np.array(r["lengths"], np.int64)
            ends = np.cumsum(lengths)
            for a in range(0, len(lengths), 1000):
                cut = slice(a, a + 1000)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(r["doc_ids"][cut], pa.int64()), pa.array([r["shard"]] * len(lengths[cut]), pa.int64()), pa.array(r["start"] + ends[cut] - lengths[cut]),
                     pa.array(lengths[cut]), pa.array([raw[4 * (e - n) : 4 * e] for n, e in zip(lengths[cut], ends[cut])], pa.binary())], ["doc_id", "shard", "start", "n_tokens", "ids"])


def read(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens, ids (little-endian unsigned 32-bit) from the files."""
    head = spark.read.parquet(f"{folder}/table").first()
    scaled, bits = np.frombuffer(bytes(head["frequencies"]), "<i8"), head["bits"]
    table = spark.sparkContext.broadcast(scaled)
    rows = spark.read.parquet(f"{folder}/blocks").mapInArrow(lambda batches: _documents(batches, table.value, bits), "doc_id long, shard long, start long, n_tokens long, ids binary")
    # A row per shard: a task of the range sort each, so the window stays small.
    before = F.coalesce(F.sum("n_tokens").over(W.orderBy("shard").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    shards = materialize(spark.read.parquet(f"{folder}/shards").select("shard", before.alias("before")))
    return rows.join(shards, "shard").select("doc_id", (F.col("start") + F.col("before")).alias("start"), "n_tokens", "ids")
