"""Near-duplicate documents: universal hash minima, banding, signature and exact verification, components.

1. One pass over the whole texts gives each document its shingle count, a digest of its shingle set and
   ``bands * rows`` minima. Documents with equal sets are one node from here on, so a group
   of copies never meets itself.
2. Nodes that agree in a band share a bucket. In each bucket the most central node is the hub; pairs of hub and member
   are verified by signature, then on the full sets. This links groups of near copies in linear work.
3. Buckets whose members still lie in different components are compared completely, in blocks of
   bounded size: signatures first, full sets for what passes. A block emits links that join components, not pairs.
4. Components by alternating large-star and small-star.

A pair at similarity 0.75 shares no band with a probability of 2e-5 and fails the signature filter with 4e-5; more similar
pairs are missed far less. What is linked has been confirmed on full sets.

Defined results: a document without text or words has no shingle and is linked with nothing; fewer than five words are one
shingle; rows with a null ``doc_id`` take part in no link and are kept; rows that repeat a ``doc_id`` each count with their own text
and component; an empty table gives no rows; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillstar.llm import blocks, tokens
from tillstar.llm.components import components
from tillstar.llm.idfilter import IdFilter
from tillstar.llm.shingles import WordHashes, shingle_set, words_of
from tillstar.llm.tables import shielded
from tillstar.session import materialize

BANDS, ROWS = 40, 5
HASHES = BANDS * ROWS
SHARE = 75  # per cent of the union that the intersection must reach
#: Signature places that must agree: 4 standard deviations below what similarity 0.75 lets expect.
LEAST = int(HASHES * (0.75 - 4 * (0.75 * 0.25 / HASHES) ** 0.5))
_RNG = np.random.default_rng(20)
_A = _RNG.integers(0, 2**31, HASHES, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_B = _RNG.integers(0, 2**32, HASHES, dtype=np.uint32)
_CHUNK = 1 << 15


def minima(sets: list[np.ndarray]) -> np.ndarray:
    """(documents x HASHES) minima of the multiply-shift hashes of non-empty shingle sets."""
    out = np.empty((len(sets), HASHES), np.uint32)
    first = 0
    while first < len(sets):
        last, total = first, 0
        while last < len(sets) and (last == first or total + len(sets[last]) <= _CHUNK):
            total += len(sets[last])
            last += 1
        part = np.concatenate(sets[first:last])
        part = (part ^ (part >> np.uint64(32))).astype(np.uint32)
        starts = np.concatenate([[0], np.cumsum([len(s) for s in sets[first : last - 1]])]).astype(np.int64)
        for k in range(HASHES):
            out[first:last, k] = np.minimum.reduceat(part * _A[k] + _B[k], starts)
        first = last
    return out


def band_keys(values: np.ndarray) -> np.ndarray:
    """(documents x BANDS) 32-bit keys of the bands."""
    key = np.zeros((len(values), BANDS), np.uint64)
    parts = values.reshape(len(values), BANDS, ROWS).astype(np.uint64)
    for k in range(ROWS):
        key = (key ^ parts[:, :, k]) * np.uint64(0x9E3779B97F4A7C15)
        key ^= key >> np.uint64(29)
    return (key >> np.uint64(32)).astype(np.uint32)


SIGNED = "doc_id long, h long, n_shingles long, node long, keys array<int>, signature binary"


def sign(documents: DataFrame) -> DataFrame:
    """Shingle count, node (digest of the set) and signature of every document; null node: linked with nothing."""

    def run(batches):
        tokens.release()
        cache = WordHashes()
        for batch in blocks.slices(batches):
            ids = batch.column("doc_id").to_pylist()
            sets = [shingle_set(cache.of(words_of(t.as_py()))) for t in batch.column("text")]
            live = [i for i, s in enumerate(sets) if len(s) and ids[i] is not None]
            values = minima([sets[i] for i in live])
            keys = band_keys(values).view(np.int32)
            low = np.ascontiguousarray((values >> np.uint32(24)) ^ (values & np.uint32(0xFF))).astype(np.uint8)
            node: list = [None] * len(ids)
            key: list = [None] * len(ids)
            signature: list = [None] * len(ids)
            for at, i in enumerate(live):
                node[i] = xxhash.xxh3_64_intdigest(sets[i].tobytes()) - 2**63
                key[i], signature[i] = keys[at], low[at].tobytes()
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), batch.column("h"), pa.array([len(s) for s in sets], pa.int64()), pa.array(node, pa.int64()),
                 pa.array(key, pa.list_(pa.int32())), pa.array(signature, pa.binary())], ["doc_id", "h", "n_shingles", "node", "keys", "signature"])

    return documents.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("h"), "text").mapInArrow(run, SIGNED)


def _sets(documents: DataFrame, wanted: DataFrame) -> DataFrame:
    """(node, shingles) of the nodes in ``wanted`` (node, rep); scans the texts again, keeps those of ``rep`` only."""
    chosen = IdFilter(documents.sparkSession, wanted, "rep")

    def run(batches):
        cache = WordHashes()
        for batch in blocks.slices(batches):
            batch = batch.filter(pa.array(chosen.passes(batch.column("place").to_numpy(zero_copy_only=False))))
            sets = [shingle_set(cache.of(words_of(t.as_py()))).tobytes() for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([xxhash.xxh3_64_intdigest(s) - 2**63 for s in sets], pa.int64()), pa.array(sets, pa.binary())], ["doc_id", "node", "shingles"])

    found = (
        documents.where("doc_id is not null").select(F.col("doc_id").cast("long"), "text", chosen.place("doc_id").alias("place"))
        .mapInArrow(run, "doc_id long, node long, shingles binary")
    )
    keyed = wanted.select(F.col("node").alias("n"), F.col("rep").alias("r"))
    return materialize(found.join(keyed, (F.col("doc_id") == F.col("r")) & (F.col("node") == F.col("n"))).select("node", "shingles").dropDuplicates(["node"]))


def linked(a: np.ndarray, b: np.ndarray) -> bool:
    """Exact test on sorted shingle sets."""
    both = len(a) + len(b)
    if 175 * min(len(a), len(b)) < SHARE * both:  # even full containment is too little
        return False
    union = np.union1d(a, b).size
    return 100 * (both - union) >= SHARE * union


def _signatures_agree(batches):
    for batch in batches:
        a, b = blocks.matrix(batch.column("sa"), np.uint8), blocks.matrix(batch.column("sb"), np.uint8)
        if len(a):
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"]).filter(pa.array((a == b).sum(axis=1) >= LEAST))


def _sets_agree(batches):
    for batch in blocks.slices(batches):
        hit = [linked(np.frombuffer(a.as_py(), np.uint64), np.frombuffer(b.as_py(), np.uint64)) for a, b in zip(batch.column("sa"), batch.column("sb"))]
        yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"]).filter(pa.array(hit, pa.bool_()))


def _both(pairs: DataFrame, values: DataFrame, value: str) -> DataFrame:
    left = values.select(F.col("node").alias("a"), F.col(value).alias("sa"))
    right = values.select(F.col("node").alias("b"), F.col(value).alias("sb"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "sa", "sb")


def _open_pairs(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs of one block that may be linked and are not yet in one component: places and agreement.

    A pair that shares several buckets is taken in the first of their bands only.
    """
    keys, signature = blocks.lists(table["keys"]), blocks.matrix(table["signature"], np.uint8)
    label, n = table["label"].to_numpy(), table["n_shingles"].to_numpy()
    side = table["side"].to_numpy(zero_copy_only=False)
    band = int(table["key"][0].as_py()) >> 32
    crossing = table["block_a"][0].as_py() != table["block_b"][0].as_py()
    found = []
    for i in np.flatnonzero(~side) if crossing else range(len(label) - 1):
        js = np.flatnonzero(side) if crossing else np.arange(i + 1, len(label))
        js = js[(label[js] != label[i]) & (175 * np.minimum(n[js], n[i]) >= SHARE * (n[js] + n[i]))]
        if not len(js):
            continue
        agree = (signature[js] == signature[i]).sum(axis=1)
        js, agree = js[agree >= LEAST], agree[agree >= LEAST]
        if len(js):
            first = (keys[js] == keys[i]).argmax(axis=1) == band
            found.append((np.full(first.sum(), i), js[first], agree[first]))
    if not found:
        return (np.zeros(0, np.int64),) * 3
    return tuple(np.concatenate(x) for x in zip(*found))


_GROUP = ("key", "block_a", "block_b")


def _candidates(batches):
    for table in blocks.groups(batches, _GROUP):
        a, b, _ = _open_pairs(table)
        at = np.unique(np.concatenate([a, b]))
        if len(at):
            yield from table.select([*_GROUP, "node"]).take(pa.array(at)).combine_chunks().to_batches()


def _links(batches):
    for table in blocks.groups(batches, _GROUP):
        a, b, agree = _open_pairs(table)
        node, label = table["node"].to_pylist(), table["label"].to_pylist()
        sets = [np.frombuffer(s.as_py(), np.uint64) for s in table["shingles"]]
        joined, links = blocks.Unions(), []
        for k in np.argsort(-agree, kind="stable"):
            i, j = int(a[k]), int(b[k])
            if joined.find(label[i]) != joined.find(label[j]) and linked(sets[i], sets[j]):
                joined.join(label[i], label[j])
                links.append((node[i], node[j]))
        if links:
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in links], pa.int64()) for k in (0, 1)], ["a", "b"])


def _rest(documents: DataFrame, nodes: DataFrame, shared: DataFrame, groups: DataFrame) -> DataFrame:
    """Links between different components of a bucket, found by complete comparison in blocks."""
    label = groups.select(F.col("node").alias("of"), F.col("component").alias("label"))
    marked = materialize(shared.join(label, F.col("node") == F.col("of"), "left").select("key", "node", "n", F.coalesce("label", "node").alias("label")))
    mixed = marked.groupBy("key").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low < high").select(F.col("key").alias("k"))
    open_ = marked.join(mixed, F.col("key") == F.col("k")).drop("k")
    about = nodes.select(F.col("node").alias("of"), "n_shingles", "keys", "signature")
    rows = blocks.spread(open_.join(about, F.col("node") == F.col("of")).drop("of"), "key", "node", F.col("n"))
    schema = "key long, block_a int, block_b int, node long"
    left = materialize(rows.mapInArrow(_candidates, schema))
    wanted = left.select(F.col("node").alias("of")).distinct().join(nodes, F.col("of") == F.col("node")).select("node", "rep")
    sets = _sets(documents, wanted)
    again = (
        left.join(marked.select("key", "node", "label", "n"), ["key", "node"])
        .withColumn("side", F.pmod(F.xxhash64("node"), F.ceil(F.col("n") / blocks.SIZE).cast("int")).cast("int") == F.col("block_b"))
        .join(about, F.col("node") == F.col("of")).drop("of").join(sets, "node")
        .repartition(*_GROUP).sortWithinPartitions(*_GROUP, "node")
    )
    return again.mapInArrow(_links, "a long, b long")


def near_duplicates(documents: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id, kept per row of ``documents``."""
    return _verdicts(documents).drop("h")


def keep(documents: DataFrame) -> DataFrame:
    """One document of each component, all columns unchanged: the rows with its smallest doc_id, rows with the same text and id once.

    Rows that take part in no link, without a doc_id or without words, all stay.
    """
    verdicts = materialize(_verdicts(documents))
    key = ["doc_id", "h"]
    dropped = verdicts.where("not kept").select(*key).distinct()
    again = verdicts.where("kept and doc_id is not null and n_shingles > 0").groupBy(*key).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(*key)
    given, name = shielded(documents)
    keyed = given.withColumns({"doc_id": F.col(name["doc_id"]).cast("long"), "h": F.xxhash64(F.col(name["text"]))})

    def same(other: DataFrame) -> Column:
        return keyed["doc_id"].eqNullSafe(other["doc_id"]) & (keyed["h"] == other["h"])

    staying = keyed.join(dropped, same(dropped), "left_anti")
    if not again.isEmpty():
        again = materialize(again)
        staying = staying.join(again, same(again), "left_anti").unionByName(staying.join(again, same(again), "left_semi").dropDuplicates(key))
    return staying.select(*(F.col(new).alias(old) for old, new in zip(documents.columns, given.columns)))


def _verdicts(documents: DataFrame) -> DataFrame:
    """:func:`near_duplicates` and h, the hash of the row's text."""
    signed = materialize(sign(documents))
    nodes = materialize(
        signed.where("node is not null").groupBy("node")
        .agg(F.min("doc_id").alias("rep"), F.first("n_shingles").alias("n_shingles"), F.first("keys").alias("keys"), F.first("signature").alias("signature")))
    bands = nodes.select("node", F.posexplode("keys").alias("band", "value")).select(
        "node", (F.shiftleft(F.col("band").cast("long"), 32) + F.col("value").cast("long").bitwiseAND(F.lit(0xFFFFFFFF))).alias("key"))
    sizes = bands.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    shared = materialize(bands.join(sizes, "key"))
    central = shared.groupBy("node").agg(F.sum("n").alias("weight"))
    hubs = shared.join(central, "node").groupBy("key").agg(F.max(F.struct("weight", "node")).alias("top")).select("key", F.col("top.node").alias("hub"))
    stars = shared.join(hubs, "key").where("node <> hub").select(F.col("node").alias("a"), F.col("hub").alias("b")).distinct()
    likely = materialize(_both(stars, nodes, "signature").mapInArrow(_signatures_agree, "a long, b long"))
    ends = likely.select(F.col("a").alias("of")).unionByName(likely.select(F.col("b").alias("of"))).distinct()
    sets = _sets(documents, ends.join(nodes, F.col("of") == F.col("node")).select("node", "rep"))
    links = materialize(_both(likely, sets, "shingles").mapInArrow(_sets_agree, "a long, b long"))
    more = materialize(_rest(documents, nodes, shared, components(links)))
    groups = components(links.unionByName(more))
    labels = signed.select("doc_id", "h", "n_shingles", "node").join(groups.withColumnRenamed("node", "of"), F.col("node") == F.col("of"), "left").select(
        "doc_id", "h", "n_shingles", F.coalesce("component", "node").alias("label"))
    # Stored, so that the join below shuffles both sides itself and a label with very many documents can be split.
    smallest = materialize(labels.where("label is not null").groupBy("label").agg(F.min("doc_id").alias("least")).withColumnRenamed("label", "of"))
    return labels.join(smallest, F.col("label") == F.col("of"), "left").select(
        "doc_id", "h", "n_shingles", F.coalesce("least", "doc_id").alias("component_id"),
        F.coalesce(F.coalesce("least", "doc_id") == F.col("doc_id"), F.lit(True)).alias("kept"))
