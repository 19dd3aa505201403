"""Near-duplicate vectors by a pivot-permutation index.

A vector is described by its ``PREFIX`` nearest pivots in order of distance. The inverted lists hold a vector under
every pair of those pivots, so two vectors share at least ``2`` pivots exactly if they meet in a list; a pair is compared in the
list of the two smallest pivots it shares, hence once. What meets is verified by cosine in double precision. Equal vectors
are one entry with a count, so copies never meet each other. Long lists are compared in blocks of bounded size.

The pivots come from a bounded sample (the ``SAMPLE * PIVOTS`` distinct vectors with the smallest hashes), drawn again for every
table; all vectors are indexed. Each dimension has pivots and lists of its own; where the sample has too few vectors of a dimension, its
vectors are one list, compared in blocks as a whole. Recall against brute force is tested; every reported link has been verified.

Defined results: a vector that is null, of length zero, holds a null or non-finite component or no component is linked with nothing;
vectors of different dimensions are not linked; a null ``vec_id`` is linked with nothing and kept; rows that repeat a
``vec_id`` count each; an empty table gives no rows; other columns are ignored, whatever their names.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstar.llm import blocks
from tillstar.llm.components import components
from tillstar.session import materialize

LEAST = 0.9
PIVOTS = 256
SAMPLE = 8
APART = 0.7
PREFIX = 6
_PAIRS = np.array(list(combinations(range(PREFIX), 2)))


def unit(rows: np.ndarray) -> np.ndarray:
    """Rows of length 1; scaled first, so that very large and very small ones keep their direction."""
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def distinct(vectors: DataFrame) -> DataFrame:
    """Stored: node (smallest id), copies, vector of every distinct usable vector."""
    whole = F.col("embedding").cast("array<double>")
    fine = F.forall(whole, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(whole, lambda x: x != 0)
    usable = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), whole.alias("vector")).where(F.col("vec_id").isNotNull() & fine)
    # 0.0 instead of -0.0, so that equal vectors are equal arrays
    plain = usable.withColumn("vector", F.transform("vector", lambda x: F.when(x == 0, F.lit(0.0)).otherwise(x)))
    return materialize(plain.groupBy("vector").agg(F.min("vec_id").alias("node"), F.count(F.lit(1)).alias("copies")))


def choose(nodes: DataFrame, pivots: int = PIVOTS) -> dict[int, np.ndarray]:
    """The pivots of each dimension as unit vectors, from a sample of at most ``SAMPLE`` times as many distinct vectors.

    A vector nearer than ``APART`` to a pivot is passed over: many pivots in one dense group would be everyone's nearest there, in
    an order that tells nothing.
    """
    rows = [r["vector"] for r in nodes.select("vector").orderBy(F.xxhash64("vector")).limit(SAMPLE * pivots).collect()]
    out = {}
    for dim in sorted({len(r) for r in rows}):
        sample = unit(np.array([r for r in rows if len(r) == dim], float))
        chosen = sample[:1]
        for row in sample[1:]:
            if len(chosen) == pivots:
                break
            if (chosen @ row).max() < APART:
                chosen = np.vstack([chosen, row])
        out[dim] = chosen
    return out


def _of(dim: int) -> int:
    """The bits of a list's key that tell the dimension; two pivots leave them free. The list of a whole dimension is its negative."""
    return (dim & 0xFFFF) << 16 | dim >> 16 << 48


def prefixes(rows: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """The permutation prefix: numbers of the nearest pivots, nearest first; ties by number."""
    near = rows @ pivots.T
    k = min(PREFIX, len(pivots))
    order = np.argsort(-near, axis=1, kind="stable")[:, :k]
    return np.pad(order, ((0, 0), (0, PREFIX - k)), constant_values=-1)


def inverted(nodes: DataFrame, pivots: dict[int, np.ndarray]) -> DataFrame:
    """The inverted lists: key (dimension and two pivots), node, copies, prefix (sorted), vector (8-byte components of length 1)."""
    shared = nodes.sparkSession.sparkContext.broadcast(pivots)
    schema = "key long, node long, copies long, prefix binary, vector binary"

    def run(batches):
        for batch in batches:
            sizes = np.array([len(v) for v in batch.column("vector")])
            for dim in np.unique(sizes).tolist():
                yield from of_dimension(batch.filter(pa.array(sizes == dim)), dim)

    def of_dimension(batch, dim):
        rows, own = unit(np.array(batch.column("vector").to_pylist(), float)), shared.value.get(dim, np.zeros((0, dim)))
        sorted_ = np.sort(prefixes(rows, own), axis=1).astype("<i4")
        a, b = sorted_[:, _PAIRS[:, 0]].astype(np.int64), sorted_[:, _PAIRS[:, 1]].astype(np.int64)
        keys = (a << 32) | b | _of(dim) if len(own) >= PREFIX else np.full((len(rows), 1), -dim)  # too few pivots: one list
        packed, vectors = [p.tobytes() for p in sorted_], [r.tobytes() for r in rows]
        node, copies = batch.column("node").to_pylist(), batch.column("copies").to_pylist()
        for i in range(0, len(rows), 500):
            at = [j for j in range(i, min(i + 500, len(rows))) for _ in set(keys[j].tolist())]
            key = [k for j in range(i, min(i + 500, len(rows))) for k in sorted(set(keys[j].tolist()))]
            yield pa.RecordBatch.from_arrays(
                [pa.array(key, pa.int64()), pa.array([node[j] for j in at], pa.int64()), pa.array([copies[j] for j in at], pa.int64()),
                 pa.array([packed[j] for j in at], pa.binary()), pa.array([vectors[j] for j in at], pa.binary())], ["key", "node", "copies", "prefix", "vector"])

    return nodes.mapInArrow(run, schema)


def first_shared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Per pair of sorted prefixes the key of the two smallest pivots in both; the least key if they share fewer."""
    common = (a[:, :, None] == b[:, None, :]).any(axis=2)
    place = np.argsort(~common, axis=1, kind="stable")[:, :2]
    two = np.take_along_axis(a, place, axis=1).astype(np.int64)
    key = (two[:, 0] << 32) | two[:, 1]
    return np.where(common.sum(axis=1) >= 2, key, np.iinfo(np.int64).min)


def _verify(batches, least):
    for table in blocks.groups(batches, ("key", "block_a", "block_b")):
        n = len(table)
        node, copies = table["node"].to_numpy(), table["copies"].to_numpy()
        side = table["side"].to_numpy(zero_copy_only=False)
        crossing = table["block_a"][0].as_py() != table["block_b"][0].as_py()
        key = table["key"][0].as_py()
        rows, prefix = blocks.matrix(table["vector"], np.float64), blocks.matrix(table["prefix"], np.int32)
        left, right = (np.flatnonzero(~side), np.flatnonzero(side)) if crossing else (np.arange(n), np.arange(n))
        near = rows[left] @ rows[right].T >= least
        i, j = np.nonzero(near if crossing else np.triu(near, 1))
        i, j = left[i], right[j]
        if key >= 0 and len(i):
            mine = first_shared(prefix[i], prefix[j]) | _of(rows.shape[1]) == key
            i, j = i[mine], j[mine]
        if not len(i):
            continue
        links = np.bincount(i, copies[j], n) + np.bincount(j, copies[i], n)
        joined = blocks.Unions()
        for a, b in zip(node[i].tolist(), node[j].tolist()):
            joined.join(a, b)
        at = np.flatnonzero(links)
        yield pa.RecordBatch.from_arrays(
            [pa.array(node[at]), pa.array(links[at].astype(np.int64)), pa.array([joined.find(x) for x in node[at].tolist()], pa.int64())], ["node", "n_links", "root"])


def near_duplicates(vectors: DataFrame, least: float = LEAST, pivots: int = PIVOTS) -> DataFrame:
    """vec_id, n_links, component_id, kept per row of ``vectors`` (vec_id, embedding)."""
    nodes = distinct(vectors)
    chosen = choose(nodes, pivots)
    listed = materialize(inverted(nodes, chosen))
    sizes = listed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    rows = blocks.spread(listed.join(sizes, "key"), "key", "node", F.col("n"))
    found = materialize(rows.mapInArrow(lambda batches: _verify(batches, least), "node long, n_links long, root long"))
    counted = found.groupBy("node").agg(F.sum("n_links").alias("other")).withColumnRenamed("node", "o")
    groups = components(found.select(F.col("node").alias("a"), F.col("root").alias("b"))).select(F.col("node").alias("g"), "component")
    told = materialize(
        nodes.join(counted, F.col("node") == F.col("o"), "left").join(groups, F.col("node") == F.col("g"), "left")
        .select("vector", (F.coalesce("other", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "node").alias("component_id")))
    given = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.when(F.col("vec_id").isNotNull(), F.transform(
        F.col("embedding").cast("array<double>"), lambda x: F.when(x == 0, F.lit(0.0)).otherwise(x))).alias("given"))
    joined = given.join(told, F.col("given") == F.col("vector"), "left")
    component = F.coalesce("component_id", "vec_id")
    return joined.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
                         F.coalesce(component == F.col("vec_id"), F.lit(True)).alias("kept"))
