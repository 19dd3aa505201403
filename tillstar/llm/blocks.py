"""Compare the members of large groups in blocks of bounded size, spread over tasks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SIZE = 512


def spread(rows: DataFrame, key: str, member: str, group_size: Column, size: int = SIZE) -> DataFrame:
    """Adds block_a, block_b, side: each pair of a group's chunks is a block of its own.

    A group of at most ``size`` rows is one block. A larger one is cut into chunks by the hash of
    ``member`` and every row goes once to each block its chunk is in, so a block holds about two chunks,
    however large the group.
    """
    chunks = F.ceil(group_size / size).cast("int")
    own = F.pmod(F.xxhash64(member), chunks).cast("int")
    return (
        rows.withColumns({"_own": own, "_chunks": chunks})
        .withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_chunks") - 1)))
        .withColumns({"block_a": F.least("_own", "_other"), "block_b": F.greatest("_own", "_other"), "side": F.col("_own") == F.greatest("_own", "_other")})
        .drop("_own", "_chunks", "_other")
        .repartition(key, "block_a", "block_b").sortWithinPartitions(key, "block_a", "block_b", member)
    )


def groups(batches: Iterator[pa.RecordBatch], columns: tuple[str, ...]) -> Iterator[pa.Table]:
    """Tables of consecutive rows that agree in ``columns`` (integers), also across batches."""
    rest: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = np.stack([batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in columns], axis=1)
        cuts = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
        starts = [0, *cuts.tolist()]
        ends = [*cuts.tolist(), batch.num_rows]
        for s, e in zip(starts, ends):
            now = tuple(keys[s])
            if rest and now != last:
                yield pa.Table.from_batches(rest)
                rest = []
            rest.append(batch.slice(s, e - s))
            last = now
    if rest:
        yield pa.Table.from_batches(rest)


def slices(batches: Iterator[pa.RecordBatch], rows: int = 1000) -> Iterator[pa.RecordBatch]:
    """The same rows in smaller batches, for work that needs several times the memory of its input."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def matrix(column: pa.ChunkedArray | pa.Array, kind: type) -> np.ndarray:
    """Rows of equally long binaries as a matrix."""
    values = column.to_pylist()
    return np.frombuffer(b"".join(values), kind).reshape(len(values), -1) if values else np.zeros((0, 0), kind)


def lists(column: pa.ChunkedArray) -> np.ndarray:
    """Rows of equally long lists as a matrix."""
    return np.array([x.values.to_numpy(zero_copy_only=False) for x in column])


class Unions:
    """Union-find over a block's own labels."""

    def __init__(self):
        self.parent: dict[int, int] = {}

    def find(self, x: int) -> int:
        path = []
        while (up := self.parent.get(x, x)) != x:
            path.append(x)
            x = up
        for y in path:
            self.parent[y] = x
        return x

    def join(self, x: int, y: int) -> bool:
        x, y = self.find(x), self.find(y)
        if x == y:
            return False
        self.parent[max(x, y)] = min(x, y)
        return True
