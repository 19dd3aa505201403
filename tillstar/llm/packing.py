"""Best-fit packing by the configuration linear program over the histogram of lengths.

A configuration says how many pieces of each length share a sequence. The program, fewest sequences that hold
all pieces, is solved by multiplicative weights: a length's weight falls as it gets covered, a knapsack over the capacity prices the best
configuration for each open length, and those near the best of all are taken as whole sequences. Each price also gives a bound from below; where
the first weights end further than ``GAP`` above it, steeper ones in smaller steps follow, and the fewest sequences count. Only what no priced
configuration takes is packed best fit in order of falling length, over groups of equal sequences. Best fit of all pieces is a solution of
the program too, and stands in where the rounds end with more sequences.
All of it works on the histogram (at most ``CAPACITY`` lengths), so the driver's share does not grow with the data, and the resulting
table has at most a few thousand patterns. Pieces take their places by their rank within their length.

Defined results: null or empty text is one piece, the end id; a document longer than the capacity is cut so that its first
piece takes the remainder; rows that repeat a ``doc_id``, and equal rows, are packed each; an empty table gives no rows; other columns are
ignored, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tillstar.llm import tokens
from tillstar.llm.blocks import slices
from tillstar.session import materialize

CAPACITY = 2048
#: Share of sequences above the program's bound at which it counts as solved.
GAP = 0.001
#: Share of the best configuration's value from which one is taken at the same price.
NEAR = 0.99
#: How steeply a covered length's weight falls, and the share of a length that one step may cover.
RATES = ((0.05, 1.0), (5.0, 0.03))
#: Rows of an Arrow batch that are cut into pieces at a time; a batch's texts, ids and pieces at once would be several times its size.
ROWS = 2000
Pattern = tuple[tuple[tuple[int, int], ...], int]  # ((length, how many), ...), how many sequences


def knapsack(weight: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Value of the best configuration per room, and a length in it (0: as with less room); unbounded."""
    lengths = np.flatnonzero(weight > 0)
    value, choice = np.zeros(capacity + 1), np.zeros(capacity + 1, np.int64)
    w = weight[lengths]
    upto = np.searchsorted(lengths, np.arange(capacity + 1), side="right")
    for c in range(int(lengths[0]), capacity + 1):
        options = value[c - lengths[: upto[c]]] + w[: upto[c]]
        best = int(options.argmax())
        if options[best] > value[c - 1]:
            value[c], choice[c] = options[best], lengths[best]
        else:
            value[c] = value[c - 1]
    return value, choice


def filled(choice: np.ndarray, room: int) -> dict[int, int]:
    """Copies per length of the best configuration of ``room``."""
    taken: dict[int, int] = {}
    while room > 0:
        length = int(choice[room])
        if length:
            taken[length] = taken.get(length, 0) + 1
        room -= length or 1
    return taken


def best_configuration(weight: np.ndarray, capacity: int) -> np.ndarray:
    """Copies per length (index: length) of the most valuable configuration; unbounded knapsack."""
    taken = np.zeros(capacity + 1, np.int64)
    for length, many in filled(knapsack(weight, capacity)[1], capacity).items():
        taken[length] = many
    return taken


def rounds(counts: np.ndarray, capacity: int, rate: float, share: float) -> tuple[list[Pattern], np.ndarray, float]:
    """Patterns of priced configurations, the pieces they leave, and the bound of the prices.

    Every price is a dual solution, so the pieces' weights over the best configuration's value bound all packings from below. Per price each open length
    gets the best configuration that holds it; where that is worth ``NEAR`` the best of all, it is taken as often as pieces are left, and no
    more than ``share`` of a length at a time. Of equal fillings the one with the longer pieces comes first. Rounds end when none can be taken whole.
    """
    n, left, size = np.maximum(counts, 1), counts.astype(np.int64).copy(), np.arange(capacity + 1) / capacity
    made: dict[tuple, int] = {}
    bound, moved = 0.0, True
    while moved and left.any():
        moved = False
        price = np.where(left > 0, size * np.exp(-rate * (1 - left / n)) * (1 + 0.1 * size / capacity), 0)
        value, choice = knapsack(price, capacity)
        bound = max(bound, float(price @ counts) / float(value[capacity]))
        lengths = np.flatnonzero(left)
        for length in lengths[price[lengths] + value[capacity - lengths] >= NEAR * value[capacity]][::-1].tolist():
            taken = filled(choice, capacity - length)
            taken[length] = taken.get(length, 0) + 1
            whole = min(min(int(left[k]) // m, max(1, int(n[k] * share) // m)) for k, m in taken.items())
            if whole:
                moved = True
                key = tuple(sorted(taken.items(), reverse=True))
                made[key] = made.get(key, 0) + whole
                for k, m in key:
                    left[k] -= whole * m
    return list(made.items()), left, bound


def solve(counts: np.ndarray, capacity: int = CAPACITY, gap: float = GAP) -> list[Pattern]:
    """Patterns that hold exactly ``counts`` (index: length) pieces."""
    open_ = counts.astype(np.int64).copy()
    alone = int(open_[capacity])
    open_[capacity] = 0
    found, bound = [], 0.0
    for rate, share in RATES:
        patterns, rest, below = rounds(open_, capacity, rate, share)
        found.append(patterns + best_fit(rest, capacity))
        bound = max(bound, below)
        if _sequences(found[-1]) <= max(np.ceil(bound - 1e-6), bound * (1 + gap)):
            break
    # The first of the fewest: best fit of all pieces comes last, so it counts only where the rounds need more.
    return _with_alone(min([*found, best_fit(open_, capacity)], key=_sequences), alone, capacity)


def _sequences(patterns: list[Pattern]) -> int:
    return sum(count for _, count in patterns)


def _with_alone(patterns: list[Pattern], alone: int, capacity: int) -> list[Pattern]:
    return [(((capacity, 1),), alone), *patterns] if alone else patterns


def best_fit(counts: np.ndarray, capacity: int = CAPACITY) -> list[Pattern]:
    """Falling lengths, each piece into the fullest sequence that takes it; equal sequences are one group."""
    rooms: dict[int, list[list]] = {}  # room left: [pattern, count]
    for length in np.flatnonzero(counts)[::-1].tolist():
        need = int(counts[length])
        while need:
            room = min((r for r in rooms if r >= length), default=None)
            if room is None:
                each = min(capacity // length, need)
                group = [(), max(1, need // each)]
                room = capacity
            else:
                group = rooms[room].pop()
                if not rooms[room]:
                    del rooms[room]
                each = min(room // length, need)
            many = min(group[1], need // each)
            if group[1] > many:
                rooms.setdefault(room, []).append([group[0], group[1] - many])
            rooms.setdefault(room - each * length, []).append([(*group[0], (length, each)), many])
            need -= many * each
    return [(pattern, count) for groups in rooms.values() for pattern, count in groups if pattern]


class Places:
    """Where the piece of a given rank within its length goes."""

    def __init__(self, patterns: list[Pattern]):
        rows, base, rank = [], 0, {}
        for pattern, count in patterns:
            at = 0
            for length, many in pattern:
                first = rank.get(length, 0)
                rows.append(((length << 44) + first, base, many, at, first))
                rank[length] = first + count * many
                at += length * many
            base += count
        rows.sort()
        self.table = np.array(rows, np.int64).reshape(-1, 5)
        self.sequences = base

    def of(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        row = self.table[np.searchsorted(self.table[:, 0], (length.astype(np.int64) << 44) + rank, side="right") - 1]
        step = rank - row[:, 4]
        return row[:, 1] + step // row[:, 2], row[:, 3] + step % row[:, 2] * length


def pieces(documents: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """Stored: a row per piece with its ids, its task's number and order, and its rank within task and length."""
    content = tokens.shared_tokenizer(documents.sparkSession, tokenizer)

    def run(batches):
        encoder = tokens.worker_encoder(content.value)
        part, row, seen = TaskContext.get().partitionId(), 0, np.zeros(capacity + 1, np.int64)
        for batch in slices(batches, ROWS):
            out: dict[str, list] = {k: [] for k in ("doc_id", "piece", "start", "length", "ids", "row", "rank")}
            wide = encoder.kind.itemsize
            for doc, ids in zip(batch.column("doc_id").to_pylist(), encoder.encode_column(batch.column("text")).to_pylist()):
                n = len(ids) // wide
                cuts = [0, *range((n - 1) % capacity + 1, n + 1, capacity)]
                for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
                    for name, value in (("doc_id", doc), ("piece", k), ("start", a), ("length", b - a), ("ids", ids[a * wide : b * wide]), ("row", row), ("rank", seen[b - a])):
                        out[name].append(value)
                    row += 1
                    seen[b - a] += 1
            types = {"doc_id": pa.int64(), "piece": pa.int32(), "start": pa.int64(), "length": pa.int64(), "ids": pa.binary(), "row": pa.int64(), "rank": pa.int64()}
            arrays = [pa.array(out[k], t) for k, t in types.items()]
            yield pa.RecordBatch.from_arrays([*arrays, pa.array([part] * len(arrays[0]), pa.int64())], [*types, "part"])

    schema = "doc_id long, piece int, start long, length long, ids binary, row long, rank long, part long"
    return materialize(documents.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, schema))


def pack(documents: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """doc_id, piece, start, length, ids, sequence_id, offset: a row per piece.

    Sequence s holds the pieces with sequence_id s at their offsets, without gaps.
    """
    cut = pieces(documents, tokenizer, capacity)
    per_task = materialize(cut.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n")))
    counts = np.zeros(capacity + 1, np.int64)
    for r in per_task.groupBy("length").agg(F.sum("n").alias("n")).collect():  # at most capacity rows
        counts[r["length"]] = r["n"]
    places = documents.sparkSession.sparkContext.broadcast(Places(solve(counts, capacity)))
    earlier = W.partitionBy("length").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    offsets = per_task.select("part", "length", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))

    def run(batches):
        for batch in batches:
            length, rank = (batch.column(k).to_numpy(zero_copy_only=False) for k in ("length", "rank"))
            sequence, offset = places.value.of(length, rank) if len(length) else (length, length)
            yield pa.RecordBatch.from_arrays([batch.column("part"), batch.column("row"), pa.array(sequence, pa.int64()), pa.array(offset, pa.int64())], ["part", "row", "sequence_id", "offset"])

    ranked = cut.select("part", "row", "length", "rank").join(offsets, ["part", "length"]).select("part", "row", "length", (F.col("rank") + F.col("before")).alias("rank"))
    placed = ranked.mapInArrow(run, "part long, row long, sequence_id long, offset long")
    return cut.join(placed, ["part", "row"]).select("doc_id", "piece", "start", "length", "ids", "sequence_id", "offset")
