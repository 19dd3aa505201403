"""Quality rules: gradient-boosted trees over statistics of whole documents.

The statistics are taken in Arrow tasks, one document at a time. The trees are grown on at
most ``sample`` labelled documents (those with the smallest hash of their id), flattened into
node arrays and scored for a whole batch at once. Features named in ``MONOTONE`` may only move
the score in the stated direction, whatever the sample suggests.

Defined results: null or empty text has zero words and fails the base rule; a null or repeated
``doc_id`` is scored like any row; labels that are null are not used; without labels of both classes
there is no model, the score is null and only the base rule decides; an empty table gives no
rows; other columns, whatever their names, are ignored by ``annotate`` and kept as they are by ``keep``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstar.llm import tokens
from tillstar.llm.shingles import PLACES, WordHashes, mixed

SYMBOLS = "#*$%&|<>"
BLANKS = " \t\n\x0b\x0c\r"
_BLANKS, _SYMBOLS = [ord(c) for c in BLANKS], [ord(c) for c in SYMBOLS]
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
FEATURES = ("symbols_per_word", "dup_line_share", "repeat_share", "distinct_share", "mean_word", "log_words", "stop_share",
            "capital_share", "digit_share", "words_per_line", "one_char_share")
#: -1: more of it never raises the score; 1: never lowers it.
MONOTONE = {"symbols_per_word": -1, "dup_line_share": -1, "repeat_share": -1}
SCHEMA = ", ".join(["doc_id long", *(f"{n} long" for n in BASE), "base_failed boolean", "score double", "kept boolean"])


def repeated_words(hashes: np.ndarray) -> int:
    """Words inside 3-word windows that the text holds at least twice, the first included."""
    n = len(hashes)
    if n < 4:
        return 0
    windows = mixed(hashes[:-2] * PLACES[0] + hashes[1:-1] * PLACES[1] + hashes[2:] * PLACES[2])
    _, which, count = np.unique(windows, return_inverse=True, return_counts=True)
    twice = count[which] > 1
    covered = np.zeros(n, bool)
    for k in range(3):
        covered[k : n - 2 + k] |= twice
    return int(covered.sum())


def statistics(text: str | None, cache: WordHashes) -> tuple[tuple[int, ...], tuple[float, ...]]:
    """The base counts and the features of one whole text."""
    text = text or ""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()
    n = len(words)
    kinds = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    capitals, digits = int(kinds[65:91].sum()), int(kinds[48:58].sum())
    word_chars = len(text) - int(kinds[_BLANKS].sum())
    n_symbols = int(kinds[_SYMBOLS].sum())
    lines = [x for x in text.split("\n") if x.strip(BLANKS)]
    dup = len(lines) - len(set(lines))
    hashes = cache.of(words)
    repeat = repeated_words(hashes)
    base = (n, word_chars, n_symbols, dup, repeat)
    if not n:
        return base, (0.0,) * len(FEATURES)
    _, counts = np.unique(hashes, return_counts=True)
    lengths = np.fromiter(map(len, words), np.int64, n)
    return base, (
        n_symbols / n, dup / max(len(lines), 1), repeat / n, len(counts) / n, word_chars / n, float(np.log1p(n)),
        float(np.sort(counts)[-10:].sum()) / n, capitals / max(word_chars, 1), digits / max(word_chars, 1),
        n / max(len(lines), 1), float((lengths == 1).sum()) / n,
    )


@dataclass
class Trees:
    """Flattened trees: node arrays over all trees, the root of each, and how deep any goes."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    depth: int
    start: float
    limit: float = 0.0

    def score(self, x: np.ndarray) -> np.ndarray:
        """Sum over trees; every row walks all trees at once, one level at a time. Leaves point at themselves."""
        at = np.repeat(self.roots[None, :], len(x), axis=0)
        rows = np.arange(len(x))[:, None]
        for _ in range(self.depth):
            at = np.where(x[rows, self.feature[at]] <= self.threshold[at], self.left[at], self.right[at])
        return self.start + self.value[at].sum(axis=1)


def grow(x: np.ndarray, y: np.ndarray, trees: int = 60, depth: int = 4, rate: float = 0.15, least: float = 8.0,
         ridge: float = 1.0, bins: int = 64, monotone: tuple[int, ...] = ()) -> Trees:
    """Newton boosting of the logistic loss on quantile bins.

    A split on a constrained feature is only taken if its two leaf values are in order, and the halves
    keep to their side of the middle of both, so that deeper splits cannot break the order.
    """
    monotone = monotone or (0,) * x.shape[1]
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(x.shape[1])]
    codes = np.stack([np.searchsorted(edges[j], x[:, j], side="left") for j in range(x.shape[1])], axis=1)
    mean = min(max(float(y.mean()), 1e-6), 1 - 1e-6)
    start = float(np.log(mean / (1 - mean)))
    raw = np.full(len(x), start)
    nodes: list[list[float]] = []  # feature, threshold, left, right, value
    roots = []

    def leaf(rows, g, h, low, high):
        return float(np.clip(-g[rows].sum() / (h[rows].sum() + ridge), low, high))

    def split(rows, g, h, level, low, high):
        k = len(nodes)
        nodes.append([0, np.inf, k, k, rate * leaf(rows, g, h, low, high)])
        if level == depth or len(rows) < 2:
            raw[rows] += nodes[k][4]
            return k
        best = (1e-9, None)
        gt, ht = g[rows].sum(), h[rows].sum()
        for j in range(x.shape[1]):
            if not len(edges[j]):
                continue
            gl = np.cumsum(np.bincount(codes[rows, j], g[rows], len(edges[j]) + 1))[:-1]
            hl = np.cumsum(np.bincount(codes[rows, j], h[rows], len(edges[j]) + 1))[:-1]
            vl, vr = np.clip(-gl / (hl + ridge), low, high), np.clip(-(gt - gl) / (ht - hl + ridge), low, high)
            gain = gl**2 / (hl + ridge) + (gt - gl) ** 2 / (ht - hl + ridge) - gt**2 / (ht + ridge)
            fit = (np.minimum(hl, ht - hl) >= least * 0.05) & ((vr - vl) * monotone[j] >= 0)
            gain = np.where(fit, gain, -np.inf)
            b = int(np.argmax(gain))
            if gain[b] > best[0]:
                best = (gain[b], (j, b, vl[b], vr[b]))
        if best[1] is None:
            raw[rows] += nodes[k][4]
            return k
        j, b, vl, vr = best[1]
        middle = (vl + vr) / 2
        limits = {0: ((low, high), (low, high)), 1: ((low, middle), (middle, high)), -1: ((middle, high), (low, middle))}[monotone[j]]
        goes = codes[rows, j] <= b
        nodes[k][0], nodes[k][1] = j, float(edges[j][b])
        nodes[k][2] = split(rows[goes], g, h, level + 1, *limits[0])
        nodes[k][3] = split(rows[~goes], g, h, level + 1, *limits[1])
        return k

    for _ in range(trees):
        p = 1 / (1 + np.exp(-raw))
        roots.append(split(np.arange(len(x)), p - y, p * (1 - p), 0, -4.0, 4.0))
    table = np.array(nodes)
    return Trees(table[:, 0].astype(np.int64), table[:, 1], table[:, 2].astype(np.int64), table[:, 3].astype(np.int64),
                 table[:, 4], np.array(roots), depth, start)


def _rows(batches: Iterator[pa.RecordBatch], trees: Trees | None) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray, np.ndarray]]:
    tokens.release()
    cache = WordHashes()
    for batch in batches:
        base = np.zeros((batch.num_rows, len(BASE)), np.int64)
        x = np.zeros((batch.num_rows, len(FEATURES)))
        for i, text in enumerate(batch.column("text")):
            base[i], x[i] = statistics(text.as_py(), cache)
        yield batch, base, x, trees.score(x) if trees else np.full(len(x), np.nan)


def _verdict(base: np.ndarray, score: np.ndarray, trees: Trees | None) -> tuple[np.ndarray, np.ndarray]:
    failed = (base[:, 0] < 50) | (100 * base[:, 4] > 50 * base[:, 0])
    return failed, ~failed & ((score >= trees.limit) if trees else True)


def fit(documents: DataFrame, labels: DataFrame, sample: int = 20_000, keep: float = 0.99) -> Trees | None:
    """Trees fitted on at most ``sample`` labelled documents, the limit set on a fifth held out of the fit.

    Of documents that repeat a ``doc_id`` the one with the fewest words counts (ties: the smaller statistics).

    ``keep`` is the share of good held-out documents that must stay above the limit; of such limits
    the one with the most right verdicts is taken.
    """
    chosen = (
        labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull()).select("doc_id", F.col("quality").alias("good"))
        .orderBy(F.xxhash64("doc_id"), "good").limit(sample)
    )
    texts = documents.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")

    def run(batches):
        for batch, base, x, _ in _rows(batches, None):
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("good").cast(pa.int64()), pa.array(list(base[:, 0])), pa.array(x.tolist(), pa.list_(pa.float64()))], ["doc_id", "good", "n", "x"])

    # One row per label, however many documents repeat its doc_id, so that the bound holds for what comes to the driver.
    rows = texts.mapInArrow(run, "doc_id long, good long, n long, x array<double>").groupBy("doc_id", "good").agg(F.min(F.struct("n", "x")).alias("least"))
    got = rows.select("doc_id", "good", "least.n", "least.x").toPandas().sort_values(["doc_id", "n", "good"])
    y = got["good"].to_numpy(float) > 0
    if not len(got) or y.all() or not y.any():
        return None
    x = np.array(got["x"].tolist())
    held = np.arange(len(x)) % 5 == 0
    trees = grow(x[~held], y[~held].astype(float), monotone=tuple(MONOTONE.get(f, 0) for f in FEATURES))
    score = trees.score(x[held])
    good, bad = np.sort(score[y[held]]), np.sort(score[~y[held]])
    highest = good[int((1 - keep) * len(good))] if len(good) else 0.0
    cuts = np.unique(np.concatenate([score[score <= highest], [highest]]))
    right = len(good) - np.searchsorted(good, cuts) + np.searchsorted(bad, cuts)
    best = int(np.argmax(right))
    trees.limit = float(cuts[best] + (cuts[best - 1] if best else cuts[best])) / 2
    return trees


def annotate(documents: DataFrame, trees: Trees | None) -> DataFrame:
    """Statistics, score and verdict per document."""

    def run(batches):
        for batch, base, _, score in _rows(batches, trees):
            failed, kept = _verdict(base, score, trees)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(base[:, k]) for k in range(len(BASE))), pa.array(failed),
                 pa.array(score, from_pandas=True), pa.array(kept)], ["doc_id", *BASE, "base_failed", "score", "kept"])

    return documents.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, SCHEMA)


def keep(documents: DataFrame, trees: Trees | None) -> DataFrame:
    """The documents that pass, all their columns unchanged."""

    def run(batches):
        for batch, base, _, score in _rows(batches, trees):
            yield batch.filter(pa.array(_verdict(base, score, trees)[1]))

    return documents.mapInArrow(run, documents.schema)
