"""A Merkle manifest of a table: persistent trees, one per source, under a tree of sources.

A row is a leaf; per source leaves ascend by doc_id, and every ``ARITY`` consecutive nodes become one. ``ARITY ** LEVELS`` leaves are an aligned block, whose
nodes one task makes; the blocks' roots are the nodes of the next stage, made in the same way by other tasks, until each source has one node. Then
the sources' roots are the leaves of one more tree. Every stage has 2187 times fewer rows than the one below it.

A tree is never changed. A leaf that no longer holds what it held creates a version: only its ancestors are copied, first those in its block,
then, with the siblings that the stages above hand down to the block, those up to the root; all other nodes are shared. ``copied``
has the new nodes from the leaf's parent to the root.

Defined results: null fields count as ``-``; a null ``doc_id`` comes first in its source and a null source first among sources; rows that repeat a ``doc_id`` go
by their digests, and equal rows are leaves of their own; a leaf without any sibling has the digest of nothing as proof; an empty table gives
no rows; other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tillstar.session import materialize

ARITY = 3
LEVELS = 7
_FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_PLACE = 33  # monotonically_increasing_id keeps the place in a partition in so many bits


def digest(text: str) -> str:
    return sha256(text.encode()).hexdigest()


def _leaf(text: Column) -> Column:
    columns = {"doc_id": F.col("doc_id").cast("long"), "n_chars": F.col("n_chars").cast("long"), "text": text}
    values = [columns.get(name, F.col(name)).cast("string") for name in _FIELDS]
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(v).cast("string"), F.lit(":"), v), F.lit("-")) for v in values]), 256)


def leaves(documents: DataFrame, now: Column | None = None) -> DataFrame:
    """Stored: grp (the source as text that sorts nulls first), doc_id, digest and changed (the digest with text ``now``, null if the same)."""
    own, later = _leaf(F.col("text")), None if now is None else _leaf(now)
    changed = F.lit(None).cast("string") if later is None else F.when(~now.eqNullSafe(F.col("text")), later)
    return materialize(documents.select(
        F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit("")).alias("grp"), F.col("doc_id").cast("long").alias("doc_id"),
        own.alias("digest"), changed.alias("changed"), F.monotonically_increasing_id().alias("tie")))


def indexed(rows: DataFrame, order: list[Column]) -> DataFrame:
    """Adds idx, the place in ``grp`` by ``order``, and size, the rows of ``grp``, which may have any number of them.

    One row per sorted partition and group tells how many rows of the group come before.
    """
    placed = materialize(rows.orderBy("grp", *order).withColumn("slot", F.monotonically_increasing_id()))
    placed = placed.withColumns({"part": F.shiftright("slot", _PLACE), "at": F.col("slot").bitwiseAND((1 << _PLACE) - 1)}).drop("slot")
    runs = placed.groupBy("grp", "part").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(W.partitionBy("grp").orderBy("part").rowsBetween(W.unboundedPreceding, -1))
    runs = runs.select("grp", "part", (F.coalesce(before, F.lit(0)) - F.col("first")).alias("offset"), F.sum("n").over(W.partitionBy("grp")).alias("size"))
    return placed.join(runs, ["grp", "part"]).withColumn("idx", F.col("at") + F.col("offset")).drop("part", "at", "offset")


class Block:
    """The nodes of an aligned block by level, of a group with ``size`` nodes at the lowest."""

    def __init__(self, digests: list[str], size: int, levels: int):
        self.levels = [digests]
        while size > 1 and len(self.levels) <= levels:
            last = self.levels[-1]
            self.levels.append([digest("".join(last[k : k + ARITY])) for k in range(0, len(last), ARITY)])
            size = -(-size // ARITY)

    def siblings(self, at: int) -> Iterator[tuple[str, str]]:
        """What stands left and right of a leaf's ancestors in their runs, from the leaf up."""
        for level in self.levels[:-1]:
            start = at - at % ARITY
            yield "".join(level[start:at]), "".join(level[at + 1 : start + ARITY])
            at //= ARITY


def climbed(node: str, steps: list[tuple[str, str]]) -> list[str]:
    """The ancestors of ``node`` between these siblings: the nodes that a version copies."""
    out = []
    for left, right in steps:
        node = digest(left + node + right)
        out.append(node)
    return out


def _written(steps: list[tuple[str, str]]) -> str:
    return ",".join(f"{left}|{right}" for left, right in steps)


def _steps(path: str) -> list[tuple[str, str]]:
    return [tuple(step.split("|")) for step in path.split(",")] if path else []


def _in_blocks(nodes: DataFrame, levels: int) -> DataFrame:
    return nodes.withColumn("block", F.floor(F.col("idx") / ARITY**levels))


def stages(nodes: DataFrame, levels: int) -> list[DataFrame]:
    """``nodes`` (grp, idx, size, digest) and the stored stages above them; in the last one each group has one node."""

    def block_root(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("idx")
        size = int(rows["size"].iloc[0])
        top = Block(rows["digest"].tolist(), size, levels).levels[-1][0]
        return pd.DataFrame({"grp": [rows["grp"].iloc[0]], "idx": [int(rows["block"].iloc[0])], "size": [-(-size // ARITY**levels)], "digest": [top]})

    out, largest = [nodes], nodes.agg(F.max("size")).first()[0] or 0
    while largest > 1:
        below = _in_blocks(out[-1].select("grp", "idx", "size", "digest"), levels)
        out.append(materialize(below.groupBy("grp", "block").applyInPandas(block_root, "grp string, idx long, size long, digest string")))
        largest = -(-largest // ARITY**levels)
    return out


def _handed_down(nodes: DataFrame, above: DataFrame, levels: int) -> DataFrame:
    """grp, idx, path (siblings up to the root), subroot of ``nodes``, from the same of the nodes ``above`` them."""

    def run(rows: pd.DataFrame, up: pd.DataFrame) -> pd.DataFrame:
        if rows.empty:
            return pd.DataFrame({"grp": [], "idx": [], "path": [], "subroot": []})
        rows = rows.sort_values("idx")
        block, on = Block(rows["digest"].tolist(), int(rows["size"].iloc[0]), levels), _steps(up["path"].iloc[0])
        paths = [_written([*block.siblings(k), *on]) for k in range(len(rows))]
        return pd.DataFrame({"grp": rows["grp"], "idx": rows["idx"], "path": paths, "subroot": up["subroot"].iloc[0]})

    here, there = _in_blocks(nodes.select("grp", "idx", "size", "digest"), levels), above.withColumnRenamed("idx", "block")
    pairs = here.groupBy("grp", "block").cogroup(there.groupBy("grp", "block"))
    return materialize(pairs.applyInPandas(run, "grp string, idx long, path string, subroot string"))


def paths(tree: list[DataFrame], tops: DataFrame, levels: int) -> DataFrame:
    """What the stages hand down to the one right above the lowest; ``tops``: the same of each group's one node."""
    now = tops
    for nodes in tree[-2:0:-1]:
        now = _handed_down(nodes, now, levels)
    return now


_SCHEMA = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean, copied array<string>"


def _versions(root: str | None, levels: int):
    def run(rows: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
        out = []
        if not rows.empty:
            rows = rows.sort_values("idx")
            block, on, subroot = Block(rows["digest"].tolist(), int(rows["size"].iloc[0]), levels), _steps(above["path"].iloc[0]), above["subroot"].iloc[0]
            behind = "".join(left + right for left, right in on)
            known: dict[str, str] = {}
            for at, (doc_id, leaf, changed) in enumerate(zip(rows["doc_id"], rows["digest"], rows["changed"])):
                own = list(block.siblings(at))
                proof = digest("".join(left + right for left, right in own) + behind)
                version = isinstance(changed, str)
                new = climbed(changed if version else leaf, own)
                top = new[-1] if new else (changed if version else leaf)
                if version or top not in known:
                    new += climbed(top, on)
                    folded = new[-1] if new else top
                    if not version:
                        known[top] = folded
                else:
                    folded = known[top]
                out.append((None if pd.isna(doc_id) else int(doc_id), leaf, subroot, root, proof, folded, folded == root, new if version else None))
        names = [field.split()[0] for field in _SCHEMA.split(", ")]
        return pd.DataFrame(out, columns=names).astype({"doc_id": "Int64"})

    return run


def manifest(documents: DataFrame, now: Column | None = None, levels: int = LEVELS) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified, copied of every row.

    ``now`` is what the text holds by now (default: the same). ``folded_root`` is computed from the leaf as it is now and the siblings in the manifest;
    ``verified`` says whether that is ``root``. ``levels``: how many a task makes of a block.
    """
    lowest = materialize(indexed(leaves(documents, now), [F.col("doc_id").asc_nulls_first(), F.col("digest"), F.col("tie")]))
    tree = stages(lowest, levels)
    subroots = tree[-1].select(F.lit("").alias("grp"), F.col("grp").alias("source"), "digest")
    sources = materialize(indexed(subroots, [F.col("source")]))
    upper = stages(sources, levels)
    top = upper[-1].first()
    # A source's way on is that of its leaf in the tree of sources.
    start = upper[-1].select("grp", "idx", F.lit("").alias("path"), F.lit("").alias("subroot"))
    ends = _handed_down(sources, paths(upper, start, levels), levels).select("idx", "path")
    named = sources.select("idx", F.col("source").alias("grp"), F.col("digest").alias("subroot"))
    tops = materialize(named.join(ends, "idx").select("grp", F.lit(0).cast("long").alias("idx"), "path", "subroot"))
    blocks = paths(tree, tops, levels).withColumnRenamed("idx", "block").groupBy("grp", "block")
    own = _in_blocks(lowest.select("grp", "idx", "size", "doc_id", "digest", "changed"), levels).groupBy("grp", "block")
    return own.cogroup(blocks).applyInPandas(_versions(top["digest"] if top else None, levels), _SCHEMA)
