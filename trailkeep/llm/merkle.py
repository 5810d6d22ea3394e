"""A Merkle manifest of a dataset: one tree per language, one tree over their roots, and a proof for every row.

The trees are grown level by level, each level from the one below. Proofs are made by leaf partitions (aligned runs
of leaves): a partition computes the coordinates of the nodes that none of its leaves can derive, gets them all by
one join, derives the nodes its leaves share, and expands one proof a leaf from them.
"""

from __future__ import annotations

import string
from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trailkeep.llm.common import broadcast_if_small, map_arrow, ship, staged
from trailkeep.operators.order import number_rows
from trailkeep.operators.skew import lookup_join

#: Children of a node, and the leaves of a partition (a power of the former, so that a partition is one node's leaves).
FAN, PARTITION = 8, 8 ** 3
#: The columns of a document that its leaf covers, in order.
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
#: The number of the tree over the languages' roots; the languages' trees count from 0.
TOP = -1


@dataclass
class Manifest:
    """``leaves(tree, idx, n, doc_id, leaf, claimed, subroot)``, ``nodes(tree, level, idx, hash)`` from the level of a
    partition's root upwards, ``trees(tree, lang, n, subroot)``, and the ``root`` (None of an empty table)."""

    leaves: DataFrame
    nodes: DataFrame
    trees: DataFrame
    root: str | None


def leaf(cells: list[Column]) -> Column:
    """The SHA-256 of cells, each ``-`` if null, else its UTF-8 length, a colon and its value."""
    texts = [c.cast("string") for c in cells]
    marked = [F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    return F.sha2(F.concat(*marked).cast("binary"), 256)


def lowered(text: Column) -> Column:
    """``text`` with A-Z in lower case and all else as it was."""
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def _nodes(level: int) -> Column:
    """How many nodes a tree of ``n`` leaves has at a level."""
    width = FAN ** level
    return F.expr(f"(n + {width - 1}) div {width}")


def _grow(bottom: DataFrame) -> list[DataFrame]:
    """All levels ``(tree, idx, n, hash)`` above and with ``bottom``; a tree's last level is its root. ``n`` counts its leaves."""
    levels = [bottom]
    while True:
        level = len(levels)
        open_ = levels[-1].where(_nodes(level - 1) > 1)
        if open_.isEmpty():
            return levels
        run = F.array_sort(F.collect_list(F.struct("idx", "hash")))
        joined = F.array_join(F.transform(run, lambda x: x["hash"]), "")
        up = open_.groupBy("tree", F.expr(f"idx div {FAN}").alias("idx")).agg(
            F.first("n").alias("n"), F.sha2(joined.cast("binary"), 256).alias("hash"))
        levels.append(staged(up))


def _numbered(levels: list[DataFrame], least: int) -> DataFrame:
    """Nodes ``(tree, level, idx, hash)`` of the levels from ``least`` on."""
    parts = [df.select("tree", F.lit(i).alias("level"), "idx", "hash") for i, df in enumerate(levels) if i >= least]
    return parts[0] if len(parts) == 1 else parts[0].unionByName(_numbered(levels, least + 1))


def build(docs: DataFrame, claimed: Column | None = None) -> Manifest:
    """The manifest of ``docs(doc_id, source, lang, n_chars, text)``.

    Per language (null is one) the leaves ascend by document id, nulls first, rows of one id by their hash; repeated
    rows are leaves of their own. Every eight consecutive nodes become one, the last run with fewer, until one is left;
    the languages' roots, null first and bytewise, likewise. ``claimed`` is the text that each row now claims to have
    (its own if not given). Texts are hashed where they are read and not shuffled; other columns are ignored.
    """
    own = [F.col(c) for c in COLUMNS]
    now = own if claimed is None else [claimed if c == "text" else F.col(c) for c in COLUMNS]
    small = staged(docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"),
        leaf(own).alias("leaf"), leaf(now).alias("claimed")))
    numbered = number_rows(small, ["lang", "doc_id", "leaf"], "at")
    sizes = staged(numbered.groupBy("lang").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n")))
    trees = staged(number_rows(sizes, ["lang"], "tree").withColumn("tree", F.col("tree") - 1))
    placed = lookup_join(numbered, trees, ["lang"]).select(
        "tree", (F.col("at") - F.col("first")).alias("idx"), "n", "doc_id", "leaf", "claimed")
    levels = _grow(placed.withColumnRenamed("leaf", "hash").drop("doc_id", "claimed"))
    roots = [df.where(_nodes(i) == 1).select("tree", "hash") for i, df in enumerate(levels)]
    subroots = roots[0]
    for more in roots[1:]:
        subroots = subroots.unionByName(more)
    subroots = staged(subroots)
    many = subroots.count()
    top = _grow(subroots.select(F.lit(TOP).alias("tree"), F.col("tree").alias("idx"), F.lit(many).alias("n"), "hash"))
    root = top[-1].first()
    least = _level(PARTITION)
    nodes = _numbered(top, 0) if len(levels) <= least else _numbered(levels, least).unionByName(_numbered(top, 0))
    named = lookup_join(trees, subroots.withColumnRenamed("hash", "subroot"), ["tree"])
    return Manifest(
        lookup_join(placed, subroots.withColumnRenamed("hash", "subroot"), ["tree"]), nodes,
        named.select("tree", "lang", "n", "subroot"), root and root["hash"])


def _level(width: int) -> int:
    level = 0
    while FAN ** level < width:
        level += 1
    return level


def missing(first: int, last: int, n: int) -> Iterator[tuple[int, int]]:
    """Coordinates ``(level, idx)`` of the nodes that proofs of the leaves ``first`` to ``last - 1`` of a tree of ``n``
    leaves need and those leaves cannot derive: what is left and right of them in their runs, at each level.
    """
    level = 0
    while n > 1:
        start, end = first // FAN * FAN, min(-(-last // FAN) * FAN, n)
        for idx in (*range(start, first), *range(last, end)):
            yield level, idx
        first, last, n, level = first // FAN, -(-last // FAN), -(-n // FAN), level + 1


def _plan(batches: Iterator[pa.RecordBatch], many: int) -> Iterator[pa.RecordBatch]:
    names = ["tree", "block", "of", "level", "idx"]
    for batch in batches:
        rows = []
        for tree, block, n in zip(*[c.to_pylist() for c in batch.columns]):
            first = block * PARTITION
            rows += [(tree, block, tree, level, idx) for level, idx in missing(first, min(first + PARTITION, n), n)]
            rows += [(tree, block, TOP, level, idx) for level, idx in missing(tree, tree + 1, many)]
        columns = zip(*rows) if rows else [[]] * len(names)
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names)


def _sha(text: str) -> str:
    return sha256(text.encode()).hexdigest()


def _sides(known: dict[int, str], fetched: dict[tuple[int, int], str], n: int) -> list[dict[int, tuple[str, str]]]:
    """For each level up to the root, what stands left and right of each known or derived node in its run."""
    out, level = [], 0
    while n > 1:
        sides, above = {}, {}
        for run in {i // FAN for i in known}:
            span = range(run * FAN, min(run * FAN + FAN, n))
            hashes = [known[i] if i in known else fetched[level, i] for i in span]
            above[run] = _sha("".join(hashes))
            for k, i in enumerate(span):
                if i in known:
                    sides[i] = "".join(hashes[:k]), "".join(hashes[k + 1:])
        out.append(sides)
        known, n, level = above, -(-n // FAN), level + 1
    return out


def _chain(sides: list[dict[int, tuple[str, str]]], idx: int) -> list[tuple[str, str]]:
    steps = []
    for level in sides:
        steps.append(level[idx])
        idx //= FAN
    return steps


def _expand(leaves: pa.Table, fetched: pa.Table, many: int, whole: bool) -> pa.Table:
    """One row a leaf of a partition: its proof's digest, the root folded from its claimed leaf (and its proof)."""
    by_tree: dict[int, dict] = {}
    for of, level, idx, value in zip(*[fetched.column(c).to_pylist() for c in ("of", "level", "idx", "hash")]):
        by_tree.setdefault(of, {})[level, idx] = value
    tree, n = leaves.column("tree")[0].as_py(), leaves.column("n")[0].as_py()
    index, own = leaves.column("idx").to_pylist(), leaves.column("leaf").to_pylist()
    sides = _sides(dict(zip(index, own)), by_tree.get(tree, {}), n)
    subroot = leaves.column("subroot")[0].as_py()
    upper = _chain(_sides({tree: subroot}, by_tree.get(TOP, {}), many), tree)
    digests, folded, proofs = [], [], []
    for idx, value in zip(index, leaves.column("claimed").to_pylist()):
        steps = [*_chain(sides, idx), *upper]
        for left, right in steps:
            value = _sha(left + value + right)
        text = "".join(left + right for left, right in steps)
        digests.append(_sha(text))
        folded.append(value)
        proofs.append([text[i:i + 64] for i in range(0, len(text), 64)] if whole else None)
    return pa.table({
        "doc_id": leaves.column("doc_id"), "leaf": leaves.column("leaf"), "subroot": leaves.column("subroot"),
        "proof_sha256": pa.array(digests, pa.string()), "folded_root": pa.array(folded, pa.string()),
        "proof": pa.array(proofs, pa.list_(pa.string()))})


def prove(manifest: Manifest, whole: bool = False) -> DataFrame:
    """Columns ``doc_id, leaf, subroot, root, proof_sha256, folded_root, verified`` and ``proof`` for every leaf.

    ``proof`` lists the siblings from the leaf's run up to the last below the root, left to right (only with
    ``whole``, else null); ``folded_root`` is what they and the claimed leaf give. An empty table gives an empty result.
    """
    spark = manifest.leaves.sparkSession
    many = manifest.trees.count()
    blocks = manifest.trees.select("tree", F.explode(F.expr(f"sequence(0L, (n - 1) div {PARTITION})")).alias("block"), "n")
    plan = map_arrow(blocks, lambda batches: _plan(batches, many), "tree long, block long, of long, level long, idx long")
    nodes = broadcast_if_small(manifest.nodes.select(F.col("tree").alias("of"), F.col("level").cast("long"), "idx", "hash"))
    fetched = plan.join(nodes, ["of", "level", "idx"]).select("tree", "block", "of", "level", "idx", "hash")
    leaves = manifest.leaves.withColumn("block", F.expr(f"idx div {PARTITION}"))
    ship(spark)
    found = leaves.groupBy("tree", "block").cogroup(fetched.groupBy("tree", "block")).applyInArrow(
        lambda left, right: _expand(left, right, many, whole),
        "doc_id long, leaf string, subroot string, proof_sha256 string, folded_root string, proof array<string>")
    root = F.lit(manifest.root).cast("string")
    return found.select(
        "doc_id", "leaf", "subroot", root.alias("root"), "proof_sha256", "folded_root",
        (F.col("folded_root") == root).alias("verified"), "proof")
