"""Near-duplicate documents by one-permutation hashing.

Each text's word shingles are hashed once; the hash range is cut into bins whose smallest hashes are the
signature, and empty bins borrow from a filled one along a fixed random order of their own (optimal
densification). Bands of the signature are bucket keys. Within a bucket candidates are star-shaped: every
member is compared with one centre. Only what two stars leave open is compared further.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trailkeep.llm.common import components, map_arrow, staged

WIDTH = 5
PERCENT = 75
ROWS, BANDS = 4, 32
BINS = 128
#: Size of the cell maps that bound what two sets can share.
WORDS = 16
#: Words whose hashes a worker remembers, and the numbers in the shingle sets it keeps at a time.
REMEMBERED, HELD = 100_000, 1_000_000
_SHIFT = np.uint64(64 - 7)
_FACTOR = np.uint64(0x9E3779B97F4A7C15)


class _Words(dict):
    """64-bit hashes of words; emptied when it grows large, so that memory stays bounded."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > REMEMBERED:
            self.clear()
        self[word] = value = xxhash.xxh64_intdigest(word)
        return value


_words = _Words()


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def shingle_hashes(text: str | None, width: int = WIDTH) -> np.ndarray:
    """Sorted distinct hashes of the ``width``-word shingles; a shorter text is one shingle, an empty one none.

    Words are runs without ASCII white space; A-Z are lower-cased.
    """
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    hashed = np.fromiter(map(_words.__getitem__, words), np.uint64, len(words))
    span = min(width, len(words))
    count = len(words) - span + 1
    total = np.full(count, span, np.uint64)
    for i in range(span):
        total = _mix(total * _FACTOR + hashed[i:i + count])
    return np.unique(total)


@lru_cache(maxsize=1)
def _borrowing() -> np.ndarray:
    """For each bin, all bins in its own random order, itself first."""
    order = np.stack([np.random.default_rng(i).permutation(BINS) for i in range(BINS)])
    return np.stack([np.concatenate(([i], row[row != i])) for i, row in enumerate(order)])


def signature(hashes: np.ndarray) -> np.ndarray:
    """One minimum per bin of a non-empty sorted set, empty bins filled by densification."""
    bins = (hashes >> _SHIFT).astype(np.int64)
    first = np.flatnonzero(np.diff(bins, prepend=-1))
    values, filled = np.zeros(BINS, np.uint64), np.zeros(BINS, bool)
    values[bins[first]], filled[bins[first]] = hashes[first], True
    order = _borrowing()
    return values[order[np.arange(BINS), filled[order].argmax(axis=1)]]


def band_keys(signed: np.ndarray) -> np.ndarray:
    """One bucket key per band."""
    rows = signed.reshape(BANDS, ROWS)
    key = np.arange(1, BANDS + 1, dtype=np.uint64) * _FACTOR
    for i in range(ROWS):
        key = _mix(key * _FACTOR + rows[:, i])
    return key


def _node(hashes: np.ndarray) -> int | None:
    """The id of a set, the same for equal sets; none for the empty one."""
    return xxhash.xxh3_64_intdigest(hashes.tobytes()) - 2**63 if len(hashes) else None


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sizes, nodes, keys = [], [], []
        for text in batch.column(1):
            hashes = shingle_hashes(text.as_py())
            sizes.append(len(hashes))
            nodes.append(_node(hashes))
            keys.append(band_keys(signature(hashes)).view(np.int64) if len(hashes) else np.empty(0, np.int64))
        offsets = np.concatenate(([0], np.cumsum([len(k) for k in keys]))).astype(np.int32)
        flat = np.concatenate(keys) if keys else np.empty(0, np.int64)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(sizes, pa.int64()), pa.array(nodes, pa.int64()),
             pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat, pa.int64()))], ["doc_id", "n", "node", "bands"])


def _own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows whose text has the set they are to speak for."""
    for batch in batches:
        own = [_node(shingle_hashes(text.as_py())) == node for node, text in zip(batch.column(0).to_pylist(), batch.column(1))]
        yield batch.filter(pa.array(own, pa.bool_()))


class _Sets(dict):
    """Shingle sets of the texts met last, few enough to hold ``HELD`` numbers besides the newest."""

    held = 0

    def of(self, doc: int, text: str) -> np.ndarray:
        found = self.get(doc)
        if found is None:
            if len(self) > 200 or self.held > HELD:
                self.clear()
                self.held = 0
            found = self[doc] = shingle_hashes(text)
            self.held += len(found)
        return found


def _confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs with both texts in, linked pairs out."""
    sets = _Sets()
    for batch in batches:
        found = []
        for a, b, left, right in zip(*(batch.column(i) for i in range(4))):
            a, b = a.as_py(), b.as_py()
            x, y = sets.of(a, left.as_py()), shingle_hashes(right.as_py())
            shared = len(x) + len(y) - len(np.union1d(x, y))
            if 100 * shared >= PERCENT * (len(x) + len(y) - shared):
                found.append((a, b))
        yield pa.RecordBatch.from_arrays(
            [pa.array([p[i] for p in found], pa.int64()) for i in (0, 1)], ["a", "b"])


def _shingles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per shingle, its hash cut to 32 bits: good for an upper bound of what is shared."""
    for batch in batches:
        for node, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            low = (shingle_hashes(text.as_py()) & np.uint64(0xFFFFFFFF)).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(low), pa.array(np.full(len(low), node, np.int64))], ["h", "node"])


def _occupied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Which of 64 * WORDS cells of the hash range hold a shingle, as WORDS numbers of 64 bits."""
    for batch in batches:
        rows = []
        for text in batch.column(1):
            cells = np.zeros(64 * WORDS, np.uint8)
            cells[(shingle_hashes(text.as_py()) >> np.uint64(8)) % np.uint64(64 * WORDS)] = 1
            rows.append(np.packbits(cells).view(np.int64))
        flat = np.concatenate(rows) if rows else np.empty(0, np.int64)
        offsets = np.arange(len(rows) + 1, dtype=np.int32) * WORDS
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))], ["node", "cells"])


def _linked(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs ``a, b`` whose full sets are similar enough."""
    left = texts.select(F.col("node").alias("a"), F.col("text").alias("left"))
    right = texts.select(F.col("node").alias("b"), F.col("text").alias("right"))
    both = pairs.join(right, "b").join(left, "a").select("a", "b", "left", "right")
    return staged(map_arrow(both, _confirm, "a long, b long"))


def _possible() -> F.Column:
    """Whether two sets ``x, y`` of ``n`` shingles, ``s`` of them shared with any other, can reach the threshold."""
    most = F.least("x.s", "y.s")
    return 100 * most >= PERCENT * (F.col("x.n") + F.col("y.n") - most)


def _near_enough() -> F.Column:
    """The same by cells: each cell that only one set occupies holds at least one shingle the other lacks."""
    def lacking(a: str, b: str) -> F.Column:
        return F.expr(" + ".join(f"bit_count({a}.cells[{i}] & ~{b}.cells[{i}])" for i in range(WORDS)))

    most = F.least(F.col("x.n") - lacking("x", "y"), F.col("y.n") - lacking("y", "x"))
    return 100 * most >= PERCENT * (F.col("x.n") + F.col("y.n") - most)


def _open_buckets(members: DataFrame, links: DataFrame) -> DataFrame:
    """The members of buckets that hold more than one component, with their component's ``root``."""
    roots = components(links).withColumnRenamed("id", "node")
    rooted = members.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    mixed = rooted.groupBy("bucket").agg(F.min("root").alias("x"), F.max("root").alias("y")).where("x < y").select("bucket")
    return staged(rooted.join(mixed, "bucket"))


def _shared_counts(texts: DataFrame, members: DataFrame) -> DataFrame:
    """Columns ``node, s``: at most so many of a member's shingles occur in another member."""
    opened = members.select("node").distinct()
    cut = staged(map_arrow(texts.join(opened, "node").select("node", "text"), _shingles, "h long, node long"))
    common = cut.groupBy("h").count().where("count > 1").select("h")
    return cut.join(common, "h").groupBy("node").agg(F.count("*").alias("s"))


def _links(slim: DataFrame, nodes: DataFrame, signed: DataFrame) -> DataFrame:
    """Links ``a, b`` between different sets of one bucket, enough of them for every component."""
    bands = signed.join(nodes.select("node", F.col("rep").alias("doc_id")), ["node", "doc_id"]).select("node", "n", "bands")
    buckets = staged(bands.select("node", "n", F.explode("bands").alias("bucket")).distinct())
    several = buckets.groupBy("bucket").agg(F.min("node").alias("c"), F.max("node").alias("d")).where("c < d")
    members = staged(buckets.join(several.select("bucket", "c"), "bucket"))
    wanted = members.select("node").distinct().join(nodes, "node").select("node", F.col("rep").alias("doc_id"))
    texts = staged(map_arrow(slim.join(wanted, "doc_id").select("node", "text"), _own, "node long, text string"))

    first = members.where("c < node").select(F.col("c").alias("a"), F.col("node").alias("b")).distinct()
    links = _linked(first, texts)

    members = _open_buckets(members.drop("c"), links)
    members = staged(members.join(_shared_counts(texts, members), "node").where(100 * F.col("s") >= PERCENT * F.col("n")))
    fewest = members.groupBy("bucket").agg(F.min(F.struct((F.col("n") - F.col("s")).alias("own"), "node", "n", "s", "root")).alias("c"))
    joined = F.expr("x.bucket = y.bucket AND x.root <> y.root") & _possible()
    second = staged(
        members.alias("x").join(fewest.select("bucket", "c.*").alias("y"), joined)
        .select(F.col("y.node").alias("a"), F.col("x.node").alias("b")).distinct())
    links = staged(links.unionByName(_linked(second, texts)))

    members = _open_buckets(members.drop("root"), links)
    opened = texts.join(members.select("node").distinct(), "node").select("node", "text")
    cells = map_arrow(opened, _occupied, "node long, cells array<long>").dropDuplicates(["node"])
    members = staged(members.join(cells, "node"))
    rest = (
        members.alias("x").join(members.alias("y"), joined & F.expr("x.node < y.node") & _near_enough())
        .select(F.col("x.node").alias("a"), F.col("y.node").alias("b")).distinct())
    done = second.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    return links.unionByName(_linked(staged(rest).join(done, ["a", "b"], "left_anti"), texts))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """Columns ``doc_id, n_shingles, component_id, kept`` for each row of ``docs(doc_id, text)``.

    Documents link when 100 times the shared shingles are at least 75 times the united ones. Equal sets are one
    node however many documents hold it. The first star's centre is a bucket's smallest node, the second's the
    member with the fewest shingles that no other open member has. What is left are pairs of one bucket in
    different components whose sizes, shared shingles and occupied hash cells still allow a link: these are compared
    one by one, so no link between bucket mates is lost. Rows with null or blank text, or null id, link with nothing and are
    kept (component_id is their own id); rows that share an id are linked by it. An empty table gives an empty
    result; other columns are ignored.
    """
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    signed = staged(map_arrow(slim, _sign, "doc_id long, n long, node long, bands array<long>"))
    usable = signed.where("node IS NOT NULL AND doc_id IS NOT NULL")
    nodes = staged(usable.groupBy("node").agg(F.min("doc_id").alias("rep")))
    links = _links(slim, nodes, usable)

    spread = usable.groupBy("doc_id").agg(F.min("node").alias("b"), F.max("node").alias("other")).where("b < other")
    same_id = usable.join(spread.select("doc_id", "b"), "doc_id").select(F.col("node").alias("a"), "b")
    roots = components(links.unionByName(same_id)).withColumnRenamed("id", "node")
    grouped = staged(nodes.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node")))
    least = grouped.groupBy("root").agg(F.min("rep").alias("component_id"))
    of = grouped.join(least, "root").select("node", "component_id")
    alone = F.col("node").isNull() | F.col("doc_id").isNull()
    return signed.drop("bands").join(of, "node", "left").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(alone, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
    ).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def keep_one_of_each(docs: DataFrame) -> DataFrame:
    """``docs`` with one document of each group of near-duplicates, all columns as they were."""
    kept = near_duplicates(docs).where("kept AND doc_id IS NOT NULL").select("doc_id").distinct()
    named = kept.withColumnRenamed("doc_id", "_kept_id")
    return docs.join(named, docs["doc_id"] == named["_kept_id"], "left_semi").unionByName(docs.where("doc_id IS NULL"))
