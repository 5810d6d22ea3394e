"""Ranked search by pipelined term partitioning.

Every term has one owner, and the owners work one after the other, rare terms first. Bundles of items travel through
them and carry, for each block of documents, a sparse list of scores; at each owner they meet its postings (cogroup)
and take up their integer contributions. A document that can no longer be among the best of its block leaves the
list, by exact bounds on what the later owners can still add.
"""

from __future__ import annotations

import re
import string
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trailkeep.llm.common import BROADCAST_ROWS, broadcast_if_small, map_arrow, ship, staged
from trailkeep.operators.order import number_rows

TOP, OWNERS = 20, 4
#: Documents of a block, and items that travel together: what a task holds is their product, as 64-bit numbers.
BLOCK, BUNDLE = 8_192, 256
_TERMS = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
_LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)
_STATE = ("bundle long, block long, item long, "
          "terms array<struct<owner:int,t:long,times:long,w:long,best:long>>, docs array<long>, scores array<long>")


def terms_of(text: str | None) -> Counter:
    """How often each term occurs; only A-Z are lower-cased."""
    found: Counter = Counter()
    for word, n in Counter(_TERMS.findall(text or "")).items():
        found[word.translate(_LOWER)] += n
    return found


def _count(batches: Iterator[pa.RecordBatch], needed: Broadcast | None) -> Iterator[pa.RecordBatch]:
    """Key, number of terms, and the needed distinct terms with their counts, of each text."""
    for batch in batches:
        sizes, terms, times = [], [], []
        for text in batch.column(1).to_pylist():
            found = terms_of(text)
            sizes.append(found.total())
            kept = found if needed is None else {t: found[t] for t in needed.value & found.keys()}
            terms.append(list(kept))
            times.append(list(kept.values()))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(sizes, pa.int64()), pa.array(terms, pa.list_(pa.string())),
             pa.array(times, pa.list_(pa.int64()))], ["id", "n", "terms", "times"])


def _counted(table: DataFrame, key: str, needed: Broadcast | None = None) -> DataFrame:
    slim = table.select(F.col(key).cast("long").alias("id"), F.col("text").cast("string").alias("text"))
    return map_arrow(slim, lambda batches: _count(batches, needed), "id long, n long, terms array<string>, times array<long>")


def _owners(terms: DataFrame, owners: int) -> Column:
    """The owner of each term by its weight: rare terms first, about the same number of postings each.

    Weights are whole numbers below 1000 times the logarithm of the table's size, so there are few different ones.
    """
    mass = terms.groupBy("w").agg(F.sum("df").alias("n")).orderBy(F.desc("w")).collect()
    total, seen, owner = sum(r.n for r in mass), 0, F.lit(0)
    for r in mass:
        if seen and seen * owners // total != (seen + r.n) * owners // total:
            owner = F.when(F.col("w") <= r.w, min(owners - 1, (seen + r.n) * owners // total)).otherwise(owner)
        seen += r.n
    return owner


def _add(items: pa.Table, postings: pa.Table, owner: int, top: int, width: int) -> pa.Table:
    """The bundles of one block after an owner: contributions added, hopeless documents gone."""
    if not items.num_rows:
        return items
    base = items.column("block")[0].as_py() * width
    t = postings.column("t").to_numpy()
    order = np.argsort(t, kind="stable")
    place = (postings.column("doc").to_numpy() - base)[order]
    impact = postings.column("impact").to_numpy()[order]
    known, starts = np.unique(t[order], return_index=True)
    span = dict(zip(known.tolist(), zip(starts.tolist(), [*starts[1:].tolist(), len(t)])))
    rest, docs, scores = [], [], []
    for terms, at, have in zip(*[items.column(c).to_pylist() for c in ("terms", "docs", "scores")]):
        total = np.zeros(width, np.int64)
        total[np.asarray(at, np.int64) - base] = have
        for term in terms:
            if term["owner"] == owner and term["t"] in span:
                a, b = span[term["t"]]
                total[place[a:b]] += term["times"] * term["w"] * impact[a:b]
        later = [term for term in terms if term["owner"] > owner]
        found = np.flatnonzero(total)
        score = total[found]
        if len(found) > top:
            bound = sum(term["times"] * term["w"] * term["best"] for term in later)
            able = score + bound >= np.partition(score, -top)[-top]
            found, score = found[able], score[able]
        rest.append(later)
        docs.append(found + base)
        scores.append(score)
    schema = items.schema
    return pa.table(
        [items.column("bundle"), items.column("block"), items.column("item"), pa.array(rest, schema.field("terms").type),
         pa.array(docs, pa.list_(pa.int64())), pa.array(scores, pa.list_(pa.int64()))],
        ["bundle", "block", "item", "terms", "docs", "scores"])


def _stage(owner: int, top: int, width: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    return lambda items, postings: _add(items, postings, owner, top, width)


def rank(docs: DataFrame, items: DataFrame, top: int = TOP, owners: int = OWNERS, block: int = BLOCK, bundle: int = BUNDLE) -> DataFrame:
    """Columns ``item_id, rank, doc_id, score``: the ``top`` best rows of ``docs(doc_id, text)`` for each row of
    ``items(item_id, text)``, with score above 0, equal scores by ascending document id (null first).

    Rows are documents: repeated ids are ranked on their own, as are repeated items. Null and empty texts have no term,
    so they are never found and find nothing. Empty tables give an empty result; other columns are ignored.
    """
    spark = docs.sparkSession
    asked = number_rows(
        items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")),
        ["item_id", "text"], "item")
    wanted = staged(_counted(asked, "item").select(F.col("id").alias("item"), F.explode(F.arrays_zip("terms", "times")).alias("x"))
                    .select("item", F.col("x.terms").alias("term"), F.col("x.times").alias("times")))
    distinct = staged(wanted.select("term").distinct())
    few = distinct.count() <= BROADCAST_ROWS
    needed = spark.sparkContext.broadcast({r.term for r in distinct.collect()}) if few else None
    forward = staged(_counted(docs, "doc_id", needed).withColumn("doc", F.monotonically_increasing_id()))
    size = forward.agg(F.count_if(F.col("n") > 0).alias("docs"), F.coalesce(F.sum("n"), F.lit(0)).alias("terms")).first()
    many, length = size.docs, max(size.terms, 1)

    each = forward.select("doc", "n", F.explode(F.arrays_zip("terms", "times")).alias("x")).select(
        "doc", F.col("x.terms").alias("term"), F.col("x.times").alias("tf"), F.expr(f"75 + (25 * n * {many}L) div {length}L").alias("m"))
    each = each.withColumn("impact", F.expr("(1000000000L * tf) div (1000 * tf + 12 * m)"))
    weight = F.floor(F.lit(1000.0) * F.log(F.lit(2.0 * many + 2) / (2 * F.col("df") + 1)))
    terms = staged(
        each.join(broadcast_if_small(distinct), "term", "left_semi").groupBy("term")
        .agg(F.count(F.lit(1)).alias("df"), F.max("impact").alias("best"))
        .withColumn("w", weight).withColumn("t", F.monotonically_increasing_id()))
    terms = terms.withColumn("owner", _owners(terms, owners))

    held = staged(wanted.join(broadcast_if_small(terms), "term")
                  .withColumn("bundle", F.expr(f"(item - 1) div {bundle}")))
    holders = staged(held.select("term", "t", "owner", "bundle").distinct())
    postings = staged(each.join(broadcast_if_small(holders), "term").select(
        "bundle", F.expr(f"doc div {block}").alias("block"), "owner", "t", "doc", "impact"))
    bundles = held.groupBy("bundle", "item").agg(F.collect_list(F.struct(
        F.col("owner").cast("int").alias("owner"), "t", "times", "w", "best")).alias("terms"))
    none = F.array().cast("array<long>")
    state = postings.select("bundle", "block").distinct().join(broadcast_if_small(staged(bundles)), "bundle").select(
        F.col("bundle").alias("bundle"), F.col("block").alias("block"), "item", "terms", none.alias("docs"), none.alias("scores"))
    ship(spark)
    for owner in range(owners):
        here = postings.where(F.col("owner") == owner).drop("owner")
        state = state.groupBy("bundle", "block").cogroup(here.groupBy("bundle", "block")).applyInArrow(
            _stage(owner, top, block), _STATE)

    found = state.select("item", F.explode(F.arrays_zip("docs", "scores")).alias("x")).select(
        "item", F.col("x.docs").alias("doc"), F.col("x.scores").alias("score"))
    named = staged(found).join(forward.select("doc", F.col("id").alias("doc_id")), "doc")
    best = Window.partitionBy("item").orderBy(F.desc("score"), F.asc("doc_id"), F.asc("doc"))
    ranked = named.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top)
    return ranked.join(broadcast_if_small(asked.select("item", "item_id")), "item").select("item_id", "rank", "doc_id", "score")
