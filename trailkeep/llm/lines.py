"""Boilerplate lines by the number of distinct sites they appear on.

Lines are hashed; a first aggregation finds the hashes that occur often enough on more than one site, a second
one merges a HyperLogLog sketch of sites per such hash. Hashes whose estimate is near the threshold get an exact
distinct count. A boilerplate line stays in the document with the smallest id that has it and goes elsewhere.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trailkeep.llm.common import broadcast_if_small, staged

#: A line on at least so many distinct sites is boilerplate.
MIN_SITES = 10
#: Sketches of 2^LG_K registers have a standard error of about 1 / 2^(LG_K / 2); estimates within MARGIN are counted exactly.
LG_K = 10
MARGIN = 0.25


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def _hash(line: Column) -> Column:
    return F.xxhash64(F.trim(line))


def spread(docs: DataFrame, min_sites: int = MIN_SITES) -> DataFrame:
    """Columns ``h, sites, first_doc`` of the boilerplate lines of ``docs(doc_id, text, source)``, one row per line hash.

    Lines are compared without outer spaces; blank ones are never boilerplate, a null source is no site.
    """
    each = (
        docs.where("source IS NOT NULL").select(F.col("doc_id").cast("long").alias("doc_id"), "source", F.explode(_lines(F.col("text"))).alias("line"))
        .where("trim(line) <> ''")
    )
    hashed = each.select(_hash(F.col("line")).alias("h"), F.xxhash64("source").alias("site"), "doc_id")
    often = hashed.groupBy("h").agg(F.count("*").alias("n"), F.min("site").alias("a"), F.max("site").alias("b"))
    likely = broadcast_if_small(staged(often.where((F.col("n") >= min_sites) & ((F.col("a") < F.col("b")) | F.lit(min_sites < 2))).select("h")))
    seen = staged(hashed.join(likely, "h").groupBy("h", "site").agg(F.min("doc_id").alias("first_doc")))
    sketched = staged(seen.groupBy("h").agg(
        F.hll_sketch_estimate(F.hll_sketch_agg("site", LG_K)).alias("sites"), F.min("first_doc").alias("first_doc")))
    near = F.abs(F.col("sites") - min_sites) <= F.lit(MARGIN * min_sites)
    exact = seen.join(sketched.where(near).select("h"), "h").groupBy("h").agg(F.count("*").alias("sites"), F.min("first_doc").alias("first_doc"))
    return sketched.where(~near).unionByName(exact).where(F.col("sites") >= min_sites)


def _cleaned(docs: DataFrame, min_sites: int) -> DataFrame:
    """``docs(doc_id, text, ...)`` with ``_kept``, the list of lines that stay."""
    known = broadcast_if_small(staged(spread(docs, min_sites).select("h", "first_doc")))
    each = docs.select(F.col("doc_id").cast("long").alias("_id"), F.explode(F.array_distinct(F.transform(_lines(F.col("text")), _hash))).alias("h"))
    drops = each.join(known, "h").where("first_doc IS NULL OR _id IS NULL OR _id <> first_doc").groupBy("_id").agg(
        F.collect_set("h").alias("_drops"))
    same = F.col("doc_id").cast("long").eqNullSafe(F.col("_id"))
    stays = F.filter(_lines(F.col("text")), lambda x: (F.trim(x) == "") | ~F.array_contains(F.col("_drops"), _hash(x)))
    return docs.join(drops, same, "left").withColumn("_kept", F.when(F.col("_drops").isNull(), _lines(F.col("text"))).otherwise(stays))


def dedup_lines(docs: DataFrame, min_sites: int = MIN_SITES) -> DataFrame:
    """Columns ``doc_id, n_lines, n_removed, text`` for each row of ``docs(doc_id, text, source)``.

    Of a boilerplate line only the rows of its smallest document id keep it, as often as they hold it; kept lines stay
    in order. A null text has no lines and stays null, a text whose lines all go becomes empty. Lines of rows with
    null id go wherever they are boilerplate. Other columns are ignored, an empty table gives an empty result.
    """
    slim = docs.select("doc_id", F.col("text").cast("string").alias("text"), F.col("source").cast("string").alias("source"))
    n = F.coalesce(F.size(_lines(F.col("text"))), F.lit(0)).cast("long")
    n = F.when(F.col("text").isNull(), F.lit(0).cast("long")).otherwise(n)
    left = F.when(F.col("text").isNull(), F.lit(0)).otherwise(F.size("_kept"))
    return _cleaned(slim, min_sites).select(
        F.col("doc_id").cast("long").alias("doc_id"), n.alias("n_lines"), (n - left).cast("long").alias("n_removed"),
        F.array_join("_kept", "\n").alias("text"))


def without_boilerplate(docs: DataFrame, min_sites: int = MIN_SITES) -> DataFrame:
    """``docs`` with boilerplate lines taken out of ``text`` and ``n_chars`` counted anew; all rows and columns stay."""
    done = _cleaned(docs, min_sites).withColumn("text", F.array_join("_kept", "\n"))
    if "n_chars" in docs.columns:
        done = done.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return done.select(*[F.col(f"`{c}`") for c in docs.columns])
