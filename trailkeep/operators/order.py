"""Sorting, dense record ids, unions and set differences."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from itertools import accumulate

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trailkeep.functions.text import blank_to_null, strip
from trailkeep.operators.dedup import distinct_ordered
from trailkeep.operators.skew import lookup_join
from trailkeep.session import checkpointed

_ROWS_BITS = 33  # monotonically_increasing_id keeps the partition number above these bits


def sort_records(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Ascending, blank and missing first."""
    return df.orderBy(*cols)


def number_rows(df: DataFrame, order: Sequence[str], out: str = "position") -> DataFrame:
    """Dense 1..n in ``order``, without a window over the whole table.

    The range-partitioned, sorted rows are written to the checkpoint folder, so that counting and
    numbering see the same rows in the same partitions. Only one count per partition is collected.
    """
    spark = df.sparkSession
    placed = checkpointed(df.repartitionByRange(*order).sortWithinPartitions(*order))
    marked = placed.withColumn("__mark", F.monotonically_increasing_id())
    part = F.shiftright("__mark", _ROWS_BITS)
    counts = marked.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n")).orderBy("part").collect()
    starts = [0, *accumulate(r.n for r in counts)][: len(counts)]
    offsets = spark.createDataFrame(
        [(r.part, s) for r, s in zip(counts, starts)], "__part bigint, __start bigint"
    )
    local = F.col("__mark").bitwiseAND(F.lit((1 << _ROWS_BITS) - 1))
    return (
        marked.withColumn("__part", part)
        .join(F.broadcast(offsets), "__part", "left")
        .withColumn(out, F.col("__start") + local + 1)
        .drop("__part", "__start", "__mark")
    )


def assign_ids(df: DataFrame, order: Sequence[str], fmt: str, id_col: str = "record_id") -> DataFrame:
    """Sequential ids such as ``PFX-%03d`` in ``order``; the width grows past the format's."""
    numbered = number_rows(df.drop(id_col), order, "__n")
    ids = F.format_string(fmt, F.col("__n")).alias(id_col)
    return numbered.select(ids, *[c for c in numbered.columns if c != "__n"])


def assign_missing_ids(df: DataFrame, order: Sequence[str], fmt: str, id_col: str = "record_id") -> DataFrame:
    """Present ids stay; the others are numbered by their position among all rows."""
    numbered = number_rows(df, order, "__n")
    kept = F.coalesce(blank_to_null(F.col(id_col)), F.format_string(fmt, F.col("__n")))
    return numbered.withColumn(id_col, kept).drop("__n")


def union_records(*frames: DataFrame) -> DataFrame:
    """All rows of all frames; a column one of them lacks is missing there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def first_nonempty(*frames: DataFrame) -> DataFrame:
    """The first frame that has any row: later sources are not even read."""
    for frame in frames[:-1]:
        if not frame.isEmpty():
            return frame
    return frames[-1]


def only_new(links: DataFrame, known: DataFrame, key: str) -> DataFrame:
    """Links whose key is not known yet."""
    return lookup_join(links, known.select(key).distinct(), [key], "left_anti")


def discover(seeds: DataFrame, *sources: DataFrame, key: str, order: str) -> DataFrame:
    """Seeds and the first source, or the next source if these are empty; distinct keys in order."""
    head = union_records(seeds, sources[0]) if sources else seeds
    found = first_nonempty(head, *sources[1:])
    return distinct_ordered(found.filter(strip(F.col(key)) != ""), key, order)
