"""Quartiles, interquartile fences, and what to do with the values beyond them.

The quartiles are exact with linear interpolation, without gathering or sorting the values of a
group. The table is read twice: a mergeable sketch brackets each rank, and the distinct values within
the brackets are kept with their counts, the others only counted. Counts per slice of the kept values
(combined before the shuffle) tell in which slice a rank lies, and a slice with more than one value is
cut again. Were a rank beyond its bracket, the same narrowing would run over the table itself, so the
sketch only decides how much is kept, never the result.
"""

from __future__ import annotations

import sys
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from trailkeep.functions.values import nan_to_null
from trailkeep.operators.quality import GateError
from trailkeep.operators.skew import lookup_join
from trailkeep.session import checkpointed, written

SKETCH_ACCURACY = 50_000
BRACKET = 1e-4
SLICES = 4096
FENCE_FACTOR = 1.5
_INFINITY = float("inf")
_LARGEST = sys.float_info.max


def _long(df: DataFrame, cols: Sequence[str], by: Sequence[str]) -> DataFrame:
    """One row per measurement: (by..., column, value), missing ones left out."""
    cells = F.array(*[
        F.struct(F.lit(c).alias("column"), nan_to_null(F.col(c).cast("double")).alias("value")) for c in cols
    ])
    if len(cols) == 1:
        long = df.select(*by, F.lit(cols[0]).alias("column"), nan_to_null(F.col(cols[0]).cast("double")).alias("value"))
    else:
        long = df.select(*by, F.inline(cells))
    return long.filter(F.col("value").isNotNull())


def _slice_counts(placed: DataFrame, group: Sequence[str], slices: int) -> DataFrame:
    """(group..., at, segment, slice, below, ranks, lo, hi, c): counts per slice of each open range.

    ``open`` holds disjoint ranges as (breaks, below): ascending break points, and how many values lie
    below the first one. There are at most ``slices`` + 2 slices between two break points. A row stands for
    ``c`` values (one if there is no such column); one without ``value`` for those of its ``segment`` behind all
    others there.
    """
    counted = "c" in placed.columns
    value, breaks = F.col("value"), F.col("range.breaks")
    at = F.expr("filter(open, r -> value >= r.breaks[0] AND value <= element_at(r.breaks, -1))")
    if counted:
        at = F.when(value.isNull(), F.col("open")).otherwise(at)
    ranged = placed.withColumn("range", F.get(at, F.lit(0))).filter(F.col("range").isNotNull())
    segment = F.size(F.filter(breaks, lambda b: b <= value))
    ranged = ranged.withColumn("segment", F.coalesce(F.col("segment"), segment) if counted else segment)
    low = F.greatest(F.get(breaks, F.col("segment") - 1), F.lit(-_LARGEST))
    high = F.least(F.get(breaks, F.col("segment")), F.lit(_LARGEST))
    half = F.when(high - low == _INFINITY, 0.5).otherwise(1.0)
    share = F.try_divide(value * half - low * half, high * half - low * half)
    part = F.when(value.isNull(), slices + 2).when(value == -_INFINITY, -1).when(value == _INFINITY, slices + 1).otherwise(
        F.coalesce(F.floor(share * slices), F.lit(0)))
    return ranged.groupBy(
        *group, breaks[0].alias("at"), "segment", part.cast("int").alias("slice")
    ).agg(
        F.first("range.below").alias("below"), F.first("ranks").alias("ranks"),
        F.min("value").alias("lo"), F.max("value").alias("hi"), (F.sum("c") if counted else F.count(F.lit(1))).alias("c"),
    )


def _picked(counts: DataFrame, group: Sequence[str]) -> DataFrame:
    """(group..., rank, lo, hi, below): the slice that holds each rank. The window spans the slices of one range."""
    running = W.partitionBy(*group, "at").orderBy("segment", "slice").rowsBetween(W.unboundedPreceding, -1)
    start = F.col("below") + F.coalesce(F.sum("c").over(running), F.lit(0))
    placed = counts.withColumn("below", start)
    hits = F.filter("ranks", lambda r: (r >= F.col("below")) & (r < F.col("below") + F.col("c")))
    return placed.select(*group, F.explode(hits).alias("rank"), "lo", "hi", "below")


def _kept(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """A table of a few rows per group, computed once: staged, or collected where each column is the only group."""
    return checkpointed(df) if by else df.sparkSession.createDataFrame(df.collect(), df.schema)


def _meet(rows: DataFrame, state: DataFrame, group: Sequence[str], by: Sequence[str]) -> DataFrame:
    return lookup_join(rows, state, group, "inner") if by else rows.join(F.broadcast(state), "column")


def _narrowed(rows: DataFrame, state: DataFrame, group: Sequence[str], by: Sequence[str], slices: int) -> DataFrame | None:
    """(group..., rank, value) by narrowing over ``rows`` as of ``_slice_counts``; None if a rank is of no kept value."""
    settled = []
    while True:
        picked = _kept(_picked(_slice_counts(_meet(rows, state, group, by), group, slices), group), by)
        if not picked.filter("lo IS NULL").isEmpty():
            return None
        settled.append(picked.filter("lo = hi").select(*group, "rank", F.col("lo").alias("value")))
        rest = picked.filter("lo < hi")
        if rest.isEmpty():
            return reduce(DataFrame.unionByName, settled)
        state = rest.groupBy(*group).agg(
            F.collect_set("rank").alias("ranks"),
            F.collect_set(F.struct(F.array("lo", "hi").alias("breaks"), "below")).alias("open"),
        )
        state = checkpointed(state) if by else state
        rows = rows.filter("value IS NOT NULL")


def exact_quartiles(df: DataFrame, cols: Sequence[str], by: Sequence[str] = (),
                    accuracy: int = SKETCH_ACCURACY, bracket: float = BRACKET, slices: int = SLICES,
                    points: Sequence[float] = (0.25, 0.5, 0.75)) -> DataFrame:
    """(by..., column, n, q1, q2, q3) of the non-missing values; no row for an empty group.

    ``points`` may name other quantiles; they become q1, q2 and so on. A rank's bracket holds about twice
    ``bracket`` of a group's values, and those equal to its ends.
    """
    by = list(by)
    group = [*by, "column"]
    long = _long(df, cols, by).withColumn("value", F.col("value") + F.lit(0.0))
    edges = [min(max(edge, 0.0), 1.0) for p in points for edge in (p - bracket, p + bracket)]
    sketch = long.groupBy(*group).agg(
        F.count(F.lit(1)).alias("n"), F.min("value").alias("__min"), F.max("value").alias("__max"),
        F.percentile_approx("value", edges, accuracy).alias("__edges"),
    )
    breaks = F.array_sort(F.array_distinct(F.concat(F.array("__min"), "__edges", F.array("__max"))))
    positions = [(F.col("n") - 1) * F.lit(p) for p in points]
    ranks = F.array_distinct(F.array(*[end for p in positions for end in (F.floor(p), F.ceil(p))]))
    ends = F.array(*[F.struct(F.get("__edges", F.lit(2 * i)).alias("lo"), F.get("__edges", F.lit(2 * i + 1)).alias("hi"))
                     for i in range(len(points))])
    sizes = _kept(sketch.select(*group, "n", ranks.alias("ranks"), ends.alias("ends"), F.array(
        F.struct(breaks.alias("breaks"), F.lit(0).cast("bigint").alias("below"))).alias("open")), by)
    value = F.col("value")
    near = F.exists("ends", lambda r: (value >= r["lo"]) & (value <= r["hi"]))
    segment = F.size(F.filter(F.col("open")[0]["breaks"], lambda b: b <= value))
    kept = written(
        _meet(long, sizes.select(*group, "ends", "open"), group, by)
        .select(*group, F.when(~near, segment).alias("segment"), F.when(near, value).alias("value"))
        .groupBy(*group, "segment", "value").agg(F.count(F.lit(1)).alias("c")))
    state = sizes.drop("n", "ends")
    found = _narrowed(kept, state, group, by, slices)
    if found is None:
        found = _narrowed(long, state, group, by, slices)
    joined = _meet(found, sizes.select(*group, "n"), group, by)
    result = []
    picks = []
    for i, position in enumerate(positions, start=1):
        for side, rank in (("lo", F.floor(position)), ("hi", F.ceil(position))):
            picks.append(F.max(F.when(F.col("rank") == rank, F.col("value"))).alias(f"__{side}{i}"))
        low, high = F.col(f"__lo{i}"), F.col(f"__hi{i}")
        result.append((low + (high - low) * (position - F.floor(position))).alias(f"q{i}"))
    return joined.groupBy(*group, "n").agg(*picks).select(*group, "n", *result)


def iqr_fences(df: DataFrame, cols: Sequence[str], by: Sequence[str] = (), approximate: bool = False) -> DataFrame:
    """(by..., column, n, q1, q3, lower, upper). ``approximate`` takes the sketch's quartiles as they are."""
    by = list(by)
    if approximate:
        quarts = _long(df, cols, by).groupBy(*by, "column").agg(
            F.count(F.lit(1)).alias("n"),
            F.percentile_approx("value", [0.25, 0.75], SKETCH_ACCURACY).alias("__q"),
        ).select(*by, "column", "n", F.col("__q")[0].alias("q1"), F.col("__q")[1].alias("q3"))
    else:
        quarts = exact_quartiles(df, cols, by, points=(0.25, 0.75)).withColumnRenamed("q2", "q3")
    reach = (F.col("q3") - F.col("q1")) * FENCE_FACTOR
    return quarts.withColumns({"lower": F.col("q1") - reach, "upper": F.col("q3") + reach})


def apply_fences(df: DataFrame, fences: DataFrame, cols: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """``df`` with ``__lower_c`` and ``__upper_c`` for every column; null where a group has no fence."""
    wide = fences.groupBy(*by).agg(*[
        F.max(F.when(F.col("column") == c, F.col(side))).alias(f"__{side}_{c}")
        for c in cols for side in ("lower", "upper")
    ])
    if by:
        return lookup_join(df, checkpointed(wide), list(by), "left")
    row = wide.first()
    return df.withColumns({name: F.lit(row[name]).cast("double") for name in wide.columns})


def _beyond(c: str) -> Column:
    value = nan_to_null(F.col(c).cast("double"))
    return F.coalesce((value < F.col(f"__lower_{c}")) | (value > F.col(f"__upper_{c}")), F.lit(False))


def _fence_columns(cols: Sequence[str]) -> list[str]:
    return [f"__{side}_{c}" for c in cols for side in ("lower", "upper")]


def flag_outliers(df: DataFrame, cols: Sequence[str], by: Sequence[str] = (), fences: DataFrame | None = None,
                  out: str = "is_outlier") -> DataFrame:
    """True where any column lies strictly beyond its fence; a missing value is never flagged."""
    fenced = apply_fences(df, fences if fences is not None else iqr_fences(df, cols, by), cols, by)
    flag = _beyond(cols[0])
    for c in cols[1:]:
        flag = flag | _beyond(c)
    return fenced.withColumn(out, flag).drop(*_fence_columns(cols))


def clip_outliers(df: DataFrame, cols: Sequence[str], by: Sequence[str] = (),
                  fences: DataFrame | None = None) -> DataFrame:
    """Values moved to the fence they lie beyond; a missing value stays missing."""
    fenced = apply_fences(df, fences if fences is not None else iqr_fences(df, cols, by), cols, by)
    clipped = {
        c: F.when(nan_to_null(F.col(c).cast("double")).isNull(), F.lit(None).cast("double")).otherwise(
            F.least(F.greatest(F.col(c).cast("double"), F.col(f"__lower_{c}")), F.col(f"__upper_{c}"))
        )
        for c in cols
    }
    return fenced.withColumns(clipped).drop(*_fence_columns(cols))


def remove_outliers(df: DataFrame, cols: Sequence[str], by: Sequence[str] = (),
                    fences: DataFrame | None = None) -> DataFrame:
    return flag_outliers(df, cols, by, fences, "__flag").filter(~F.col("__flag")).drop("__flag")


def gate_outliers(df: DataFrame, cols: Sequence[str], key: str, by: Sequence[str] = (),
                  fences: DataFrame | None = None) -> None:
    """Stop for source review if any value is flagged."""
    flagged = flag_outliers(df, cols, by, fences, "__flag").filter("__flag")
    found = flagged.agg(F.count(F.lit(1)).alias("n"), F.min(F.col(key)).cast("string").alias("k")).first()
    if found.n:
        raise GateError([("outliers", found.n, found.k)])
