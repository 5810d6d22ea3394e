"""Table profiles. All metrics of a kind come from one aggregation, never one job per column."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trailkeep.functions.values import nan_to_null
from trailkeep.operators.outliers import exact_quartiles, flag_outliers
from trailkeep.operators.skew import fingerprint, lookup_join
from trailkeep.session import checkpointed


STATISTICS = ("mean", "std", "min", "q1", "q2", "q3", "max")


def shape(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("rows"), F.lit(len(df.columns)).alias("columns"))


def _numeric(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)]


def text_like(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, (T.StringType, T.BooleanType))]


def describable(df: DataFrame) -> list[str]:
    """Columns of a kind that ``describe_all`` knows."""
    kinds = (T.StringType, T.BooleanType, T.NumericType, T.DateType, T.TimestampType)
    return [f.name for f in df.schema if isinstance(f.dataType, kinds)]


def _per_column(df: DataFrame, metric: dict[str, Column], name: str) -> DataFrame:
    """One aggregation, one output row per column."""
    cells = [F.struct(F.lit(c).alias("column"), m.cast("bigint").alias(name)).alias(f"m{i}")
             for i, (c, m) in enumerate(metric.items())]
    return df.agg(*cells).select(F.inline(F.array(*[f"m{i}" for i in range(len(metric))])))


def is_missing(field: T.StructField) -> Column:
    """Null, or NaN in a floating column."""
    col = F.col(field.name)
    return nan_to_null(col).isNull() if isinstance(field.dataType, (T.DoubleType, T.FloatType)) else col.isNull()


def missing_counts(df: DataFrame, blank: bool = False, only_gaps: bool = False) -> DataFrame:
    """(column, missing): missing cells per column, or blank cells with ``blank``."""
    def counted(f: T.StructField) -> Column:
        return F.coalesce(F.col(f.name).cast("string"), F.lit("")) == "" if blank else is_missing(f)

    counts = _per_column(df, {f.name: F.count_if(counted(f)) for f in df.schema}, "missing")
    return counts.filter("missing > 0") if only_gaps else counts


def missing_figures(df: DataFrame) -> dict[str, Column]:
    """The missing cells of each column as aggregates, for ``session.gathered_write``."""
    return {f"__missing {f.name}": F.count_if(is_missing(f)) for f in df.schema}


def info(df: DataFrame) -> DataFrame:
    """(column, non_null, type)"""
    counts = _per_column(df, {c: F.count(c) for c in df.columns}, "non_null")
    types = {f.name: f.dataType.simpleString() for f in df.schema}
    kind = F.lit(None).cast("string")
    for name, text in types.items():
        kind = F.when(F.col("column") == name, text).otherwise(kind)
    return counts.withColumn("type", kind)


def _dates_as_numbers(df: DataFrame) -> DataFrame:
    """Dates as days and timestamps as seconds since 1970-01-01."""
    days = {f.name: F.unix_date(F.col(f.name)).cast("double") for f in df.schema if isinstance(f.dataType, T.DateType)}
    seconds = {f.name: F.unix_micros(F.col(f.name)) / 1e6 for f in df.schema if isinstance(f.dataType, T.TimestampType)}
    return df.withColumns({**days, **seconds}) if days or seconds else df


def describe_all(df: DataFrame) -> DataFrame:
    """(column, count, unique, top, freq, mean, std, min, q1, q2, q3, max), the statistics as numbers.

    Dates count as days and timestamps as seconds since 1970-01-01. Text columns get unique, top (smallest value on ties) and freq, numeric ones the rest. The value
    counts of all text columns are one shuffle with map-side combination.
    """
    df = _dates_as_numbers(df)
    numeric = _numeric(df)
    text = text_like(df)
    if not numeric and not text:
        raise ValueError("no column of a kind that can be described")
    number = F.lit(None).cast("double")
    parts = []
    if text:
        cells = df.select(F.inline(F.array(*[
            F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in text
        ])))
        counts = cells.filter(F.col("value").isNotNull()).groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
        parts.append(counts.groupBy("column").agg(
            F.sum("n").alias("count"), F.count(F.lit(1)).alias("unique"),
            F.min(F.struct((-F.col("n")).alias("n"), F.col("value").alias("value"))).alias("best"),
        ).select(
            "column", "count", "unique", F.col("best.value").alias("top"), (-F.col("best.n")).alias("freq"),
            *[number.alias(m) for m in STATISTICS],
        ))
    if numeric:
        row = df.agg(*[
            F.struct(
                F.lit(c).alias("column"), F.count(v).alias("count"), F.avg(v).alias("mean"),
                F.stddev_samp(v).alias("std"), F.min(v).alias("min"), F.max(v).alias("max"),
            ).alias(f"m{i}")
            for i, c in enumerate(numeric) for v in [nan_to_null(F.col(c).cast("double"))]
        ]).select(F.inline(F.array(*[f"m{i}" for i in range(len(numeric))])))
        quarts = exact_quartiles(df, numeric).drop("n")
        parts.append(lookup_join(row, quarts, ["column"], "left").select(
            "column", "count", F.lit(None).cast("bigint").alias("unique"), F.lit(None).cast("string").alias("top"),
            F.lit(None).cast("bigint").alias("freq"), *STATISTICS,
        ))
    return parts[0].unionByName(parts[1]) if len(parts) == 2 else parts[0]


def value_counts(df: DataFrame, col: str) -> DataFrame:
    """(value, n) including missing, most frequent first."""
    return df.groupBy(F.col(col).alias(col)).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.asc_nulls_last(col))


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    return df.select(col).dropna().distinct()


def preview(df: DataFrame, order: str | Sequence[str], n: int = 5) -> DataFrame:
    """The first rows, for a report."""
    return df.orderBy(*([order] if isinstance(order, str) else order)).limit(n)


def summarize(df: DataFrame, numeric_cols: Sequence[str] = (), name: str = "table") -> DataFrame:
    """One row: rows and columns before and after exact-duplicate removal, outliers, rows after removal.

    Without numeric measurement columns the outlier figures are missing ("not applicable"). Clipping
    keeps every row, so ``rows_clipped`` equals ``rows_deduped``.
    """
    cols = list(numeric_cols)
    key = fingerprint(df, df.columns).alias("__key")
    # Equal rows have equal measurements, so only the fingerprint and the measurements are shuffled.
    distinct = df.select(key, *cols).groupBy("__key").agg(F.count(F.lit(1)).alias("__n"), *[F.max(c).alias(c) for c in cols])
    if cols:
        marked = flag_outliers(checkpointed(distinct.drop("__key")), cols, out="__flag")
        flags = F.count_if(F.col("__flag"))
    else:
        marked, flags = distinct, F.lit(None).cast("bigint")
    counted = marked.agg(
        F.coalesce(F.sum("__n"), F.lit(0)).alias("rows"), F.count(F.lit(1)).alias("kept"), flags.alias("outliers")
    )
    return counted.select(
        F.lit(name).alias("table"),
        "rows",
        F.lit(len(df.columns)).alias("columns"),
        F.col("kept").alias("rows_deduped"),
        (F.col("rows") - F.col("kept")).alias("duplicates_removed"),
        "outliers",
        F.when(F.col("outliers").isNotNull(), F.col("kept")).alias("rows_clipped"),
        (F.col("kept") - F.col("outliers")).alias("rows_removed_outliers"),
    )
