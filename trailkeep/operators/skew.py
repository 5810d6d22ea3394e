"""Lookups that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BROADCAST_ROWS = 1_000_000
BROADCAST_BYTES = 64 * 1024 * 1024


def is_small(df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> bool:
    """Whether a table may be broadcast: its rows and text bytes are counted, not guessed."""
    width = F.lit(8 * max(len(df.columns), 1)).cast("bigint")
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            width = width + F.coalesce(F.octet_length(F.col(f"`{f.name}`")), F.lit(0))
        elif not isinstance(f.dataType, (T.NumericType, T.BooleanType, T.DateType, T.TimestampType)):
            width = width + F.coalesce(F.octet_length(F.to_json(F.struct(F.col(f"`{f.name}`")))), F.lit(0))
    size = df.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(width), F.lit(0)).alias("b")).first()
    return size.n <= max_rows and size.b <= max_bytes


def lookup_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "left",
                broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Join to a table with at most one row per key; missing keys equal missing keys.

    A right side of checked size is broadcast and the left side is not shuffled. Beyond that both
    sides are shuffled, and adaptive execution splits the partitions of heavy keys by map output, so
    that equal rows of one key are spread as well.
    """
    right = right.select(
        *[F.col(k).cast(left.schema[k].dataType).alias(f"__{k}") for k in keys],
        *[c for c in right.columns if c not in keys],
    )
    match = [left[k].eqNullSafe(F.col(f"__{k}")) for k in keys]
    if is_small(right, max_rows=broadcast_rows):
        right = F.broadcast(right)
    return left.join(right, match, how).drop(*[f"__{k}" for k in keys])


def cell_text(field: T.StructField) -> Column:
    """A cell as text, different for different values: timestamps to the microsecond, one zero and one NaN."""
    col, kind = F.col(field.name), field.dataType
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        return F.when(F.isnan(col), "NaN").otherwise((col + F.lit(0.0)).cast("string"))
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(col).cast("string")
    if isinstance(kind, (T.ArrayType, T.MapType, T.StructType)):
        return F.to_json(F.struct(col), {"ignoreNullFields": "false"})
    return F.hex(col) if isinstance(kind, T.BinaryType) else col.cast("string")


def fingerprint(df: DataFrame, keys: Sequence[str]) -> Column:
    """One short grouping value for wide keys (SHA-256 of all cells with their lengths, missing kept apart from blank)."""
    cells = [cell_text(df.schema[k]) for k in keys]
    marked = [F.coalesce(F.concat(F.length(c).cast("string"), F.lit(":"), c), F.lit("-")) for c in cells]
    return F.sha2(F.concat(*marked).cast("binary"), 256)


def group_keys(df: DataFrame, keys: Sequence[str]) -> list[Column]:
    """Grouping columns: the keys themselves, or their fingerprint where whole texts would be shuffled."""
    wide = any(isinstance(df.schema[k].dataType, T.StringType) for k in keys)
    return [fingerprint(df, keys).alias("__key")] if wide else [F.col(k) for k in keys]
