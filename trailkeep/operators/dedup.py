"""Duplicates: keep-first, keep-last, conflict-checked removal, counts and review sets.

``order`` names the columns that say which row is first; results are the same for any partitioning
as long as they tell the rows of a key apart. Every removal aggregates with map-side combination, so a
key that holds a third of all rows arrives as one row per map task. Wide rows are not aggregated: their
fingerprints and order find the keys that repeat, and a lookup takes the later rows of those out.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trailkeep.operators.quality import GateError
from trailkeep.operators.skew import fingerprint, group_keys, lookup_join
from trailkeep.session import checkpointed


def _names(columns: str | Sequence[str]) -> list[str]:
    return [columns] if isinstance(columns, str) else list(columns)


def _is_wide(df: DataFrame) -> bool:
    """Whether rows hold more than one column without a fixed width."""
    fixed = (T.NumericType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)
    return sum(not isinstance(f.dataType, fixed) for f in df.schema.fields) > 1


def _keep_first_narrow(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Rows in place unless an earlier row of their key exists; only keys and order are shuffled.

    Rows of one key that even ``order`` does not tell apart are met again, and one of them stays.
    """
    marks = group_keys(df, keys)
    names = [f"__k{i}" for i in range(len(marks))]
    # A number is compared as it is: the smallest of structs is found by sorting. A missing one is the first place.
    number = len(order) == 1 and isinstance(df.schema[order[0]].dataType, T.NumericType)
    marked = df.select("*", *[m.alias(n) for m, n in zip(marks, names)], (F.col(order[0]) if number else F.struct(*order)).alias("__place"))
    places = marked.select(*names, "__place").groupBy(*names, "__place").agg(F.count(F.lit(1)).alias("__n"))
    missing = F.max(F.when(F.col("__place").isNull(), F.col("__n")))
    first = F.when(missing.isNull(), F.min("__place")).alias("__first")
    ties = F.coalesce(missing, F.min_by("__n", "__place")).alias("__ties")
    repeated = checkpointed(places.groupBy(*names).agg(first, ties, F.sum("__n").alias("__rows")).filter("__rows > 1").drop("__rows"))
    found = lookup_join(marked, repeated, names).filter(F.col("__ties").isNull() | F.col("__place").eqNullSafe(F.col("__first")))
    if repeated.filter("__ties > 1").isEmpty():
        return found.select(*df.columns)
    tied = found.filter("__ties > 1").groupBy(*names).agg(F.first(F.struct(*df.columns)).alias("__row")).select("__row.*")
    return found.filter("__ties IS NULL OR __ties = 1").select(*df.columns).unionByName(tied)


def dedup_keep_first(df: DataFrame, keys: str | Sequence[str], order: str | Sequence[str], derived: bool = False) -> DataFrame:
    """One row per key, the first in ``order``; missing keys equal missing keys.

    Wide rows are read twice, so that none is shuffled whole; ``derived`` says that they are dear to compute and
    better aggregated in one pass.
    """
    keys, order = _names(keys), _names(order)
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.distinct()
    if not derived and _is_wide(df):
        return _keep_first_narrow(df, keys, order)
    if rest == order and len(rest) == 1:
        return df.groupBy(*keys).agg(F.min(rest[0]).alias(rest[0])).select(*df.columns)
    first = F.min_by(F.struct(*df.columns), F.struct(*order)).alias("__first")
    return df.groupBy(*group_keys(df, keys)).agg(first).select("__first.*")


def dedup_except_id(df: DataFrame, id_col: str, order: str | Sequence[str] | None = None, derived: bool = False) -> DataFrame:
    """Rows that agree in every column but the id (and the order columns) are one row: the first."""
    order = _names(order or id_col)
    keys = [c for c in df.columns if c != id_col and c not in order]
    return dedup_keep_first(df, keys, order, derived)


def dedup_last_wins(df: DataFrame, keys: str | Sequence[str], order: str | Sequence[str],
                    position: str = "position") -> DataFrame:
    """The last row per key, with the place of the first one in ``position`` (overwrite semantics)."""
    keys, order = _names(keys), _names(order)
    rest = [c for c in df.columns if c not in keys]
    place = F.col(order[0]) if len(order) == 1 else F.struct(*order)
    last = F.max_by(F.struct(*rest), F.struct(*order)).alias("__last")
    return df.groupBy(*keys).agg(last, F.min(place).alias(position)).select(
        *[c if c in keys else f"__last.{c}" for c in df.columns], position
    )


def distinct_ordered(df: DataFrame, keys: str | Sequence[str], order: str) -> DataFrame:
    """Distinct keys with the place of their first occurrence in ``order``."""
    return df.groupBy(*_names(keys)).agg(F.min(order).alias(order))


def repeated_keys(df: DataFrame, keys: str | Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    return df.groupBy(*_names(keys)).agg(F.count(F.lit(1)).alias("rows")).filter("rows > 1")


def keep_flagged(df: DataFrame, keys: str | Sequence[str]) -> DataFrame:
    """All members of every group of rows that share a key, for review."""
    marks = group_keys(df, _names(keys))
    names = [f"__k{i}" for i in range(len(marks))]
    marked = df.select("*", *[m.alias(n) for m, n in zip(marks, names)])
    flagged = checkpointed(repeated_keys(marked.select(*names), names).drop("rows"))
    return lookup_join(marked, flagged, names, "left_semi").drop(*names)


def duplicate_counts(df: DataFrame, key_sets: Mapping[str, Sequence[str]]) -> DataFrame:
    """Rows and surplus rows per set of keys: (key_set, rows, surplus). One scan and one shuffle for all sets."""
    marks = [F.struct(F.lit(i).alias("set"), fingerprint(df, _names(keys)).alias("key")) for i, keys in enumerate(key_sets.values())]
    each = df.select(F.explode(F.array(*marks)).alias("m")).select("m.set", "m.key")
    sizes = each.groupBy("set", "key").agg(F.count(F.lit(1)).alias("n"))
    none = F.lit(0).cast("bigint")
    found = sizes.agg(*[F.struct(
        F.lit(name).alias("key_set"),
        F.coalesce(F.sum(F.when(F.col("set") == i, F.col("n"))), none).alias("rows"),
        F.coalesce(F.sum(F.when(F.col("set") == i, F.col("n") - 1)), none).alias("surplus"),
    ).alias(f"s{i}") for i, name in enumerate(key_sets)])
    return found.select(F.inline(F.array(*found.columns)))


def near_duplicates(df: DataFrame, near_keys: str | Sequence[str], id_col: str,
                    order: str | Sequence[str] | None = None) -> DataFrame:
    """Rows with equal near keys but different content, after exact copies are gone. Never removed."""
    return keep_flagged(dedup_except_id(df, id_col, order), near_keys)


def conflicting_observations(df: DataFrame, keys: str | Sequence[str], id_col: str) -> DataFrame:
    """Different rows that claim to be the same observation."""
    return near_duplicates(df, keys, id_col)


def refuse_repeated(df: DataFrame, keys: str | Sequence[str], rule: str) -> None:
    """Stop when a key occurs on more than one row."""
    keys = _names(keys)
    found = repeated_keys(df, keys).agg(
        F.count(F.lit(1)).alias("n"), F.min(F.concat_ws(" / ", *[F.col(k).cast("string") for k in keys])).alias("key")
    ).first()
    if found.n:
        raise GateError([(rule, found.n, found.key)])


def dedup_by_url_checked(df: DataFrame, url: str, order: str | Sequence[str],
                         id_col: str | None = None) -> DataFrame:
    """Exact copies removed; refused if a URL still has different contents; one row per URL."""
    variants = checkpointed(dedup_except_id(df, id_col or _names(order)[0], order))
    refuse_repeated(variants.select(url), url, f"one content per {url}")
    return variants


def split_by_url(df: DataFrame, url: str, order: str | Sequence[str],
                 id_col: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(settled, disputed): all rows, apart by whether their URL has different contents, which the checked removal refuses."""
    outside = {id_col or _names(order)[0], *_names(order)}
    contents = df.select(url, fingerprint(df, [c for c in df.columns if c not in outside]).alias("__print")).distinct()
    disputed = checkpointed(repeated_keys(contents, url).drop("rows"))
    return lookup_join(df, disputed, [url], "left_anti"), lookup_join(df, disputed, [url], "left_semi")
