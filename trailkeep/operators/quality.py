"""Gates: predicates over whole tables that stop a run before anything is written."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trailkeep.functions.text import strip
from trailkeep.functions.values import is_email, is_web_url, lost_in_cast
from trailkeep.operators.skew import fingerprint, lookup_join
from trailkeep.session import checkpointed


class GateError(ValueError):
    """Rules that failed, as (rule, failures, a failing key)."""

    def __init__(self, failed: Sequence[tuple[str, int, str | None]]):
        self.failed = list(failed)
        super().__init__("; ".join(f"{r}: {n} failing, such as {k}" for r, n, k in self.failed))


@dataclass(frozen=True)
class RowRule:
    name: str
    failing: Column


@dataclass(frozen=True)
class UniqueRule:
    """Every present key occurs once. Failures are the rows of repeated keys."""

    name: str
    keys: tuple[str, ...]


def no_cast_loss(name: str, raw: str, cast: str) -> RowRule:
    return RowRule(name, lost_in_cast(F.col(raw), F.col(cast)))


def positive(name: str, col: str) -> RowRule:
    return RowRule(name, F.col(col) <= 0)


def not_negative(name: str, col: str) -> RowRule:
    return RowRule(name, F.col(col) < 0)


def whole(name: str, col: str) -> RowRule:
    return RowRule(name, F.col(col) % 1 != 0)


def allowed(name: str, col: str, values: Iterable[str]) -> RowRule:
    """A missing value fails too."""
    return RowRule(name, ~F.coalesce(F.col(col).isin(*values), F.lit(False)))


def present(name: str, col: str) -> RowRule:
    return RowRule(name, F.coalesce(strip(F.col(col).cast("string")), F.lit("")) == "")


def requires(name: str, col: str, other: str) -> RowRule:
    """Where ``col`` is present, ``other`` is too."""
    return RowRule(name, F.col(col).isNotNull() & F.col(other).isNull())


def adds_up(name: str, parts: Sequence[str], total: str) -> RowRule:
    """Where all are present, the parts sum to the total."""
    result = F.col(parts[0])
    for part in parts[1:]:
        result = result + F.col(part)
    return RowRule(name, result != F.col(total))


def web_url(name: str, col: str) -> RowRule:
    return RowRule(name, ~F.coalesce(is_web_url(F.col(col)), F.lit(False)))


def email_form(name: str, col: str) -> RowRule:
    return RowRule(name, F.col(col).isNotNull() & ~is_email(F.col(col)))


def unique(name: str, *keys: str) -> UniqueRule:
    return UniqueRule(name, keys)


def validate(df: DataFrame, rules: Sequence[RowRule | UniqueRule], key: str) -> DataFrame:
    """(rule, failures, sample_key): all row rules in one pass, one shuffle per uniqueness rule.

    ``sample_key`` is the smallest key among the failing rows.
    """
    text_key = F.col(key).cast("string")
    row_rules = [r for r in rules if isinstance(r, RowRule)]
    parts = []
    if row_rules:
        counted = df.agg(*[
            F.struct(
                F.lit(r.name).alias("rule"),
                F.count_if(r.failing).alias("failures"),
                F.min(F.when(r.failing, F.col(key))).cast("string").alias("sample_key"),
            ).alias(f"r{i}")
            for i, r in enumerate(row_rules)
        ])
        parts.append(counted.select(F.inline(F.array(*[f"r{i}" for i in range(len(row_rules))]))))
    for rule in (r for r in rules if isinstance(r, UniqueRule)):
        held = df.dropna(subset=list(rule.keys))
        sizes = held.groupBy(*rule.keys).agg(F.count(F.lit(1)).alias("__n"), F.min(text_key).alias("__k"))
        parts.append(sizes.filter("__n > 1").agg(
            F.lit(rule.name).alias("rule"),
            F.coalesce(F.sum("__n"), F.lit(0)).alias("failures"),
            F.min("__k").alias("sample_key"),
        ))
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


def enforce(metrics: DataFrame) -> None:
    """Raise if any rule failed. The metrics hold one row per rule."""
    failed = metrics.filter("failures > 0").collect()
    if failed:
        raise GateError([(r.rule, r.failures, r.sample_key) for r in failed])


def failing_rows(df: DataFrame, rule: RowRule) -> DataFrame:
    """The rows a rule rejects, for source review."""
    return df.filter(rule.failing)


def quarantine(df: DataFrame, rules: Sequence[RowRule], reason_col: str = "error") -> tuple[DataFrame, DataFrame]:
    """(good, rejects): rejected rows carry the name of the first rule they break."""
    reason = F.coalesce(*[F.when(r.failing, F.lit(r.name)) for r in rules])
    judged = df.withColumn(reason_col, reason)
    return judged.filter(F.col(reason_col).isNull()).drop(reason_col), judged.filter(F.col(reason_col).isNotNull())


def same_columns(df: DataFrame, expected: Sequence[str]) -> None:
    """Column names and order equal the expected ones."""
    if df.columns != list(expected):
        raise GateError([("columns", 1, f"{df.columns} is not {list(expected)}")])


def required_columns(df: DataFrame, required: Sequence[str]) -> None:
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise GateError([("required columns", len(missing), ", ".join(missing))])


def _by_fingerprint(left: DataFrame, right: DataFrame) -> DataFrame:
    """All rows of both sides with ``__l`` or ``__r`` 1 and a fingerprint of the cells they have in common."""
    common = [c for c in left.columns if c in right.columns]
    sides = left.select(*common, F.lit(1).alias("__l"), F.lit(0).alias("__r")).unionByName(
        right.select(*common, F.lit(0).alias("__l"), F.lit(1).alias("__r"))
    )
    return sides.withColumn("__print", fingerprint(sides, common))


def _tally(sides: DataFrame) -> DataFrame:
    return sides.groupBy("__print").agg(F.sum("__l").alias("__l"), F.sum("__r").alias("__r"))


def frames_equal(left: DataFrame, right: DataFrame) -> DataFrame:
    """Comparison as bags of rows: (left_rows, right_rows, only_left, only_right, same_columns).

    Rows are compared by a 256-bit fingerprint of their typed cells, so only fingerprints and counts are shuffled.
    """
    same = left.columns == right.columns
    diff = _tally(_by_fingerprint(left, right).select("__print", "__l", "__r"))
    zero = F.lit(0).cast("bigint")
    return diff.agg(
        F.coalesce(F.sum("__l"), zero).alias("left_rows"),
        F.coalesce(F.sum("__r"), zero).alias("right_rows"),
        F.coalesce(F.sum(F.greatest(F.col("__l") - F.col("__r"), zero)), zero).alias("only_left"),
        F.coalesce(F.sum(F.greatest(F.col("__r") - F.col("__l"), zero)), zero).alias("only_right"),
        F.lit(same).alias("same_columns"),
    )


def differing_rows(left: DataFrame, right: DataFrame) -> DataFrame:
    """The rows one side has more often than the other: their common cells, ``side`` and ``surplus``.

    Only the fingerprints that differ meet the rows again, so equal rows are never shuffled with their cells.
    """
    sides = _by_fingerprint(left, right)
    differ = checkpointed(_tally(sides.select("__print", "__l", "__r")).filter("__l <> __r").select(
        "__print", F.abs(F.col("__l") - F.col("__r")).alias("surplus"), (F.col("__l") > F.col("__r")).alias("__left")))
    own = lookup_join(sides, differ, ["__print"], "inner").filter((F.col("__l") == 1) == F.col("__left"))
    side = F.when(F.col("__left"), "left").otherwise("right").alias("side")
    common = [c for c in left.columns if c in right.columns]
    return own.dropDuplicates(["__print"]).select(*common, side, "surplus")


def gathered(rules: Sequence[RowRule], key: str) -> dict[str, Column]:
    """The figures of row rules as aggregates, for ``session.gathered_write``."""
    return {f"__rule{i}": F.struct(
        F.count_if(r.failing).alias("failures"), F.min(F.when(r.failing, F.col(key))).cast("string").alias("sample_key"),
    ) for i, r in enumerate(rules)}


def enforce_gathered(rules: Sequence[RowRule], figures: dict[str, object]) -> None:
    """Raise if any rule failed, by figures gathered at the write."""
    found = [(r.name, figures[f"__rule{i}"]) for i, r in enumerate(rules)]
    failed = [(name, x["failures"], x["sample_key"]) for name, x in found if x["failures"]]
    if failed:
        raise GateError(failed)
