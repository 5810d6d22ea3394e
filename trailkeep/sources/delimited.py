"""Pipe-delimited tables: read under a policy for missing values, written so that nothing is lost."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trailkeep.functions.values import na_to_null
from trailkeep.operators.quality import GateError, frames_equal
from trailkeep.sources.storage import is_complete, replace_folder


def read_delimited(spark: SparkSession, path: str, schema: T.StructType, na: str = "default",
                   cast: bool = True, multi_line: bool = False, broken: str | None = None,
                   strict: bool = False) -> DataFrame:
    """A pipe-delimited table with a header that must name the columns of ``schema``.

    A row with more or fewer cells than the header stops the read; with ``broken``, a column of that name holds
    its text instead (null for sound rows), for ``quality.quarantine``. Cells are read as text, then cast: one
    that does not parse becomes missing, or stops the read with ``strict``; ``cast=False`` keeps the texts for
    plans that cast under a gate. ``na="default"`` takes the usual tokens for missing, ``na="none"`` keeps every cell as text and blanks as
    ``''``. ``multi_line`` allows line breaks inside quoted cells, at the price of one task per file.
    """
    if na not in ("default", "none"):
        raise ValueError(f"unknown policy: {na}")
    names = [f.name for f in schema]
    aside = [broken] if broken else []
    as_text = T.StructType([T.StructField(c, T.StringType()) for c in [*names, *aside]])
    # Without pruning, a query for a few columns still counts the cells of every row.
    policy = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": broken} if broken else {"mode": "FAILFAST"}
    raw = (
        spark.read.schema(as_text)
        .options(header=True, sep="|", quote='"', escape='"', enforceSchema=False, encoding="UTF-8", columnPruning=False,
                 multiLine=multi_line, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False, **policy)
        .csv(path)
    )
    if na == "none":
        return raw.select(*[F.coalesce(F.col(c), F.lit("")).alias(c) for c in names], *aside)
    sound = F.col(broken).isNull() if broken else F.lit(True)

    def typed(f: T.StructField) -> Column:
        cell = na_to_null(F.col(f.name))
        if not cast or isinstance(f.dataType, T.StringType):
            return cell.alias(f.name)
        if not strict:
            return cell.try_cast(f.dataType).alias(f.name)
        message = F.concat(F.lit(f"{f.name} is no {f.dataType.simpleString()}: "), cell)
        return F.coalesce(cell.try_cast(f.dataType), F.when(cell.isNotNull() & sound, F.raise_error(message))).alias(f.name)

    return raw.select(*[typed(f) for f in schema], *aside)


def _plain(col: Column) -> Column:
    """A floating number without exponent: the digits of its shortest text, shifted, none of them lost."""
    text = col.cast("string")
    form = r"^-?([0-9])\.([0-9]+)E(-?[0-9]+)$"
    whole, power = F.regexp_extract(text, form, 1), F.regexp_extract(text, form, 3).try_cast("int")
    part = F.regexp_replace(F.regexp_extract(text, form, 2), "0+$", "")
    small = F.concat(F.lit("0."), F.repeat(F.lit("0"), -power - 1), whole, part)
    shifted = F.concat(whole, F.substring(part, F.lit(1), power), F.lit("."), F.substring(part, power + 1, F.length(part)))
    large = F.when(F.length(part) <= power, F.concat(whole, F.rpad(part, power, "0"))).otherwise(shifted)
    sign = F.when(text.startswith("-"), "-").otherwise("")
    plain = F.concat(sign, F.when(power < 0, small).otherwise(large))
    return F.when(F.isnan(col), "").when(text.rlike(form), plain).otherwise(text)


def export_text(df: DataFrame) -> DataFrame:
    """The cells as they are written: ISO dates, plain numbers, blank for missing."""
    def cell(f: T.StructField) -> Column:
        col = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            text = _plain(col)
        elif isinstance(f.dataType, T.DateType):
            text = F.date_format(col, "yyyy-MM-dd")
        elif isinstance(f.dataType, T.ArrayType):
            text = F.array_join(col, "; ")
        else:
            text = col.cast("string")
        return F.coalesce(text, F.lit("")).alias(f.name)

    return df.select(*[cell(f) for f in df.schema])


def _holds_break(cells: DataFrame) -> Column:
    return F.greatest(F.lit(False), F.lit(False), *[F.coalesce(F.col(f"`{c}`").rlike("[\r\n]"), F.lit(False)) for c in cells.columns])


def _figures(cells: DataFrame) -> dict[str, Column]:
    """Row count and order-free digests of exported cells, and how many rows hold a line break."""
    row = F.concat_ws("|", *[F.concat(F.length(c).cast("string"), F.lit(":"), F.col(c)) for c in cells.columns])
    wide = "decimal(38,0)"
    return {
        "rows": F.count(F.lit(1)),
        "a": F.sum(F.xxhash64(row).cast(wide)),
        "b": F.sum(F.xxhash64(F.lit("trail"), row).cast(wide)),
        "breaks": F.count_if(_holds_break(cells)),
    }


def write_delimited(df: DataFrame, path: str, mode: str = "overwrite") -> dict[str, object]:
    """Export a table; returns what the writing tasks counted: rows, two digests, and rows with a line break."""
    cells, seen = export_text(df), Observation()
    (
        cells.observe(seen, *[c.alias(n) for n, c in _figures(cells).items()]).write.mode(mode)
        .options(header=True, sep="|", quote='"', escape='"', emptyValue="", nullValue="", encoding="UTF-8",
                 ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
        .csv(path)
    )
    return dict(seen.get)


def _read_text(spark: SparkSession, path: str, columns: list[str], breaks: bool = True) -> DataFrame:
    """The cells of an export. Without line breaks in them a file is read by as many tasks as it has splits."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    return read_delimited(spark, path, schema, na="none", multi_line=breaks)


def content_digest(df: DataFrame) -> tuple:
    """Row count and order-free digests of the exported cells."""
    cells = export_text(df)
    found = cells.agg(*[c.alias(n) for n, c in _figures(cells).items()]).first()
    return found.rows, found.a, found.b


def write_if_changed(df: DataFrame, path: str) -> bool:
    """Write unless the same content lies there already; True if written.

    The new export is staged beside the target, so ``df`` may have been read from it, and read back: it takes the
    target's place only if its digests are those of ``df``, which are gathered at the write unless there was an
    export to compare with before.
    """
    spark, expected = df.sparkSession, None
    if is_complete(spark, path):
        header = spark.read.options(header=True, sep="|").csv(path).columns
        expected = content_digest(df)
        if header == df.columns and content_digest(_read_text(spark, path, df.columns)) == expected:
            return False
    staged = path.rstrip("/") + ".staged"
    wrote = write_delimited(df, staged)
    expected = expected or (wrote["rows"], wrote["a"], wrote["b"])
    back = content_digest(_read_text(spark, staged, df.columns, wrote["breaks"] > 0))
    if back != expected:
        raise GateError([("round trip", abs(expected[0] - back[0]) or 1, staged)])
    replace_folder(spark, staged, path)
    return True


def verify_round_trip(df: DataFrame, path: str) -> DataFrame:
    """Compare an export with what was exported: every cell equal, blank as missing."""
    cells = export_text(df)
    broken = not cells.filter(_holds_break(cells)).isEmpty()
    return frames_equal(cells, _read_text(df.sparkSession, path, df.columns, broken))


def require_round_trip(df: DataFrame, path: str) -> None:
    found = verify_round_trip(df, path).first()
    if found.only_left or found.only_right or not found.same_columns:
        raise GateError([("round trip", found.only_left + found.only_right, path)])
