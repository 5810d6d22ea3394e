"""Column sets and per-column policies."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trailkeep.functions import values as V
from trailkeep.functions.text import blank_to_null, collapse_space, html_unescape, strip


def select_output(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Exactly these columns in this order."""
    return df.select(*columns)


def align_to_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The columns of ``schema``, absent ones missing, present ones in its types."""
    return df.select(*[
        (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema
    ])


def drop_derived(df: DataFrame, *columns: str) -> DataFrame:
    """Without columns an earlier run derived, so that cleaning can be run again."""
    return df.drop(*columns)


def drop_untraceable(df: DataFrame, url_col: str) -> DataFrame:
    """Rows that name their source."""
    return df.filter(F.coalesce(strip(F.col(url_col)), F.lit("")) != "")


def text_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]


def standardize_categories(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Trimmed lower case, on those of the columns that exist."""
    return df.withColumns({c: V.standardize_category(F.col(c)) for c in columns if c in df.columns})


def normalize_text(df: DataFrame, url_suffix: str = "url", blank: bool = False,
                   keep: Sequence[str] = ()) -> DataFrame:
    """Text cells decoded and collapsed, blank as missing; URL columns are only trimmed.

    ``blank`` is the variant that keeps blanks as ``''`` and treats URLs like any text.
    """
    names = [c for c in text_columns(df) if c not in keep]
    urls = [c for c in names if c.endswith(url_suffix) and not blank]
    texts = [c for c in names if c not in urls]
    fixed = df.withColumns({c: blank_to_null(strip(F.col(c))) for c in urls})
    if not texts:
        return fixed

    def cell(value: Column) -> Column:
        return F.coalesce(collapse_space(html_unescape(value)), F.lit("")) if blank else V.normalize_text(value)

    # One expression for all text cells of a row: the plan stays small however many columns there are.
    fixed = fixed.withColumn("__cells", F.transform(F.array(*texts), lambda value: cell(value)))
    return fixed.withColumns({c: F.col("__cells")[i] for i, c in enumerate(texts)}).drop("__cells")


def nulls_to_blank(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Missing cells as ``''``, every column as text, but for the ones to keep."""
    return df.select(*[
        F.col(c) if c in keep else F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in df.columns
    ])


def na_tokens_to_null(df: DataFrame) -> DataFrame:
    return df.withColumns({c: V.na_to_null(F.col(c)) for c in text_columns(df)})


def to_number_checked(df: DataFrame, col: str, kind: str = "double") -> tuple[DataFrame, str]:
    """``col`` as a number, with the raw text kept in ``__raw_<col>`` for the loss gate."""
    raw = f"__raw_{col}"
    cast = V.to_whole(F.col(col)) if kind == "bigint" else V.to_number(F.col(col), kind)
    return df.withColumns({raw: F.col(col), col: cast}), raw


def to_date_checked(df: DataFrame, col: str) -> tuple[DataFrame, str]:
    """``col`` as a date, with the raw text kept in ``__raw_<col>`` for the loss gate."""
    raw = f"__raw_{col}"
    return df.withColumns({raw: F.col(col), col: V.to_iso_date(F.col(col))}), raw
