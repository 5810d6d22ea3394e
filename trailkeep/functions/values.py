"""Missing values, types and categories of single cells."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from trailkeep.functions.extract import to_date
from trailkeep.functions.text import SPACE, blank_to_null, collapse_space, html_unescape, let, strip
from trailkeep.rules import NA_TOKENS

NUMBER = r"\A[+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?\z"
PHONE_RUN = rf"[+]?\p{{Nd}}[\p{{Nd}}{SPACE[1:-1]}().-]{{6,}}\p{{Nd}}"
ANY_DIGIT = r"[0-9\x{660}-\x{10ffff}]"
EMAIL_FORM = rf"\A[^{SPACE[1:-1]}@]+@[^{SPACE[1:-1]}@]+\.[^{SPACE[1:-1]}@]+\z"


def na_to_null(col: Column) -> Column:
    """Texts that stand for a missing value become null."""
    return F.when(~col.isin(*NA_TOKENS), col)


def nan_to_null(col: Column) -> Column:
    """NaN counts as missing: for Spark it is greater than every number."""
    return F.when(~F.isnan(col), col)


def fill_category(col: Column, label: str = "unspecified") -> Column:
    return F.coalesce(blank_to_null(F.lower(strip(col))), F.lit(label))


def standardize_category(col: Column) -> Column:
    return F.lower(strip(col))


def to_number(col: Column, kind: str = "double") -> Column:
    """A number, or null. Only plain notation counts: no ``1d``, ``NaN`` or ``inf``."""
    text = strip(col.cast("string"))
    return F.when(text.rlike(NUMBER), text.try_cast(kind))


def to_whole(col: Column) -> Column:
    """A whole number as BIGINT (``66725.0`` too), or null."""
    number = to_number(col)
    text = strip(col.cast("string"))
    exact = F.regexp_extract(text, r"\A([+-]?[0-9]+)(?:\.0*)?\z", 1).try_cast("bigint")
    return F.when(number == F.floor(number), F.coalesce(exact, number.try_cast("bigint")))


def parse_grouped_int(col: Column) -> Column:
    """``12,345`` as 12345; null if absent or not a number."""
    return F.replace(col, F.lit(","), F.lit("")).try_cast("bigint")


def to_iso_date(col: Column) -> Column:
    """An ISO date, or null (also for 2026-02-30)."""
    return to_date(strip(col.cast("string")))


def lost_in_cast(raw: Column, cast: Column) -> Column:
    """True where a nonblank cell did not survive its cast."""
    return raw.isNotNull() & (strip(raw.cast("string")) != "") & cast.isNull()


def normalize_text(col: Column) -> Column:
    """References decoded, white space collapsed, blank becomes null."""
    return blank_to_null(collapse_space(html_unescape(col)))


def normalize_phone(col: Column) -> Column:
    """Phone-like runs joined by ``; ``, or the text itself if there is none. Digits stay as published."""
    def joined(text: Column) -> Column:
        runs = F.transform(F.regexp_extract_all(text, F.lit(PHONE_RUN), F.lit(0)), lambda run: collapse_space(run))
        return F.when(text.rlike(ANY_DIGIT), F.coalesce(blank_to_null(F.array_join(runs, "; ")), text)).otherwise(text)

    return let(F.coalesce(collapse_space(html_unescape(col)), F.lit("")), joined)


def normalize_email(col: Column) -> Column:
    return F.lower(col)


def is_email(col: Column) -> Column:
    return col.rlike(EMAIL_FORM)


def is_web_url(col: Column) -> Column:
    return col.rlike(r"\Ahttps?://")
