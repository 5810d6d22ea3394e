"""Cleaning of the curated tables: detect, judge, act. Gates stop a run before anything is written.

Every plan stages its deduplicated table once in the shared folder. Rows, gaps and row rules are counted by the
tasks that write it; what remains (repeated keys, fences) are narrow passes over it. Rows for review are returned as tables, never dropped.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trailkeep.functions import values as V
from trailkeep.functions.text import clean_text, clean_text_punct, collapse_space
from trailkeep.operators import columns as cols
from trailkeep.operators import quality as Q
from trailkeep.operators.dedup import (
    dedup_by_url_checked, dedup_except_id, dedup_keep_first, duplicate_counts, keep_flagged, refuse_repeated,
)
from trailkeep.operators.outliers import flag_outliers, gate_outliers, iqr_fences
from trailkeep.operators.profile import missing_counts, missing_figures
from trailkeep.rules import (
    CONTACT_COLUMNS, LEVEL_VALUES, PROFILE_COUNTS, PROFILE_MEASURES, SECTOR_VALUES, STATUS_VALUES, STOPWORDS,
)
from trailkeep.session import gathered_write, written
from trailkeep.sources.delimited import write_if_changed


@dataclass
class Cleaned:
    """A cleaned table, the figures of its decisions, and the tables to look at."""

    clean: DataFrame
    details: dict[str, object]
    review: DataFrame | None = None
    fences: DataFrame | None = None
    flagged: DataFrame | None = None
    id_col: str | None = None
    outliers: int | None = None


def _sizes(before: int, after: int) -> dict[str, object]:
    return {"input_rows": before, "duplicates_removed": before - after, "output_rows": after}


def _gated(df: DataFrame, rules: Sequence[Q.RowRule], key: str) -> tuple[DataFrame, int]:
    """``df`` written, and its rows; row rules are counted by the writing tasks and stop the plan."""
    staged, figures = gathered_write(df, {"__rows": F.count(F.lit(1)), **Q.gathered(rules, key)})
    Q.enforce_gathered(rules, figures)
    return staged, figures["__rows"]


def clean_projects(df: DataFrame) -> Cleaned:
    """Project announcements: exact copies go, same-page variants are reported, casts never lose a value."""
    raw = cols.drop_derived(df, "description_clean")
    content = [c for c in raw.columns if c != "project_id"]
    by_url = duplicate_counts(raw, {"url": ["source_url"]}).first()
    unique = dedup_except_id(raw, "project_id")
    dated, raw_date = cols.to_date_checked(unique, "date_reported")
    typed, raw_amount = cols.to_number_checked(dated, "funding_amount_zmw")
    judged = cols.standardize_categories(typed, ["sector"]).withColumn("status", V.fill_category(F.col("status")))
    staged, kept = _gated(judged, [
        Q.no_cast_loss("date is a date", raw_date, "date_reported"),
        Q.no_cast_loss("amount is a number", raw_amount, "funding_amount_zmw"),
        Q.positive("amount is positive", "funding_amount_zmw"),
        Q.allowed("known status", "status", STATUS_VALUES),
        Q.allowed("known sector", "sector", SECTOR_VALUES),
        Q.present("source is named", "source_url"),
    ], "project_id")
    table = staged.drop(raw_date, raw_amount)
    review = keep_flagged(table, ["source_url", "project_name"])
    fences = iqr_fences(table, ["funding_amount_zmw"])
    flagged = flag_outliers(table, ["funding_amount_zmw"], fences=fences).filter("is_outlier").select(
        "project_id", "project_name", "funding_amount_zmw", "source_url"
    )
    clean = table.select(*["project_id", *content]).withColumn("description_clean", clean_text(F.col("description")))
    details = {**_sizes(by_url.rows, kept), "repeated_url_rows": by_url.surplus,
               "near_duplicate_rows": review.count(), "outliers": flagged.count()}
    return Cleaned(clean, details, review, fences, flagged, "project_id", details["outliers"])


def clean_posts(df: DataFrame) -> Cleaned:
    """Source articles: exact copies go, different contents of one URL are reported."""
    raw = cols.drop_derived(df, "body_text_clean")
    by_url = duplicate_counts(raw, {"url": ["url"]}).first()
    dated, raw_date = cols.to_date_checked(raw.distinct(), "date")
    staged, kept = _gated(dated, [
        Q.no_cast_loss("date is a date", raw_date, "date"), Q.present("source is named", "url"),
    ], "url")
    table = staged.drop(raw_date)
    review = keep_flagged(table, ["url"])
    clean = table.withColumn("body_text_clean", clean_text(F.col("body_text")))
    details = {**_sizes(by_url.rows, kept), "repeated_url_rows": by_url.surplus,
               "near_duplicate_rows": review.count(), "outliers": None}
    return Cleaned(clean, details, review)


def clean_contacts(df: DataFrame, mode: str = "strict", order: str | Sequence[str] = "record_id") -> Cleaned:
    """Contact records.

    ``script`` keeps the first row of a URL and removes rows without one; ``strict`` refuses
    different rows of one URL, missing sources and malformed e-mail addresses.
    """
    if mode == "script":
        Q.required_columns(df, CONTACT_COLUMNS)
        counts = {r.key_set: r for r in duplicate_counts(df, {"exact": df.columns, "url": ["source_url"]}).collect()}
        table = df.select(*CONTACT_COLUMNS)
        tidy = cols.normalize_text(table, blank=True, keep=["record_id"])
        tidy = tidy.withColumns({"phone": V.normalize_phone(F.col("phone")), "email": V.normalize_email(F.col("email"))})
        unique = written(dedup_keep_first(tidy, "source_url", order))
        clean = cols.drop_untraceable(unique, "source_url")
        first, kept = unique.count(), clean.count()
        blanks = {f"blank {r.column}": r.missing for r in missing_counts(clean, blank=True).collect()}
        before = counts["exact"].rows
        details = {"input_rows": before, "exact_duplicates": counts["exact"].surplus,
                   "duplicate_sources": counts["url"].surplus,
                   "removed_for_duplicate_url": before - first, "removed_for_missing_url": first - kept,
                   "output_rows": kept, **blanks}
        return Cleaned(clean, details, id_col="record_id")
    if mode != "strict":
        raise ValueError(f"unknown mode: {mode}")
    tidy, seen = gathered_write(cols.normalize_text(df), {"rows": F.count(F.lit(1))})
    unique = dedup_by_url_checked(tidy, "source_url", order, "record_id")
    clean, kept = _gated(unique.withColumns({
        "email": V.normalize_email(F.col("email")), "phone": collapse_space(F.col("phone")),
    }), [
        Q.email_form("e-mail form", "email"), Q.web_url("source is a web address", "source_url"),
        Q.present("id is present", "record_id"),
    ], "record_id")
    Q.enforce(Q.validate(clean, [Q.unique("id is unique", "record_id")], "record_id"))
    Q.same_columns(clean, df.columns)
    return Cleaned(clean, _sizes(seen["rows"], kept), id_col="record_id")


def clean_profile(df: DataFrame, mode: str = "strict", stopwords: Sequence[str] = (*STOPWORDS, "not")) -> Cleaned:
    """District observations.

    ``strict`` stops on conflicting observations, lost or impossible counts and fences crossed
    within a level. ``lax`` keeps the first row of an observation, reports fences over the whole
    table and adds ``notes_clean``.
    """
    observation = ["name", "level", "population_year"]
    rows = {"rows": F.count(F.lit(1))}
    if mode == "lax":
        read, first = gathered_write(df, rows)
        unique, seen = gathered_write(dedup_keep_first(read, observation, "record_id"), {**rows, **missing_figures(df)})
        measures = ["population", "area_km2"]
        numeric = unique.withColumns({m: V.to_number(F.col(m)) for m in measures})
        fences = iqr_fences(numeric, measures)
        flagged = flag_outliers(numeric, measures, fences=fences).filter("is_outlier")
        clean = numeric.withColumn("notes_clean", clean_text_punct(F.col("notes"), stopwords))
        clean = cols.standardize_categories(clean, ["status", "sector", "level"])
        gaps = {f"missing {c}": seen[f"__missing {c}"] for c in df.columns if seen[f"__missing {c}"]}
        details = {**_sizes(first["rows"], seen["rows"]), "outliers": flagged.count(), **gaps}
        return Cleaned(clean, details, fences=fences, flagged=flagged, id_col="record_id")
    if mode != "strict":
        raise ValueError(f"unknown mode: {mode}")
    # Staged, as the removal of copies reads the rows twice.
    tidy, first = gathered_write(cols.standardize_categories(cols.normalize_text(df), ["level"]), rows)
    typed, raws = dedup_except_id(tidy, "record_id"), {}
    for c in PROFILE_COUNTS:
        typed, raws[c] = cols.to_number_checked(typed, c, "double")
    typed, raws["area_km2"] = cols.to_number_checked(typed, "area_km2")
    rules = [Q.no_cast_loss(f"{c} is a number", raw, c) for c, raw in raws.items()]
    rules += [Q.not_negative(f"{c} is not negative", c) for c in raws]
    rules += [Q.whole(f"{c} is whole", c) for c in PROFILE_COUNTS]
    rules += [
        Q.requires("a population has its year", "population", "population_year"),
        Q.allowed("known level", "level", LEVEL_VALUES),
        Q.adds_up("sexes add up", ["population_male", "population_female"], "population"),
        Q.web_url("source is a web address", "source_url"),
        Q.present("id is present", "record_id"),
    ]
    staged, figures = gathered_write(typed, {"__rows": F.count(F.lit(1)), **Q.gathered(rules, "record_id")})
    refuse_repeated(staged.select("name", "level", F.col(raws["population_year"]).alias("population_year")),
                    observation, "one observation per unit and year")
    Q.enforce_gathered(rules, figures)
    Q.enforce(Q.validate(staged, [Q.unique("id is unique", "record_id")], "record_id"))
    clean = staged.withColumns({c: F.col(c).cast("bigint") for c in PROFILE_COUNTS}).select(*df.columns)
    fences = written(iqr_fences(clean, list(PROFILE_MEASURES), ["level"]))
    gate_outliers(clean, list(PROFILE_MEASURES), "record_id", ["level"], fences)
    return Cleaned(clean, {**_sizes(first["rows"], figures["__rows"]), "outliers": 0}, fences=fences, id_col="record_id", outliers=0)


def publish(tables: dict[str, Cleaned]) -> dict[str, bool]:
    """Export cleaned tables by path; none is written while any still has values to review.

    Returns which exports changed. Each export is read back and compared before it replaces the old one.
    """
    waiting = [(path, t.outliers, None) for path, t in tables.items() if t.outliers]
    if waiting:
        raise Q.GateError(waiting)
    return {path: write_if_changed(table.clean, path) for path, table in tables.items()}
