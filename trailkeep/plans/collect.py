"""Page tables to records: projects, contacts and the district profile."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trailkeep.functions.extract import extract_contact_title, same_site
from trailkeep.functions.text import clean_space, strip_html
from trailkeep.operators import pages as P
from trailkeep.operators.columns import align_to_schema, text_columns
from trailkeep.operators.dedup import dedup_keep_first, dedup_last_wins
from trailkeep.operators.joins import apply_review
from trailkeep.operators.order import assign_ids, assign_missing_ids, union_records
from trailkeep.operators.quality import RowRule, quarantine
from trailkeep.rules import CONTACT_COLUMNS, PROFILE_COLUMNS, PROJECT_COLUMNS, FactTemplate, SiteRules
from trailkeep.session import written

CONTACT_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in CONTACT_COLUMNS])
PROFILE_SCHEMA = T.StructType([
    T.StructField(c, {"area_km2": T.DoubleType()}.get(
        c, T.LongType() if c.startswith("population") or c == "households" else T.StringType()))
    for c in PROFILE_COLUMNS
])
RECORD_ORDER = ("date_reported", "source_url", "project_name")


class Collection(NamedTuple):
    records: DataFrame
    posts: DataFrame
    rejects: DataFrame


def finalize_records(candidates: DataFrame, id_format: str, order: Sequence[str] = ()) -> DataFrame:
    """Clean text, one row per (source, name, description), sorted, numbered.

    Units of two saved copies of a page may tie: the copy first in ``order`` gives the row, then the other columns decide.
    """
    tidy = candidates.withColumns({c: clean_space(F.col(c)) for c in text_columns(candidates)})
    key = ["source_url", "project_name", "description"]
    others = [c for c in tidy.columns if c not in key and c != "unit_no" and c not in order]
    unique = dedup_keep_first(tidy, key, ["unit_no", *order, *others], derived=True)
    # The description settles the order of records that agree in date, source and name.
    place = [*RECORD_ORDER, "description"]
    return assign_ids(unique.drop("unit_no", *order), place, id_format, "project_id").select(*PROJECT_COLUMNS)


def admit_pages(pages: DataFrame, rules: SiteRules, limit_to_site: bool = True,
                keep: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """(usable pages, rejects): pages outside the site or without content go aside with the reason."""
    checks = [RowRule("no page content", F.coalesce(F.trim("html"), F.lit("")) == "")]
    if limit_to_site:
        on_site = F.coalesce(same_site(F.col("url"), F.lit(rules.base_url)), F.lit(False))
        checks.insert(0, RowRule("outside the site", ~on_site))
    good, rejects = quarantine(pages.select("url", "html", *keep), checks)
    return good, rejects.select(F.col("url").alias("source_url"), "error")


def collect_records(pages: DataFrame, rules: SiteRules, limit_to_site: bool = True, order: str | None = None) -> Collection:
    """Project records, the evidence table, and the pages that could not be used with the reason.

    ``pages`` holds one row per (url, html). Where copies of a page give the same record with other details, such as
    another date, the copy first by the column ``order`` counts (without it the smaller details).
    """
    seq = [order] if order else []
    good, rejects = admit_pages(pages, rules, limit_to_site, seq)
    records = finalize_records(P.pages_to_records(good, rules, seq), f"{rules.id_prefix}%03d", seq)
    return Collection(records, P.pages_to_posts(good, rules.site_name), rejects)


def build_reviewed(decisions: DataFrame, posts: DataFrame, id_prefix: str = "REC-",
                   funding_source: str = "CDF") -> DataFrame:
    """Review decisions (post_id, name, sector, place, amount, status, summary) with date and link of their post."""
    evidence = posts.select(F.col("id").alias("post_id"), F.col("date").alias("date_reported"), F.col("link").alias("source_url"))
    reviewed = apply_review(decisions, evidence, "post_id", ["date_reported", "source_url"]).select(
        F.col("name").alias("project_name"), "sector", F.col("place").alias("constituency"),
        F.lit(funding_source).alias("funding_source"), F.col("amount").alias("funding_amount_zmw"), "status",
        "date_reported", F.col("summary").alias("description"), "source_url",
    )
    first = [*RECORD_ORDER, "description"]
    order = [*first, *[c for c in reviewed.columns if c not in first]]
    return assign_ids(reviewed, order, f"{id_prefix}%03d", "project_id").select(*PROJECT_COLUMNS)


def collect_contacts(pages: DataFrame, manual: DataFrame | None = None, order: str = "page_id",
                     site_name: str | None = None, id_prefix: str = "REC-") -> DataFrame:
    """Contact records of pages (url, html, order), then hand-made ones; a later equal contact wins.

    ``manual`` may lack columns; its rows are ordered by their own ``order`` column.
    """
    texts = pages.select(
        F.col(order).alias("__seq"), F.col("url").alias("source_url"),
        strip_html(F.col("html"), "contact").alias("text"),
        extract_contact_title(F.col("html"), F.col("url"), site_name).alias("source_page"),
    )
    found = P.extract_contacts(texts, keep=["__seq"]).withColumn("__src", F.lit(0))
    parts = [found]
    if manual is not None:
        seq = F.col(order).cast(found.schema["__seq"].dataType)
        parts.append(align_to_schema(manual.withColumn("__seq", seq), T.StructType(
            [*CONTACT_SCHEMA.fields, found.schema["__seq"]])).withColumn("__src", F.lit(1)))
    last = dedup_last_wins(union_records(*parts), ["source_url", "email", "phone"], ["__src", "__seq"], "__pos")
    numbered = assign_missing_ids(last, ["__pos"], f"{id_prefix}%03d")
    return numbered.select(*CONTACT_COLUMNS)


def collect_profile(pages: DataFrame, templates: Sequence[FactTemplate], unit: str, country: str,
                    neighbours: Sequence[str], mentions: dict[str, dict[str, str]] | None = None,
                    last_note: str | None = None, last_source: str | None = None, order: str = "page_id",
                    id_prefix: str = "REC-") -> DataFrame:
    """Profile rows of pages (url, html, order): template facts, then constant rows for named units.

    Texts and rows are staged: each part reads the texts, and the range sort behind the ids reads the rows twice.
    """
    texts = written(pages.select(F.col(order).alias("__seq"), "url", strip_html(F.col("html"), "district").alias("text")))
    facts = P.extract_facts(texts, templates, unit, country, neighbours, last_note, last_source, keep=["__seq"])
    parts = [facts.withColumn("__kind", F.lit(0)).withColumnRenamed("template", "__part")]
    schema = T.StructType([*PROFILE_SCHEMA.fields, texts.schema["__seq"]])
    for i, (term, constants) in enumerate((mentions or {}).items(), start=1):
        rows = P.emit_if_mentioned(texts, term, constants, schema, keep=["__seq"])
        parts.append(rows.withColumns({"__kind": F.lit(i), "__part": F.lit(0)}))
    return assign_ids(written(union_records(*parts)), ["__kind", "__seq", "__part"], f"{id_prefix}%03d").select(*PROFILE_COLUMNS)
