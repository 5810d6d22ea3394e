"""A table of saved pages (url, html) turned into paragraphs, units, links, contacts, facts and records.

All of it is per page: projections and generators without a shuffle; only links of pages saved more than once meet.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from trailkeep.functions import classify as C
from trailkeep.functions import extract as X
from trailkeep.functions.text import blank_to_null, clean_space, html_unescape, strip_html
from trailkeep.functions.values import parse_grouped_int
from trailkeep.operators.dedup import repeated_keys
from trailkeep.operators.skew import lookup_join
from trailkeep.rules import CONTACT_COLUMNS, CONTACT_MENU, PROFILE_COLUMNS, PROJECT_COLUMNS, FactTemplate, SiteRules
from trailkeep.session import checkpointed


def filter_once(df: DataFrame, condition: Column) -> DataFrame:
    """A filter on computed columns that the optimizer does not push through their computation.

    A pushed filter would carry the whole extraction in its condition and every page would be parsed
    twice. Generators are not crossed, so the condition becomes the input of one.
    """
    kept = df.select("*", F.explode_outer(F.when(condition, F.array(F.lit(True)))).alias("__kept"))
    return kept.filter(F.col("__kept").isNotNull()).drop("__kept")


def _numbered(df: DataFrame, columns: Sequence[str | Column], array: str, pos: str, item: str) -> DataFrame:
    """One row per entry of an array column. The plain generator would add a size filter on the array,
    which the optimizer pushes through its computation."""
    rows = df.select(*columns, F.posexplode_outer(array).alias(pos, item))
    return rows.filter(F.col(pos).isNotNull())


def with_paragraphs(pages: DataFrame, html: str = "html", out: str = "paragraphs") -> DataFrame:
    """Readable paragraphs of the main article as an array; the whole article if it has none."""
    found = pages.withColumn("__article", X.extract_article(F.col(html)))
    found = found.withColumn("__found", X.paragraph_texts(F.col("__article")))
    whole = F.when(F.size("__found") == 0, strip_html(F.col("__article")))
    found = found.withColumn("__whole", whole)
    texts = F.when(F.size("__found") > 0, F.col("__found")).when(F.col("__whole") != "", F.array("__whole"))
    return found.withColumn(out, F.coalesce(texts, F.array().cast("array<string>"))).drop(
        "__article", "__found", "__whole"
    )


def paragraphs(pages: DataFrame, key: str = "url", html: str = "html") -> DataFrame:
    """(key, pos, paragraph) in page order, positions from 0."""
    return _numbered(with_paragraphs(pages.select(key, html), html), [key], "paragraphs", "pos", "paragraph")


def with_body(pages: DataFrame, site_name: str | None = None, html: str = "html") -> DataFrame:
    """Title, date, paragraphs and running text of each page; the page source is dropped."""
    found = with_paragraphs(pages, html)
    return found.select(
        *[c for c in found.columns if c != html],
        X.extract_title(F.col(html), site_name).alias("title"),
        X.extract_date(F.col(html)).alias("date"),
        clean_space(F.array_join("paragraphs", " ")).alias("body_text"),
    )


def pages_to_posts(pages: DataFrame, site_name: str | None = None) -> DataFrame:
    """The evidence table: (title, date, body_text, url)."""
    return with_body(pages.select("url", "html"), site_name).select("title", "date", "body_text", "url")


def record_units(bodies: DataFrame, rules: SiteRules | None = None, relevant: Column | None = None) -> DataFrame:
    """One row per record-like paragraph: the columns of ``bodies`` plus unit_no, unit, multiple.

    Needs ``paragraphs``, ``body_text`` and ``title``. Repeated paragraphs of a page count once; a
    page without any record-like paragraph is one unit: its text, or its title. Pages that are not
    ``relevant`` give no units.
    """
    rules = rules or SiteRules("")
    kept = F.filter("paragraphs", lambda p: C.is_record_unit(p, rules.action_terms, rules.sector_terms, rules.boilerplate))
    chosen = bodies.withColumn("__units", F.array_distinct(kept) if relevant is None else F.when(relevant, F.array_distinct(kept)))
    fallback = F.array(F.coalesce(blank_to_null(F.col("body_text")), F.col("title")))
    chosen = chosen.withColumn("__units", F.when(F.size("__units") == 0, fallback).otherwise(F.col("__units")))
    columns = [c for c in bodies.columns if c != "paragraphs"]
    return _numbered(chosen, [*columns, (F.size("__units") > 1).alias("multiple")], "__units", "unit_no", "unit")


def pages_to_records(pages: DataFrame, rules: SiteRules, keep: Sequence[str] = ()) -> DataFrame:
    """Candidate project records, without ids, and the page's ``keep``. Sector, amount and status come from the unit alone."""
    about = C.is_relevant(F.col("title"), F.col("body_text"), rules.topic, rules.action_terms)
    units = record_units(with_body(pages.select("url", "html", *keep), rules.site_name), rules, about)
    unit, title = F.col("unit"), F.col("title")
    evidence = clean_space(F.concat(title, F.lit(". "), unit))
    place = F.coalesce(C.classify_regex(unit, rules.places), C.classify_regex(evidence, rules.places))
    return units.select(
        F.lit(None).cast("string").alias("project_id"),
        X.make_name(unit, title, F.col("multiple")).alias("project_name"),
        C.classify_keywords(unit, rules.sector_terms).alias("sector"),
        place.alias("constituency"),
        C.classify_funding(evidence).alias("funding_source"),
        X.extract_amount(unit).alias("funding_amount_zmw"),
        C.infer_status(unit).alias("status"),
        F.col("date").alias("date_reported"),
        X.make_description(unit).alias("description"),
        F.col("url").alias("source_url"),
        "unit_no", *keep,
    ).select(*PROJECT_COLUMNS, "unit_no", *keep)


# --- links ------------------------------------------------------------------------------------


def extract_links(pages: DataFrame, base_url: str | None = None, slug_words: Sequence[str] = (),
                  record_like: bool = True, html: str = "html") -> DataFrame:
    """(url, pos, target): links of the article blocks if there are any, else of the page.

    Resolved against the page, same site only (``base_url``, or the page's own site), first
    occurrence per URL; ``record_like`` keeps those that look like records.
    """
    blocks = F.regexp_extract_all(F.col(html), F.lit(X.ARTICLE_BLOCK), F.lit(0))
    area = F.when(F.size(blocks) > 0, F.array_join(blocks, "\n")).otherwise(F.col(html))
    hrefs = F.array_distinct(F.regexp_extract_all("__area", F.lit(X.LINK), F.lit(1)))
    site = F.lit(base_url) if base_url else F.col("url")

    def kept(target: Column) -> Column:
        on_site = X.same_site(target, site)
        return on_site & C.looks_like_record_url(target, slug_words) if record_like else on_site

    # Resolved and filtered inside the array: each link once, nothing shuffled.
    areas = pages.select("url", area.alias("__area"))
    return _per_page(areas, F.transform(hrefs, html_unescape), lambda h: X.resolve_url(F.col("url"), h), kept)


def contact_links(pages: DataFrame, menu: Sequence[str] = CONTACT_MENU, html: str = "html") -> DataFrame:
    """(url, pos, target): links whose label or address names a contact page, same site only."""
    tags = F.array_distinct(F.regexp_extract_all(F.col(html), F.lit(X.LABELLED_LINK), F.lit(0)))

    def named(tag: Column) -> Column:
        label = F.lower(strip_html(F.regexp_extract(tag, X.LINK_LABEL, 1), "contact"))
        return C.mentions_any(label, menu) | C.mentions_any(F.lower(F.regexp_extract(tag, X.LABELLED_LINK, 1)), menu)

    def target(tag: Column) -> Column:
        href = F.regexp_extract(tag, X.LABELLED_LINK, 1)
        return F.concat(X.resolve_url(F.col("url"), F.regexp_replace(href, "#.*", "")), F.regexp_extract(href, "#.*", 0))

    return _per_page(pages, F.filter(tags, named), target, lambda t: X.same_site(t, F.col("url")))


def _per_page(pages: DataFrame, found: Column, target: Callable[[Column], Column],
              kept: Callable[[Column], Column]) -> DataFrame:
    """(url, pos, target): targets of the found items, distinct and in order within their page.

    Rows of one URL are copies of one page: a target counts once, at its first place in any copy; equal places by target.
    """
    def listed(part: DataFrame) -> DataFrame:
        return part.select("url", found.alias("__found")).select("url", F.transform("__found", lambda x: target(x)).alias("__targets"))

    def single(part: DataFrame) -> DataFrame:
        own = listed(part).select("url", F.array_distinct(F.filter("__targets", lambda x: kept(x))).alias("__targets"))
        return _numbered(own, ["url"], "__targets", "pos", "target")

    several = checkpointed(repeated_keys(pages.select("url"), "url").drop("rows"))
    if several.isEmpty():
        return single(pages)
    each = _numbered(listed(lookup_join(pages, several, ["url"], "left_semi")), ["url"], "__targets", "pos", "target")
    firsts = each.filter(kept(F.col("target"))).groupBy("url", "target").agg(F.min("pos").alias("pos"))
    place = F.row_number().over(Window.partitionBy("url").orderBy("pos", "target")) - 1
    merged = firsts.select("url", place.alias("pos"), "target")
    return single(lookup_join(pages, several, ["url"], "left_anti")).unionByName(merged)


# --- contacts ---------------------------------------------------------------------------------


def extract_contacts(texts: DataFrame, text: str = "text", page: str = "source_page",
                     url: str = "source_url", keep: Sequence[str] = ()) -> DataFrame:
    """Contact records: one per text that holds an e-mail address or a phone number."""
    found = texts.withColumns({"__emails": X.extract_emails(F.col(text)), "__phones": X.extract_phones(F.col(text))})
    found = filter_once(found, (F.size("__emails") > 0) | (F.size("__phones") > 0))
    blank = F.lit(None).cast("string")
    return found.select(
        blank.alias("record_id"), blank.alias("name"), blank.alias("role_title"), blank.alias("department"),
        blank_to_null(F.array_join("__phones", "; ")).alias("phone"),
        blank_to_null(F.array_join("__emails", "; ")).alias("email"),
        blank_to_null(X.extract_address(F.col(text))).alias("office_address"),
        F.col(page).alias("source_page"), F.col(url).alias("source_url"), *keep,
    ).select(*CONTACT_COLUMNS, *keep)


# --- facts ------------------------------------------------------------------------------------


def _java(pattern: str) -> str:
    """The template's pattern with digits, words and blanks of any script."""
    return pattern.replace(r"\W", r"[^\p{L}\p{N}_]").replace(r"\w", r"[\p{L}\p{N}_]")


def extract_area(text: Column) -> Column:
    found = F.regexp_extract(text, r"(?i)total land area of ([\d,]+) square kilomet", 1)
    return parse_grouped_int(blank_to_null(found)).cast("double")


def extract_province(text: Column, country: str) -> Column:
    pattern = _java(rf"(?iu){country}\W?s (\w+) Province")
    return blank_to_null(F.regexp_extract(text, pattern, 1))


def extract_neighbours(text: Column, candidates: Sequence[str]) -> Column:
    """Those candidates the boundaries sentence names, or the whole text if there is no such sentence."""
    window = F.coalesce(F.regexp_substr(text, F.lit(r"(?i)boundaries with[^.]*\.")), text)
    named = F.array(*[F.when(F.contains(window, F.lit(c)), F.lit(c)) for c in candidates])
    return blank_to_null(F.array_join(named, ";"))


def extract_facts(pages: DataFrame, templates: Sequence[FactTemplate], unit: str, country: str,
                  neighbours: Sequence[str], last_note: str | None = None,
                  last_source: str | None = None, text: str = "text",
                  keep: Sequence[str] = ()) -> DataFrame:
    """One profile row per template sentence a page holds, in template order, without ids.

    ``last_note`` and ``last_source`` go to the last row of a page. Needs (url, text).
    """
    def cell(t: FactTemplate, name: str) -> Column:
        source = t.fields.get(name)
        if source is None:
            return F.lit(None).cast("bigint")
        if isinstance(source, str):
            return F.lit(int(source)).cast("bigint")
        return parse_grouped_int(F.regexp_extract(text, _java(t.pattern), source))

    def note(t: FactTemplate) -> Column:
        if t.remark is None:
            return F.lit(t.note)
        pattern, words = t.remark
        value = F.regexp_extract(text, pattern, 1)
        head, tail = words.split("{}")
        return F.concat(F.lit(t.note), F.when(value != "", F.concat(F.lit(head), value, F.lit(tail))).otherwise(""))

    counts = ("population", "population_year", "population_male", "population_female", "households")
    hits = F.array(*[
        F.when(F.col(text).rlike(_java(t.pattern)), F.struct(
            F.lit(i).alias("template"), *[cell(t, c).alias(c) for c in counts], note(t).alias("note")
        )) for i, t in enumerate(templates)
    ])
    hit_pages = pages.select("url", text, *keep, F.filter(hits, lambda h: h.isNotNull()).alias("__hits"))
    shared = _numbered(hit_pages, [
        "url", *keep, F.size("__hits").alias("__count"),
        extract_area(F.col(text)).alias("area_km2"),
        extract_province(F.col(text), country).alias("province"),
        extract_neighbours(F.col(text), neighbours).alias("neighboring_districts"),
    ], "__hits", "__pos", "__hit")
    last = F.col("__pos") == F.col("__count") - 1
    extra = F.when(last, F.lit(last_note or "")).otherwise("")
    return shared.select(
        F.lit(None).cast("string").alias("record_id"), F.lit("district").alias("level"), F.lit(unit).alias("name"),
        *[F.col(f"__hit.{c}").alias(c) for c in counts], "area_km2", "province", "neighboring_districts",
        F.concat(F.col("__hit.note"), extra).alias("notes"), F.col("url").alias("source_url"),
        F.when(last, F.lit(last_source).cast("string")).alias("secondary_source_url"),
        F.col("__hit.template").alias("template"), *keep,
    ).select(*PROFILE_COLUMNS, "template", *keep)


def emit_if_mentioned(pages: DataFrame, term: str, constants: dict[str, str], schema: T.StructType,
                      text: str = "text", keep: Sequence[str] = ()) -> DataFrame:
    """A constant reference row for each page that names the unit; measures stay missing."""
    named = filter_once(pages, F.contains(F.col(text), F.lit(term)))
    cells = {**{k: F.lit(v) for k, v in constants.items()}, "source_url": F.col("url"), **{k: F.col(k) for k in keep}}
    return named.select(*[cells.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in schema])
