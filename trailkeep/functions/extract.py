"""Fields of a saved web page and of the text units found in it."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from trailkeep.functions.text import SPACE, WORD, WORD_END, WORD_START, blank_to_null, clean_space, let, strip_html
from trailkeep.rules import AMOUNT_SUFFIXES, NAME_VERBS

# Where a page keeps its title, date, article, paragraphs and links.
TITLE_PATTERNS = (
    r"""(?is)<h1[^>]*class=["'][^"']*entry-title[^"']*["'][^>]*>(.*?)</h1>""",
    r"""(?is)<meta[^>]+property=["']og:title["'][^>]+content=["'](.*?)["']""",
    r"(?is)<title[^>]*>(.*?)</title>",
)
DATE_PATTERNS = (
    r"""(?is)<time[^>]+datetime=["']([0-9]{4}-[0-9]{2}-[0-9]{2})""",
    r"""(?is)<meta[^>]+property=["']article:published_time["'][^>]+content=["']([0-9]{4}-[0-9]{2}-[0-9]{2})""",
)
DATE_TEXT = r"(?i)published(?:\s+on)?\s+([a-z]+)\s+([0-9]{1,2}),?\s+([0-9]{4})"
ARTICLE_PATTERNS = (
    r"(?is)<article\b[^>]*>(.*?)</article>",
    r"(?is)<main\b[^>]*>(.*?)</main>",
    r"""(?is)<div[^>]*class=["'][^"']*entry-content[^"']*["'][^>]*>(.*?)</div>\s*</div>""",
    r"(?is)<body\b[^>]*>(.*?)</body>",
)
PARAGRAPH = r"(?is)<p\b[^>]*>(.*?)</p>"
ARTICLE_BLOCK = r"(?is)<article\b[^>]*>.*?</article>"
LINK = r"""(?is)<a\b[^>]+href=["']([^"'#]+)["']"""
LABELLED_LINK = r"""(?is)<a\b[^>]*href=["']([^"']+)["'][^>]*>.*?</a>"""
LINK_LABEL = r"""(?is)<a\b[^>]*href=["'][^"']+["'][^>]*>(.*?)</a>"""
MONTHS = (
    "january", "february", "march", "april", "may", "june", "july", "august", "september",
    "october", "november", "december", "jan", "feb", "mar", "apr", "jun", "jul", "aug", "sep",
    "sept", "oct", "nov", "dec",
)
# Contact points and amounts in running text.
EMAIL = rf"(?:(?<![\p{{L}}\p{{N}}_.+-])|\G)[\p{{L}}\p{{N}}_.+-]++@[\p{{L}}\p{{N}}_.-]+\.[A-Za-z]{{2,}}"
PHONE = rf"(?:\+?260(?:{SPACE}|-)?)?0\p{{Nd}}{{2}}(?:{SPACE}|-)?\p{{Nd}}{{3}}(?:{SPACE}|-)?\p{{Nd}}{{3,4}}"
ADDRESS = (
    r"(?i)(?:physical address|postal address|address)\s*[:\-]?\s*(.{10,180}?)"
    r"(?=\s+(?:phone|tel|email|e-mail)\b|\z)"
)
AMOUNT = (
    rf"(?iu){WORD_START}(?:ZMW|K){SPACE}*,?{SPACE}*([0-9][0-9,]*(?:\.[0-9]+)?){SPACE}*"
    rf"(thousand|million|billion|m|bn)?(?:(?<={WORD})(?!{WORD})|(?<!{WORD})(?={WORD}))"
)

MIN_PARAGRAPH = 25
MAX_NAME = 180
MAX_DESCRIPTION = 600


def _first_capture(col: Column, patterns: Sequence[str]) -> Column:
    """Capture 1 of the first pattern that matches, even if that capture is blank; null if none does."""
    return F.coalesce(*(F.get(F.regexp_extract_all(col, F.lit(p), F.lit(1)), F.lit(0)) for p in patterns))


def extract_title(html: Column, site_name: str | None = None) -> Column:
    """Entry heading, share title or page title, without the name of the site; ``''`` if none."""
    title = strip_html(_first_capture(html, TITLE_PATTERNS))
    if site_name:
        title = clean_space(F.regexp_replace(title, rf"(?iu)\s*[-–—|]\s*{re.escape(site_name)}\s*\z", ""))
    return F.coalesce(title, F.lit(""))


def extract_contact_title(html: Column, fallback: Column, site_name: str | None = None) -> Column:
    """Page title for contact records, or the fallback; anything after the site name goes too."""
    title = F.coalesce(strip_html(_first_capture(html, TITLE_PATTERNS[2:]), "contact"), fallback)
    if site_name:
        title = F.trim(F.regexp_replace(title, rf"(?iu)\s*[|:–—-]\s*{re.escape(site_name)}.*\z", ""))
    return title


def to_date(text: Column, pattern: str = "yyyy-MM-dd") -> Column:
    return F.try_to_timestamp(text, F.lit(pattern)).cast("date")


def extract_date(html: Column) -> Column:
    """Publication date from the markup, else from "published on Month D, YYYY"; null if none is valid."""
    def spoken(phrase: Column) -> Column:
        month = F.lower(F.regexp_extract(phrase, DATE_TEXT, 1))
        day = F.concat_ws(" ", F.left(month, F.lit(3)), F.regexp_extract(phrase, DATE_TEXT, 2),
                          F.regexp_extract(phrase, DATE_TEXT, 3))
        return F.when(month.isin(*MONTHS), to_date(day, "MMM d yyyy"))

    def dated(stated: Column) -> Column:
        in_text = let(F.regexp_extract(strip_html(html), DATE_TEXT, 0), spoken)
        return F.when(stated.isNotNull(), to_date(stated)).when(html.rlike("(?i)published"), in_text)

    return let(_first_capture(html, DATE_PATTERNS), dated)


def extract_article(html: Column) -> Column:
    """The main article without menus and footers; the whole page if no container is found."""
    return F.coalesce(_first_capture(html, ARTICLE_PATTERNS), html)


def paragraph_texts(article: Column) -> Column:
    """Readable paragraphs in page order, as an array."""
    pieces = F.regexp_extract_all(article, F.lit(PARAGRAPH), F.lit(1))
    return F.filter(F.transform(pieces, lambda p: strip_html(p)), lambda p: F.length(p) >= MIN_PARAGRAPH)


def extract_amount(text: Column, strict: bool = False) -> Column:
    """The one stated amount; null when there is none or more than one.

    ``strict`` also refuses a number that ends in a comma or is followed by one (``K 2, 887,051``).
    """
    hits = F.regexp_extract_all(text, F.lit(AMOUNT), F.lit(0))
    hit = F.when(F.size(hits) == 1, F.element_at(hits, 1))
    number = F.regexp_extract(hit, rf"([0-9][0-9,]*(?:\.[0-9]+)?){SPACE}*\p{{L}}*\z", 1)
    suffix = F.lower(F.regexp_extract(hit, rf"(?i)(thousand|million|billion|m|bn)\z", 1))
    factor = F.when(suffix == "", 1.0)
    for name, value in AMOUNT_SUFFIXES.items():
        factor = factor.when(suffix == name, value)
    amount = F.replace(number, F.lit(","), F.lit("")).try_cast("double") * factor
    if strict:
        broken = text.rlike(rf"(?iu){WORD_START}(?:ZMW|K){SPACE}*,?{SPACE}*[0-9][0-9,]*,{SPACE}*(?![0-9])")
        amount = F.when(~broken, amount)
    return amount


def make_name(unit: Column, title: Column, multiple: Column) -> Column:
    """Title of a single-record page, else the first action phrase of the unit, cut at a word."""
    verbs = "|".join(NAME_VERBS)
    phrase = F.regexp_substr(
        unit, F.lit(rf"(?iu){WORD_START}(?:{verbs}){WORD_END}[^.!?]{{0,{MAX_NAME}}}")
    )
    name = clean_space(F.regexp_extract(F.coalesce(phrase, unit), r"\A[^.;]*", 0))
    cut = F.left(name, F.lit(MAX_NAME - 3))
    short = F.concat(F.regexp_replace(cut, r" [^ ]*\z", ""), F.lit("..."))
    return F.when(~multiple & (title != ""), F.left(title, F.lit(MAX_NAME))).otherwise(
        F.when(F.length(name) > MAX_NAME, short).otherwise(name)
    )


def make_description(text: Column) -> Column:
    """The first two sentences, at most 600 characters."""
    sentences = F.split(clean_space(text), r"(?<=[.!?]) +", 3)
    return F.rtrim(F.left(F.array_join(F.slice(sentences, 1, 2), " "), F.lit(MAX_DESCRIPTION)))


def extract_emails(text: Column) -> Column:
    """Distinct e-mail addresses in order of appearance."""
    found = F.array_distinct(F.regexp_extract_all(text, F.lit(EMAIL), F.lit(0)))
    return F.when(F.contains(text, F.lit("@")), found).otherwise(F.array().cast("array<string>"))


def extract_phones(text: Column) -> Column:
    """Distinct phone numbers in order of appearance, white space collapsed, digits untouched."""
    runs = F.regexp_extract_all(text, F.lit(PHONE), F.lit(0))
    found = F.array_distinct(F.transform(runs, lambda x: F.trim(F.regexp_replace(x, f"{SPACE}+", " "))))
    return F.when(F.contains(text, F.lit("0")), found).otherwise(F.array().cast("array<string>"))


def extract_address(text: Column) -> Column:
    """What follows an address label, up to the next contact word; ``''`` if none."""
    return F.btrim(F.regexp_extract(text, ADDRESS, 1), F.lit(" .:-"))


# --- URLs -------------------------------------------------------------------------------------

_PARTS = r"^(?:([^:/?#]+):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?"


def url_host(url: Column) -> Column:
    """Lower-case host with port, one leading ``www.`` removed; ``''`` unless http or https."""
    return F.regexp_replace(F.lower(F.regexp_extract(url, r"(?i)^https?://([^/?#]*)", 1)), r"^www\.", "")


def url_path(url: Column) -> Column:
    return F.regexp_extract(url, _PARTS, 3)


def url_query(url: Column) -> Column:
    return F.regexp_extract(url, _PARTS, 4)


def query_id(url: Column) -> Column:
    """Value of the first non-blank ``p`` parameter; null if there is none."""
    raw = blank_to_null(F.regexp_extract(url_query(url), r"(?:^|&)p=([^&]+)", 1))
    return F.coalesce(F.try_url_decode(raw), raw)


def same_site(url: Column, base: Column) -> Column:
    host = url_host(url)
    return (host != "") & (host == url_host(base))


def url_token(url: Column, prefix: str = "post") -> Column:
    """Stable name of a saved page: post id or last path segment, unsafe characters replaced."""
    path = F.regexp_replace(F.btrim(url_path(url), F.lit("/")), r"\A.*/", "")
    segment = F.coalesce(blank_to_null(F.regexp_replace(path, ";.*", "")), F.lit("home"))
    token = F.regexp_replace(F.coalesce(query_id(url), segment), "[^A-Za-z0-9_-]+", "_")
    return F.concat(F.lit(f"{prefix}_"), F.left(token, F.lit(100)), F.lit(".html"))


def _remove_dots(segments: Column) -> Column:
    """Resolve ``.`` and ``..`` in an array of path segments."""
    resolved = F.aggregate(
        segments,
        F.array().cast("array<string>"),
        lambda done, part: F.when(part == "..", F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0))))
        .when(part == ".", done)
        .otherwise(F.array_append(done, part)),
    )
    closed = F.when(F.element_at(segments, -1).isin(".", ".."), F.array_append(resolved, F.lit("")))
    return F.coalesce(closed, resolved)


def resolve_url(base: Column, href: Column) -> Column:
    """Absolute form of a link (without fragment) found on the http or https page ``base``."""
    scheme = F.lower(F.regexp_extract(base, r"^([^:/?#]+):", 1))
    own_scheme = F.lower(F.regexp_extract(href, r"^([A-Za-z][A-Za-z0-9+.-]*):", 1))
    rest = F.when(own_scheme == "", href).otherwise(F.regexp_replace(href, r"^[^:]+:", ""))
    root = F.regexp_extract(base, r"^[^:/?#]+://[^/?#]*", 0)
    folder = F.coalesce(blank_to_null(F.regexp_extract(base, r"^[^:/?#]+://[^/?#]*(/[^?#]*/|/)", 1)), F.lit("/"))
    path = F.regexp_extract(rest, r"^[^?]*", 0)
    relative = F.regexp_replace(F.concat(folder, path), "/{2,}", "/")
    placed = F.when(F.startswith(path, F.lit("/")), path).otherwise(relative)
    tidy = F.when(placed.rlike(r"/\.\.?(?:/|\z)"), F.array_join(_remove_dots(F.split(placed, "/", -1)), "/")).otherwise(placed)
    rooted = F.regexp_replace(F.concat(F.lit("/"), tidy), r"\A/+", "/")
    return (
        F.when((own_scheme != "") & (own_scheme != scheme), href)
        .when(F.startswith(rest, F.lit("//")), F.concat(scheme, F.lit(":"), rest))
        .when(rest == "", F.regexp_extract(base, r"^[^#]*", 0))
        .when(path == "", F.concat(F.regexp_extract(base, r"^[^?#]*", 0), rest))
        .otherwise(F.concat(root, rooted, F.regexp_extract(rest, r"\?.*", 0)))
    )
