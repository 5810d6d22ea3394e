"""Registry of queries and the SQL fragments they share."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from trailkeep.session import shared_folder

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def scratch(spark: SparkSession) -> str:
    """A new path in the shared folder."""
    return f"{shared_folder(spark).rstrip('/')}/contract-{uuid.uuid4().hex}"


# --- SQL fragments (RE2 knows no look-around and no back reference) ------------------------------

WS = r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
WORD = r"[\p{L}\p{N}_]"


def q(text: str) -> str:
    """A SQL string literal."""
    return "'" + text.replace("'", "''") + "'"


def sql_strip(x: str) -> str:
    return f"regexp_replace({x}, {q(f'^{WS}+|{WS}+$')}, '', 'g')"


def sql_collapse(x: str) -> str:
    return f"trim(regexp_replace({x}, {q(WS + '+')}, ' ', 'g'))"


def sql_clean_space(x: str) -> str:
    return sql_collapse(f"replace({x}, '|', '/')")


def sql_unescape(x: str) -> str:
    """The references that occur in the page table; the ampersand last keeps it a single pass."""
    for name, char in (("copy", "©"), ("middot", "·"), ("quot", '"'), ("lt", "<"), ("gt", ">"), ("amp", "&")):
        x = f"regexp_replace({x}, '&{name};?', {q(char)}, 'g')"
    return x


def sql_strip_html(x: str) -> str:
    hidden = "|".join(rf"<{t}\b[^>]*>.*?</{t}>" for t in ("script", "style", "noscript", "svg"))
    shown = f"regexp_replace({x}, {q('(?is)' + hidden)}, ' ', 'g')"
    return sql_clean_space(sql_unescape(f"regexp_replace({shown}, '<[^>]+>', ' ', 'g')"))


def sql_strip_plain(x: str, district: bool = False) -> str:
    hidden = "|".join(rf"<{t}.*?>.*?</{t}>" for t in ("script", "style", "noscript"))
    text = f"regexp_replace(regexp_replace({x}, {q('(?is)' + hidden)}, ' ', 'g'), '<[^>]+>', ' ', 'g')"
    if district:
        text = f"regexp_replace({text}, '(?i)&#8211;|&ndash;', '-', 'g')"
    return sql_collapse(f"regexp_replace({text}, '(?i)&nbsp;', ' ', 'g')")


H1 = r"""(?is)<h1[^>]*class=["'][^"']*entry-title[^"']*["'][^>]*>(.*?)</h1>"""
OG = r"""(?is)<meta[^>]+property=["']og:title["'][^>]+content=["'](.*?)["']"""
TITLE = r"(?is)<title[^>]*>(.*?)</title>"
CONTAINERS = (
    r"(?is)<article\b[^>]*>(.*?)</article>",
    r"(?is)<main\b[^>]*>(.*?)</main>",
    r"""(?is)<div[^>]*class=["'][^"']*entry-content[^"']*["'][^>]*>(.*?)</div>\s*</div>""",
    r"(?is)<body\b[^>]*>(.*?)</body>",
)


def sql_first_capture(x: str, patterns, otherwise: str) -> str:
    whens = " ".join(f"WHEN regexp_matches({x}, {q(p)}) THEN regexp_extract({x}, {q(p)}, 1)" for p in patterns)
    return f"CASE {whens} ELSE {otherwise} END"


def sql_title(x: str, site: str | None = None) -> str:
    title = sql_strip_html(sql_first_capture(x, (H1, OG, TITLE), "''"))
    if site:
        pattern = rf"(?i)\s*[-–—|]\s*{site}\s*$"
        title = sql_clean_space(f"regexp_replace({title}, {q(pattern)}, '')")
    return title


def sql_article(x: str) -> str:
    return sql_first_capture(x, CONTAINERS, x)


def sql_paragraphs(x: str) -> str:
    """List of readable paragraphs of an article, without the whole-article fallback."""
    pieces = f"regexp_extract_all({x}, {q(r'(?is)<p[^>]*>(.*?)</p>'.replace('<p', '<p' + chr(92) + 'b'))}, 1)"
    return f"list_filter(list_transform({pieces}, lambda p: {sql_strip_html('p')}), lambda p: length(p) >= 25)"


def sql_body(source: str, site: str | None = None, extra: str = "") -> str:
    """CTE chain ending in ``bodies(url, title, html, paras, body_text)`` over ``source(url, html)``."""
    return f"""
    a AS (SELECT *, {sql_article('html')} AS article FROM {source}),
    b AS (SELECT *, {sql_paragraphs('article')} AS found, {sql_strip_html('article')} AS whole FROM a),
    bodies AS (
      SELECT * EXCLUDE (found, whole, article), {sql_title('html', site)} AS title,
             CASE WHEN len(found) > 0 THEN found WHEN whole <> '' THEN [whole] ELSE [] END AS paras,
             {sql_clean_space("array_to_string(CASE WHEN len(found) > 0 THEN found WHEN whole <> '' THEN [whole] ELSE [] END, ' ')")} AS body_text
      FROM b)"""


def sql_distinct_list(x: str) -> str:
    """Distinct entries in order of appearance."""
    return f"list_filter({x}, lambda e, i: list_position({x}, e) = i)"


def sql_any(x: str, terms) -> str:
    return "(" + " OR ".join(f"contains({x}, {q(t)})" for t in terms) + ")"


def sql_word(x: str, alternatives: str, flags: str = "(?i)") -> str:
    """Whether any alternative occurs as whole words."""
    return f"regexp_matches({x}, {q(f'{flags}(^|[^{WORD[1:-1]}])(?:{alternatives})($|[^{WORD[1:-1]}])')})"


def sql_iqr(relation: str, value: str, by: str = "") -> str:
    """Fences of one measure, per group if ``by`` names columns."""
    lead = f"{by}, " if by else ""
    tail = f" GROUP BY {by}" if by else ""
    return f"""SELECT {lead}count({value}) AS n, quantile_cont({value}::DOUBLE, 0.25) AS q1,
      quantile_cont({value}::DOUBLE, 0.75) AS q3 FROM {relation}{tail}"""
