"""X, P, T: pages and texts turned into fields, links, contacts, facts and features."""

from __future__ import annotations

from pyspark.sql import functions as F

from contract.base import (
    H1, OG, TITLE, WORD, WS, q, query, sql_any, sql_article, sql_body, sql_clean_space, sql_collapse,
    sql_distinct_list, sql_first_capture, sql_paragraphs, sql_strip_html, sql_strip_plain, sql_title, table,
)
from trailkeep.functions import classify as C
from trailkeep.functions import extract as X
from trailkeep.functions import text as T
from trailkeep.operators import columns as cols
from trailkeep.operators import pages as P
from trailkeep.operators.joins import filter_admitted
from trailkeep.plans.collect import PROFILE_SCHEMA
from trailkeep.rules import PROFILE_COLUMNS, STOPWORDS, SiteRules, census_templates
from trailkeep.session import spread

# --- predicates ---------------------------------------------------------------------------------

HOST = "blog.tionsh.example.net"
SQL_HOST = r"regexp_replace(lower(regexp_extract(url, '(?i)^https?://([^/?#]*)', 1)), '^www\.', '')"


@query("p1_same_site", f"SELECT page_id, {SQL_HOST} AS host, {SQL_HOST} = '{HOST}' AS same_site FROM pages")
def on_site(spark, sf):
    return table(spark, sf, "pages").select(
        "page_id", X.url_host(F.col("url")).alias("host"),
        X.same_site(F.col("url"), F.lit(f"HTTPS://www.{HOST}/home")).alias("same_site"))


TOPIC = ("that", "les leaux")
ACTIONS = ("tion", "erth", "stionth")


@query("p2_is_relevant", f"""
    SELECT doc_id FROM documents
    WHERE {sql_any('lower(source || chr(32) || text)', ACTIONS)}
      AND regexp_matches(lower(source || ' ' || text), {q(f'(^|[^{WORD[1:-1]}])that($|[^{WORD[1:-1]}])|les leaux')})""")
def relevant_documents(spark, sf):
    return table(spark, sf, "documents").filter(
        C.is_relevant(F.col("source"), F.col("text"), TOPIC, ACTIONS)).select("doc_id")


URL_TAILS = ("", "/2024/news", "/category/x", "?p=17", "?p=&q=1", "?a=1&p=9#top", "/wp-content/cdf")
SQL_PATH = r"regexp_extract(u, '^[^:/?#]+://[^/?#]*([^?#]*)', 1)"


@query("p3_looks_like_record_url", f"""
    WITH v AS (SELECT page_id, regexp_replace(url, '[?#].*$', '') || t AS u
               FROM pages, unnest({list(URL_TAILS)!r}) AS tails(t))
    SELECT page_id, u AS variant,
           NOT {sql_any(f'lower({SQL_PATH})', ('/category/', '/tag/', '/author/', '/feed/', '/wp-content/'))}
           AND (regexp_matches(regexp_extract(u, '^[^?#]*[?]([^#]*)', 1), '(^|&)p=[^&]+')
                OR regexp_matches(lower({SQL_PATH}), '/20[0-9][0-9]/')
                OR {sql_any('lower(u)', ('spam', 'cheap'))}) AS record_like
    FROM v""")
def record_urls(spark, sf):
    tails = F.explode(F.array(*[F.lit(t) for t in URL_TAILS]))
    variants = table(spark, sf, "pages").select("page_id", F.regexp_replace("url", "[?#].*$", "").alias("u"), tails.alias("t"))
    variants = variants.select("page_id", F.concat("u", "t").alias("variant"))
    return variants.withColumn("record_like", C.looks_like_record_url(F.col("variant"), ("spam", "cheap")))


@query("p4_filter_admitted", f"""
    WITH hosts AS (SELECT DISTINCT {SQL_HOST} AS host FROM pages),
    rules AS (SELECT host, r.o, r.a, r.p FROM hosts, (VALUES (1, false, '/fr/'), (2, true, '/en/7'), (3, false, '/en/')) AS r(o, a, p)
              WHERE contains(host, 'th')),
    urls AS (SELECT page_id, url, {SQL_HOST} AS host, regexp_replace(url, '^[^:/?#]+://[^/?#]*|#.*', '', 'g') AS target FROM pages),
    hits AS (SELECT page_id, arg_min(a, o) AS allow FROM urls JOIN rules USING (host) WHERE starts_with(target, p) GROUP BY page_id)
    SELECT page_id, url FROM urls LEFT JOIN hits USING (page_id) WHERE coalesce(allow, true)""")
def admitted_pages(spark, sf):
    pages = table(spark, sf, "pages").select("page_id", "url")
    hosts = pages.select(X.url_host(F.col("url")).alias("host")).distinct().filter(F.contains("host", F.lit("th")))
    lines = [(1, False, "/fr/"), (2, True, "/en/7"), (3, False, "/en/")]
    rules = hosts.select("host", F.inline(F.array(*[
        F.struct(F.lit(o).alias("rule_order"), F.lit(a).alias("allow"), F.lit(p).alias("prefix")) for o, a, p in lines])))
    return filter_admitted(pages, rules)


@query("p5_drop_untraceable", "SELECT page_id FROM pages WHERE NOT contains(url, 'utm')")
def traceable_pages(spark, sf):
    pages = table(spark, sf, "pages").select("page_id", F.when(F.contains("url", F.lit("utm")), F.lit(" \t")).otherwise(F.col("url")).alias("url"))
    return cols.drop_untraceable(pages, "url").select("page_id")


@query("p6_select_output", "SELECT s_name, s_suppkey, s_nationkey FROM supplier")
def chosen_columns(spark, sf):
    return cols.select_output(table(spark, sf, "supplier"), ["s_name", "s_suppkey", "s_nationkey"])


@query("p7_drop_derived", "SELECT doc_id, lang, source, n_chars FROM documents")
def without_derived(spark, sf):
    documents = table(spark, sf, "documents").withColumn("text_clean", T.clean_text(F.col("text")))
    return cols.drop_derived(documents, "text_clean", "text", "never_there")


# --- markup and space -----------------------------------------------------------------------------

@query("x1_strip_html", f"""
    SELECT page_id, md5({sql_strip_html('html')}) AS article, md5({sql_strip_plain('html')}) AS contact,
           md5({sql_strip_plain("html || ' 1&#8211;2&ndash;3&nbsp;4'", True)}) AS district FROM pages""")
def stripped_pages(spark, sf):
    html = F.col("html")
    return table(spark, sf, "pages").select(
        "page_id", F.md5(T.strip_html(html)).alias("article"), F.md5(T.strip_html(html, "contact")).alias("contact"),
        F.md5(T.strip_html(F.concat(html, F.lit(" 1&#8211;2&ndash;3&nbsp;4")), "district")).alias("district"))


@query("x2_html_unescape", """
    SELECT page_id, md5(regexp_replace(replace(replace(replace(html, '&copy;', '©'), '&middot;', '·'), '&quot;', '"'), '&amp;?', '&', 'g')) AS decoded,
           '& <' || page_id || '> &lt; €é' || chr(9) || '&nosuch; ∉ ¬it' AS rendered FROM pages""")
def decoded_pages(spark, sf):
    rendered = F.concat(F.lit("&amp; &lt;"), "page_id", F.lit("&gt; &amp;lt; &#x80;&#233;&Tab;&nosuch; &notin; &notit"))
    return table(spark, sf, "pages").select(
        "page_id", F.md5(T.html_unescape(F.col("html"))).alias("decoded"), T.html_unescape(rendered).alias("rendered"))


@query("x3_clean_space", f"SELECT doc_id, md5({sql_clean_space('text')}) AS cleaned FROM documents")
def collapsed_documents(spark, sf):
    return table(spark, sf, "documents").select("doc_id", F.md5(T.clean_space(F.col("text"))).alias("cleaned"))


RENDERED = """
    rendered AS (SELECT page_id, url, CASE
        WHEN contains(url, 'http://') THEN replace(html, '<h1>', '<h1 class="post entry-title">')
        WHEN contains(url, 'blog') THEN replace(html, '<head>', '<head><meta property="og:title" content="Shared &amp; ' || page_id || ' - Town Site">')
        ELSE replace(html, '</title>', ' – Town Site</title>') END AS html FROM pages)"""


def rendered_pages(spark, sf):
    html = F.col("html")
    shared = F.concat(F.lit('<head><meta property="og:title" content="Shared &amp; '), F.col("page_id").cast("string"), F.lit(' - Town Site">'))
    return table(spark, sf, "pages").withColumn("html", F.when(
        F.contains("url", F.lit("http://")), F.replace(html, F.lit("<h1>"), F.lit('<h1 class="post entry-title">'))
    ).when(F.contains("url", F.lit("blog")), F.replace(html, F.lit("<head>"), shared)
    ).otherwise(F.replace(html, F.lit("</title>"), F.lit(" – Town Site</title>"))))


@query("x4_extract_title", f"WITH {RENDERED} SELECT page_id, {sql_title('html', 'Town Site')} AS title FROM rendered")
def titles(spark, sf):
    return rendered_pages(spark, sf).select("page_id", X.extract_title(F.col("html"), "Town Site").alias("title"))


@query("x5_extract_date", """
    SELECT o_orderkey, CASE WHEN o_orderpriority <> '1-URGENT' THEN o_orderdate::DATE END AS date FROM orders""")
def dates(spark, sf):
    day = F.to_date("o_orderdate")
    iso, status = F.date_format(day, "yyyy-MM-dd"), F.col("o_orderstatus")
    wrong = F.col("o_orderpriority") == "1-URGENT"
    html = (
        F.when(wrong, F.lit("<p>Published on Smarch 5, 2020</p>"))
        .when(status == "F", F.concat(F.lit('<TIME class="t" datetime="'), iso, F.lit('T10:00"></time>')))
        .when(status == "O", F.concat(F.lit('<meta property="article:published_time" content="'), iso, F.lit('T09:00">')))
        .otherwise(F.concat(F.lit("<p>Published on <b>"), F.date_format(day, "MMMM d, yyyy"), F.lit("</b> by us</p>")))
    )
    return table(spark, sf, "orders").select("o_orderkey", X.extract_date(html).alias("date"))


VARIED = """
    varied AS (SELECT page_id, url, CASE
        WHEN contains(url, '.net') THEN replace(html, 'article>', 'main>')
        WHEN contains(url, '.org') THEN replace(replace(html, '<article>', '<div><div class="x entry-content">'), '</article>', '</div> </div>')
        WHEN contains(url, 'http://') THEN replace(html, 'article>', 'section>')
        ELSE html END AS html FROM pages)"""


def varied_pages(spark, sf):
    html = F.col("html")
    div = F.replace(F.replace(html, F.lit("<article>"), F.lit('<div><div class="x entry-content">')), F.lit("</article>"), F.lit("</div> </div>"))
    return table(spark, sf, "pages").withColumn("html", F.when(
        F.contains("url", F.lit(".net")), F.replace(html, F.lit("article>"), F.lit("main>"))
    ).when(F.contains("url", F.lit(".org")), div
    ).when(F.contains("url", F.lit("http://")), F.replace(html, F.lit("article>"), F.lit("section>"))
    ).otherwise(html))


@query("x6_extract_article", f"WITH {VARIED} SELECT page_id, md5({sql_article('html')}) AS article FROM varied")
def articles(spark, sf):
    return varied_pages(spark, sf).select("page_id", F.md5(X.extract_article(F.col("html"))).alias("article"))


@query("x7_paragraphs", f"""
    WITH bare AS (SELECT page_id, url, CASE WHEN contains(url, 'spam') THEN regexp_replace(html, '</?p>', '', 'g') ELSE html END AS html FROM pages),
    {sql_body('bare')}
    SELECT url, (generate_subscripts(paras, 1) - 1)::INTEGER AS pos, unnest(paras) AS paragraph FROM bodies""")
def page_paragraphs(spark, sf):
    bare = table(spark, sf, "pages").withColumn(
        "html", F.when(F.contains("url", F.lit("spam")), F.regexp_replace("html", "</?p>", "")).otherwise(F.col("html")))
    return P.paragraphs(bare)


UNIT_ACTIONS, UNIT_SUBJECTS, UNIT_SKIP = ("tion", "stionth"), {"a": ("heit", "ouve"), "b": ("erth",)}, ("lichkeit",)


def sql_unit(p: str) -> str:
    return (f"{sql_any(f'lower({p})', UNIT_ACTIONS[:1])} AND {sql_any(f'lower({p})', ('heit', 'ouve', 'erth'))}"
            f" AND NOT {sql_any(f'lower({p})', UNIT_SKIP)}")


@query("x8_record_units", f"""
    WITH src AS (SELECT url, html FROM pages), {sql_body('src')},
    u AS (SELECT url, title, body_text, {sql_distinct_list(f"list_filter(paras, lambda p: {sql_unit('p')})")} AS us FROM bodies),
    f AS (SELECT url, CASE WHEN len(us) > 0 THEN us WHEN body_text <> '' THEN [body_text] ELSE [title] END AS us FROM u)
    SELECT url, len(us) > 1 AS multiple, (generate_subscripts(us, 1) - 1)::INTEGER AS unit_no, unnest(us) AS unit FROM f""")
def units(spark, sf):
    rules = SiteRules("", action_terms=UNIT_ACTIONS, sector_terms=UNIT_SUBJECTS, boilerplate=UNIT_SKIP)
    bodies = P.with_body(table(spark, sf, "pages").select("url", "html"))
    return P.record_units(bodies, rules).select("url", "multiple", "unit_no", "unit")


LINK_SLUGS = ("/en", "/de", "/t")
SQL_HREFS = r"""regexp_extract_all(html, '(?is)<a\b[^>]+href=["'']([^"''#]+)["'']', 1)"""


@query("x9_extract_links", f"""
    WITH open AS (SELECT url, replace(replace(html, 'article>', 'section>'), '<li>', '<li><a href="/category/en">c</a><a href="?p=5&amp;q=1">q</a>') AS html FROM pages),
    h AS (SELECT url, {sql_distinct_list(SQL_HREFS)} AS hs FROM open),
    l AS (SELECT url, (generate_subscripts(hs, 1) - 1)::INTEGER AS pos, replace(unnest(hs), '&amp;', '&') AS href FROM h),
    r AS (SELECT url, pos, CASE WHEN starts_with(href, '?') THEN regexp_extract(url, '^[^?#]*', 0) || href
                               ELSE regexp_extract(url, '^[^:/?#]+://[^/?#]*', 0) || href END AS target FROM l)
    SELECT url, (row_number() OVER (PARTITION BY url ORDER BY min(pos)) - 1)::INTEGER AS pos, target FROM r
    WHERE NOT contains(lower(target), '/category/') AND (regexp_matches(target, '[?&]p=[^&]') OR {sql_any('lower(target)', LINK_SLUGS)})
    GROUP BY url, target""")
def links(spark, sf):
    more = F.lit('<li><a href="/category/en">c</a><a href="?p=5&amp;q=1">q</a>')
    open_pages = table(spark, sf, "pages").select("url", F.replace(
        F.replace("html", F.lit("article>"), F.lit("section>")), F.lit("<li>"), more).alias("html"))
    return P.extract_links(open_pages, slug_words=LINK_SLUGS)


@query("x9_contact_links", r"""
    WITH t AS (SELECT url, list_distinct(regexp_extract_all(html, '(?is)<a\b[^>]*href=["''][^"'']+["''][^>]*>.*?</a>')) AS tags FROM pages),
    l AS (SELECT url, unnest(tags) AS tag FROM t),
    k AS (SELECT url, regexp_extract(tag, '(?is)href=["'']([^"'']+)["'']', 1) AS href, lower(regexp_extract(tag, '(?is)>(.*?)</a>', 1)) AS label FROM l)
    SELECT DISTINCT url, regexp_extract(url, '^[^:/?#]+://[^/?#]*', 0) || href AS target FROM k
    WHERE contains(label, 'st') OR contains(label, 'ier') OR contains(lower(href), 'st') OR contains(lower(href), 'ier')""")
def menu_links(spark, sf):
    return P.contact_links(table(spark, sf, "pages"), menu=("st", "ier")).select("url", "target")


SQL_EMAILS = r"regexp_extract_all(text, '[\p{L}\p{N}_.+-]+@[\p{L}\p{N}_.-]+\.[A-Za-z]{2,}')"
SQL_PHONE = rf"(?:\+?260(?:{WS}|-)?)?0\p{{Nd}}{{2}}(?:{WS}|-)?\p{{Nd}}{{3}}(?:{WS}|-)?\p{{Nd}}{{3,4}}"


@query("x10_extract_contacts", f"""
    WITH t AS (SELECT doc_id, {sql_collapse("text || CASE WHEN lang = 'de' THEN ' Postal Address: Plot ' || doc_id || ' Main Road. Phone 097' || (8080795 + doc_id) || ' or +260 977 123 456' ELSE '' END")} AS text FROM documents),
    c AS (SELECT doc_id, text, {sql_distinct_list(SQL_EMAILS)} AS emails,
                 {sql_distinct_list(f"regexp_extract_all(text, {q(SQL_PHONE)})")} AS phones FROM t)
    SELECT doc_id::VARCHAR AS source_page, 'https://docs.example.org/' || doc_id AS source_url,
           nullif(array_to_string(phones, '; '), '') AS phone, nullif(array_to_string(emails, '; '), '') AS email,
           nullif(trim(regexp_extract(text, '(?i)(?:physical address|postal address|address)\\s*[:\\-]?\\s*(.{{10,180}}?)(?:\\s+(?:phone|tel|email|e-mail)\\b|$)', 1), ' .:-'), '') AS office_address
    FROM c WHERE len(emails) > 0 OR len(phones) > 0""")
def contacts(spark, sf):
    tail = F.when(F.col("lang") == "de", F.concat(
        F.lit(" Postal Address: Plot "), "doc_id", F.lit(" Main Road. Phone 097"), F.lit(8080795) + F.col("doc_id"), F.lit(" or +260 977 123 456"))).otherwise("")
    texts = table(spark, sf, "documents").select(
        T.collapse_space(F.concat("text", tail)).alias("text"), F.col("doc_id").cast("string").alias("source_page"),
        F.concat(F.lit("https://docs.example.org/"), "doc_id").alias("source_url"))
    return P.extract_contacts(texts).select("source_page", "source_url", "phone", "email", "office_address")


@query("x11_extract_amount", """
    SELECT o_orderkey, CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN NULL
        WHEN o_orderpriority = '3-MEDIUM' THEN round(o_totalprice, 2)
        WHEN o_orderpriority = '4-NOT SPECIFIED' THEN round(round(o_totalprice, 2) * 1000, 3)
        ELSE floor(o_totalprice) * 1000000 END AS amount,
        CASE WHEN o_orderpriority = '3-MEDIUM' THEN round(o_totalprice, 2) END AS medium_strict FROM orders""")
def amounts(spark, sf):
    plain = F.format_number(F.col("o_totalprice"), 2)
    kind = F.col("o_orderpriority")
    text = (
        F.when(kind == "1-URGENT", F.concat(F.lit("K"), plain, F.lit(" for a school and ZMW "), plain, F.lit(" for a clinic")))
        .when(kind == "2-HIGH", F.concat(F.lit("No cost, BK"), plain, F.lit(" K"), F.floor("o_totalprice"), F.lit("k")))
        .when(kind == "3-MEDIUM", F.concat(F.lit("worth ZMW "), plain, F.lit(".")))
        .when(kind == "4-NOT SPECIFIED", F.concat(F.lit("about k "), plain, F.lit(" Thousand in all")))
        .otherwise(F.concat(F.lit("K,"), F.floor("o_totalprice"), F.lit(" m spent")))
    )
    return table(spark, sf, "orders").select(
        "o_orderkey", F.round(X.extract_amount(text), 3).alias("amount"),
        F.when(kind == "3-MEDIUM", F.round(X.extract_amount(text, strict=True), 2)).alias("medium_strict"))


SQL_NAME_RAW = sql_clean_space("regexp_extract(coalesce(nullif(regexp_extract(unit, '(?i)(?:construction|provision)[^.!?]{0,180}', 0), ''), unit), '^[^.;]*', 0)")


@query("x12_make_name", f"""
    WITH u AS (SELECT doc_id, left(text, 300) AS title, lang <> 'en' AS multiple,
                      CASE WHEN lang IN ('fr', 'de') THEN 'Met; provision of ' || text ELSE text END AS unit FROM documents),
    n AS (SELECT *, {SQL_NAME_RAW} AS name FROM u)
    SELECT doc_id, CASE WHEN NOT multiple AND title <> '' THEN left(title, 180)
                        WHEN length(name) > 180 THEN regexp_replace(left(name, 177), ' [^ ]*$', '') || '...' ELSE name END AS name FROM n""")
def names(spark, sf):
    unit = F.when(F.col("lang").isin("fr", "de"), F.concat(F.lit("Met; provision of "), "text")).otherwise(F.col("text"))
    return table(spark, sf, "documents").select(
        "doc_id", X.make_name(unit, F.left("text", F.lit(300)), F.col("lang") != "en").alias("name"))


SQL_SENTENCES = f"string_split(regexp_replace({sql_clean_space('text')}, '([.!?]) ', '\\1' || chr(1), 'g'), chr(1))"


@query("x13_make_description", f"""
    SELECT doc_id, rtrim(left(array_to_string(list_slice({SQL_SENTENCES}, 1, 2), ' '), 600)) AS description FROM documents""")
def descriptions(spark, sf):
    return table(spark, sf, "documents").select("doc_id", X.make_description(F.col("text")).alias("description"))


def fact_pages(spark, sf):
    """Population pages rendered from customers: which sentences a page holds depends on its segment."""
    key, seg = F.col("c_custkey"), F.col("c_mktsegment")
    grouped = lambda c: F.format_number(c.cast("bigint"), 0)
    census = F.concat(
        F.lit("According to the 2010 Census by the Central Statistical Office (CSO), Lenda District had "), grouped(key + 1000),
        F.lit(" households and a population of "), grouped(key * 7 + 60000), F.lit(", consisting of "), grouped(key * 3 + 30000),
        F.lit(" males and "), grouped(key * 4 + 30000), F.lit(" females, with a growth rate of 2."), (key % 10), F.lit("%. "))
    projected = F.concat(F.lit("It would rise to approximately "), grouped(key * 9 + 90000), F.lit(" by 2018. "))
    later = F.concat(F.lit("The 2022 Census of Population and Housing indicates significant growth, with the district's population increasing to "),
                     grouped(key * 11 + 100000), F.lit(" residents. "))
    area = F.concat(F.lit("It has a Total Land Area of "), grouped(key + 5000), F.lit(" square kilometres in Novia's Southern Province and shares boundaries with Kalo and Choma. Sina is far."))
    text = F.concat(
        F.when(seg.isin("MACHINERY", "BUILDING"), census).otherwise(""), F.when(seg.isin("BUILDING", "AUTOMOBILE"), projected).otherwise(""),
        F.when(seg.isin("BUILDING", "MACHINERY"), later).otherwise(""), F.when(seg != "AUTOMOBILE", area).otherwise("Sina and Kalo."))
    customer = spread(table(spark, sf, "customer").select("c_custkey", "c_mktsegment"))
    return customer.select("c_custkey", F.concat(F.lit("https://facts.example.org/"), "c_custkey").alias("url"), text.alias("text"))


FACTS_SQL = """
    facts AS (
      SELECT c_custkey, 0 AS t, c_mktsegment AS s, c_custkey * 7 + 60000 AS population, 2010 AS population_year, c_custkey * 3 + 30000 AS population_male,
             c_custkey * 4 + 30000 AS population_female, c_custkey + 1000 AS households,
             '2010 Census by the Central Statistical Office (CSO); annual population growth rate reported as 2.' || (c_custkey % 10) || '%' AS notes
      FROM customer WHERE c_mktsegment IN ('MACHINERY', 'BUILDING')
      UNION ALL SELECT c_custkey, 1, c_mktsegment, c_custkey * 9 + 90000, 2018, NULL, NULL, NULL, 'Growth-rate projection from the 2010 Census, not an actual census count'
      FROM customer WHERE c_mktsegment IN ('AUTOMOBILE', 'BUILDING')
      UNION ALL SELECT c_custkey, 2, c_mktsegment, c_custkey * 11 + 100000, 2022, NULL, NULL, NULL, '2022 Census of Population and Housing'
      FROM customer WHERE c_mktsegment IN ('MACHINERY', 'BUILDING')),
    profile AS (
      SELECT 'district' AS level, 'Lenda' AS name, population::BIGINT AS population, population_year::BIGINT AS population_year,
             population_male::BIGINT AS population_male, population_female::BIGINT AS population_female, households::BIGINT AS households,
             CASE WHEN s <> 'AUTOMOBILE' THEN (c_custkey + 5000)::DOUBLE END AS area_km2,
             CASE WHEN s <> 'AUTOMOBILE' THEN 'Southern' END AS province,
             CASE WHEN s <> 'AUTOMOBILE' THEN 'Kalo;Choma' ELSE 'Kalo;Sina' END AS neighboring_districts,
             notes || CASE WHEN s = 'AUTOMOBILE' OR t = 2 THEN '; last of its page' ELSE '' END AS notes,
             'https://facts.example.org/' || c_custkey AS source_url,
             CASE WHEN s = 'AUTOMOBILE' OR t = 2 THEN 'https://wiki.example.org/Lenda' END AS secondary_source_url, c_custkey, t
      FROM facts)"""
FACT_ARGS = dict(unit="Lenda", country="Novia", neighbours=("Kalo", "Choma", "Sina"), last_note="; last of its page",
                 last_source="https://wiki.example.org/Lenda")


@query("x14_extract_facts", f"WITH {FACTS_SQL} SELECT {', '.join(c for c in PROFILE_COLUMNS if c != 'record_id')} FROM profile")
def facts(spark, sf):
    found = P.extract_facts(fact_pages(spark, sf), census_templates("Lenda"), **FACT_ARGS)
    return found.select(*[c for c in PROFILE_COLUMNS if c != "record_id"])


@query("x15_emit_if_mentioned", """
    SELECT 'constituency' AS level, 'Und' AS name, NULL::BIGINT AS population, NULL::DOUBLE AS area_km2, 'Southern' AS province, url AS source_url
    FROM pages WHERE contains(html, 'Und')""")
def mentioned(spark, sf):
    pages = table(spark, sf, "pages").select("url", F.col("html").alias("text"))
    rows = P.emit_if_mentioned(pages, "Und", {"level": "constituency", "name": "Und", "province": "Southern"}, PROFILE_SCHEMA)
    return rows.select("level", "name", "population", "area_km2", "province", "source_url")


@query("x16_url_token", f"""
    WITH v AS (SELECT page_id, url || t AS u FROM pages, unnest(['', '&p=a%20b', '/']) AS tails(t)),
    s AS (SELECT page_id, u, regexp_extract(regexp_extract(u, '^[^?#]*[?]([^#]*)', 1), '(?:^|&)p=([^&]+)', 1) AS p,
                 regexp_replace(trim({SQL_PATH}, '/'), '^.*/', '') AS seg FROM v)
    SELECT page_id, u AS variant, 'post_' || left(regexp_replace(CASE WHEN p <> '' THEN replace(p, '%20', ' ') WHEN seg <> '' THEN seg ELSE 'home' END, '[^A-Za-z0-9_-]+', '_', 'g'), 100) || '.html' AS token FROM s""")
def tokens(spark, sf):
    variants = table(spark, sf, "pages").select("page_id", F.explode(F.array(
        F.col("url"), F.concat("url", F.lit("&p=a%20b")), F.concat("url", F.lit("/")))).alias("variant"))
    return variants.withColumn("token", X.url_token(F.col("variant")))


# --- token features -------------------------------------------------------------------------------

SQL_STOP = "[" + ", ".join(q(w) for w in STOPWORDS) + "]"
SQL_FOLD = "replace(replace(lower(regexp_replace({}, '<[^>]+>', ' ', 'g')), 'ß', 'ss'), 'ς', 'σ')"


def sql_clean_text(x: str) -> str:
    found = f"regexp_extract_all({SQL_FOLD.format(x)}, {q(WORD + '+')})"
    return f"coalesce(array_to_string(list_filter({found}, lambda w: NOT list_contains({SQL_STOP}, w)), ' '), '')"


@query("t1_clean_text", f"SELECT doc_id, md5({sql_clean_text('text')}) AS cleaned FROM documents")
def token_text(spark, sf):
    return table(spark, sf, "documents").select("doc_id", F.md5(T.clean_text(F.col("text"))).alias("cleaned"))


SQL_PUNCT = r"""translate(lower(regexp_replace({}, '<[^>]+>', '', 'g')), '!"#$%&''()*+,-./:;<=>?@[\]^_`{{|}}~', '')"""


def sql_clean_punct(x: str) -> str:
    words = f"regexp_split_to_array({SQL_PUNCT.format(x)}, {q(WS + '+')})"
    return f"coalesce(array_to_string(list_filter({words}, lambda w: w <> '' AND NOT list_contains(list_append({SQL_STOP}, 'not'), w)), ' '), '')"


@query("t2_clean_text_punct", f"SELECT doc_id, md5({sql_clean_punct('text')}) AS cleaned FROM documents")
def bare_text(spark, sf):
    return table(spark, sf, "documents").select("doc_id", F.md5(T.clean_text_punct(F.col("text"), [*STOPWORDS, "not"])).alias("cleaned"))
