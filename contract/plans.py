"""X18 and L: the compositions, with the whole chain restated in SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from contract.base import (
    WORD, WS, q, query, scratch, sql_any, sql_body, sql_clean_space, sql_collapse, sql_distinct_list, sql_strip_plain,
    sql_word, table,
)
from contract.extraction import (
    FACT_ARGS, FACTS_SQL, SQL_PHONE, SQL_SENTENCES, fact_pages, sql_clean_punct, sql_clean_text,
)
from contract.profiles import COPIED_EVENTS, copied_events, sql_summary
from contract.sources import audit_rows, post_files, rounded
from trailkeep.operators.pages import extract_facts, pages_to_posts, pages_to_records
from trailkeep.plans import clean as L
from trailkeep.plans.collect import build_reviewed, collect_contacts, collect_profile, collect_records
from trailkeep.plans.discovery import discover_urls
from trailkeep.plans.full_run import Step, full_run
from trailkeep.plans.summary import master_summary
from trailkeep.sources.web import read_post_index
from trailkeep.rules import (
    ACTION_TERMS, BOILERPLATE_PHRASES, CONTACT_COLUMNS, PROFILE_COLUMNS, PROJECT_COLUMNS, SECTOR_TERMS,
    STATUS_DENIED, STATUS_DONE, STATUS_PLANNED, STATUS_RUNNING, SiteRules, census_templates, place_rules,
)
from trailkeep.session import spread

# --- announcements rendered into the page table ---------------------------------------------------

PLACES = place_rules(wards=("Lusu", "Moomba"), ward_only=("Kasi",), constituencies=("Nalo",))
RULES = SiteRules("https://blog.tionsh.example.net", site_name="Town Site", places=PLACES)


def project_pages(spark, sf):
    html, key = F.col("html"), F.col("page_id").cast("string")
    english, plain = F.contains("url", F.lit("/en/")), F.contains("url", F.lit("http://"))
    place = F.when(english, "Lusu Ward").otherwise("the town of Kasi")
    bundle = F.concat(
        F.lit("<p>In "), place, F.lit(", construction of a classroom block number "), key, F.lit(" is ongoing under the CDF at K"), key,
        F.lit(".5 million. Works go on. More to follow.</p><p>Rehabilitation of the clinic in Kasi Ward has been completed; it cost ZMW "),
        F.format_number(F.col("page_id") * 1000 + 500, 0), F.lit(" in all.</p><p>All rights reserved: construction of a school.</p>"))
    single = F.lit("<p>The Constituency Development Fund paid for drilling of a borehole in Nalo, yet to be completed.</p>")
    more = F.when(plain, bundle).when(F.contains("url", F.lit("blog")), single).otherwise("")
    meta = F.concat(F.lit('<head><meta property="article:published_time" content="'),
                    F.date_add(F.lit("2024-01-01").cast("date"), (F.col("page_id") % 300).cast("int")).cast("string"), F.lit('T09:00">'))
    return table(spark, sf, "pages").select("page_id", "url", F.replace(
        F.replace(html, F.lit("<head>"), meta), F.lit("</article>"), F.concat(more, F.lit("</article>"))).alias("html"))


PROJECT_PAGES = """
    src AS (SELECT url, DATE '2024-01-01' + (page_id % 300)::INTEGER AS date, replace(replace(html, '<head>',
        '<head><meta property="article:published_time" content="' || (DATE '2024-01-01' + (page_id % 300)::INTEGER) || 'T09:00">'), '</article>',
        CASE WHEN contains(url, 'http://') THEN
          '<p>In ' || CASE WHEN contains(url, '/en/') THEN 'Lusu Ward' ELSE 'the town of Kasi' END || ', construction of a classroom block number ' || page_id
          || ' is ongoing under the CDF at K' || page_id || '.5 million. Works go on. More to follow.</p><p>Rehabilitation of the clinic in Kasi Ward has been completed; it cost ZMW '
          || format('{:,}', page_id * 1000 + 500) || ' in all.</p><p>All rights reserved: construction of a school.</p>'
        WHEN contains(url, 'blog') THEN '<p>The Constituency Development Fund paid for drilling of a borehole in Nalo, yet to be completed.</p>' ELSE '' END || '</article>') AS html FROM pages)"""

SQL_AMOUNT = r"'(?i)\b(?:ZMW|K)\s*,?\s*([0-9][0-9,]*(?:\.[0-9]+)?)\s*(thousand|million|billion|m|bn)?\b'"
SUBJECTS = [t for terms in SECTOR_TERMS.values() for t in terms]
SQL_SECTOR = "CASE " + " ".join(f"WHEN {sql_any('lower(unit)', t)} THEN '{s}'" for s, t in SECTOR_TERMS.items()) + " ELSE 'other' END"
SQL_STATUS = f"""CASE WHEN {sql_word('lower(unit)', f"(?:{'|'.join(STATUS_DENIED)})[ ]+(?:{'|'.join(STATUS_DONE)})")} THEN NULL
    WHEN {sql_word('lower(unit)', '|'.join(STATUS_DONE))} THEN 'completed'
    WHEN regexp_matches(lower(unit), 'near(ing)? completion|almost complete|9[0-9] *% *complete') THEN 'near_completion'
    WHEN {sql_word('lower(unit)', '|'.join(STATUS_RUNNING))} THEN 'ongoing' WHEN {sql_word('lower(unit)', '|'.join(STATUS_PLANNED))} THEN 'planned' END"""


def sql_place(x: str) -> str:
    return "CASE " + " ".join(f"WHEN {sql_word(x, p)} THEN '{name}'" for name, p in PLACES) + " END"


def sql_programme(x: str) -> str:
    return f"""CASE WHEN {sql_word(x, 'cdf')} OR contains(lower({x}), 'constituency development fund') THEN 'CDF'
      WHEN {sql_word(x, 'lgef')} OR contains(lower({x}), 'local government equalisation fund') THEN 'LGEF'
      WHEN contains(lower({x}), 'world bank') THEN 'World Bank' END"""


SQL_PHRASE = "regexp_extract(unit, '(?i)\\b(?:construction|rehabilitation|procurement|purchase|installation|drilling|grading|completion|development|provision)\\b[^.!?]{0,180}', 0)"
SQL_RAW_NAME = sql_clean_space(f"regexp_extract(coalesce(nullif({SQL_PHRASE}, ''), unit), '^[^.;]*', 0)")
SQL_KEPT = f"list_filter(paras, lambda p: {sql_any('lower(p)', ACTION_TERMS)} AND {sql_any('lower(p)', SUBJECTS)} AND NOT {sql_any('lower(p)', BOILERPLATE_PHRASES)})"

RECORDS_SQL = f"""{PROJECT_PAGES}, {sql_body('src', 'Town Site')},
    about AS (SELECT * FROM bodies WHERE {sql_any("lower(title || ' ' || body_text)", ACTION_TERMS)}
              AND ({sql_word("title || ' ' || body_text", 'cdf')} OR contains(lower(title || ' ' || body_text), 'constituency development fund'))),
    lists AS (SELECT *, {sql_distinct_list(SQL_KEPT)} AS us FROM about),
    filled AS (SELECT * REPLACE (CASE WHEN len(us) > 0 THEN us WHEN body_text <> '' THEN [body_text] ELSE [title] END AS us) FROM lists),
    units AS (SELECT url, date, title, len(us) > 1 AS multiple, (generate_subscripts(us, 1) - 1)::INTEGER AS unit_no, unnest(us) AS unit FROM filled),
    named AS (SELECT *, {SQL_RAW_NAME} AS raw, {sql_clean_space("title || '. ' || unit")} AS evidence, unit AS text,
                     regexp_extract_all(unit, {SQL_AMOUNT}, 1) AS nums, regexp_extract_all(unit, {SQL_AMOUNT}, 2) AS sufs FROM units),
    records AS (SELECT CASE WHEN NOT multiple AND title <> '' THEN left(title, 180) WHEN length(raw) > 180 THEN regexp_replace(left(raw, 177), ' [^ ]*$', '') || '...' ELSE raw END AS project_name,
        {SQL_SECTOR} AS sector, coalesce({sql_place('unit')}, {sql_place('evidence')}) AS constituency, {sql_programme('evidence')} AS funding_source,
        CASE WHEN len(nums) = 1 THEN replace(nums[1], ',', '')::DOUBLE * CASE lower(sufs[1]) WHEN 'thousand' THEN 1000 WHEN 'million' THEN 1000000 WHEN 'm' THEN 1000000
             WHEN 'billion' THEN 1000000000 WHEN 'bn' THEN 1000000000 ELSE 1 END END AS funding_amount_zmw,
        {SQL_STATUS} AS status, date AS date_reported, rtrim(left(array_to_string(list_slice({SQL_SENTENCES}, 1, 2), ' '), 600)) AS description,
        url AS source_url, unit_no FROM named)"""
RECORD_COLUMNS = ", ".join(c for c in PROJECT_COLUMNS if c != "project_id")


@query("x17_pages_to_posts", f"WITH {PROJECT_PAGES}, {sql_body('src', 'Town Site')} SELECT title, date, body_text, url FROM bodies")
def posts(spark, sf):
    return pages_to_posts(project_pages(spark, sf), "Town Site")


@query("x18_pages_to_records", f"WITH {RECORDS_SQL} SELECT {RECORD_COLUMNS}, unit_no FROM records")
def records(spark, sf):
    return pages_to_records(project_pages(spark, sf), RULES).drop("project_id")


@query("l1_collect_records", f"""
    WITH {RECORDS_SQL.replace("FROM pages)", "FROM pages WHERE contains(url, '//blog.tionsh.example.net/') OR contains(url, '//www.blog.tionsh.example.net/'))", 1)},
    tidy AS (SELECT * FROM records QUALIFY row_number() OVER (PARTITION BY source_url, project_name, description ORDER BY unit_no) = 1)
    SELECT printf('REC-%03d', row_number() OVER (ORDER BY date_reported, source_url, project_name, description)) AS project_id, {RECORD_COLUMNS} FROM tidy""")
def collected_records(spark, sf):
    return collect_records(project_pages(spark, sf), RULES, order="page_id").records


@query("l1_collect_records_rejects", """
    SELECT url AS source_url, CASE WHEN NOT regexp_matches(url, '^https?://(www[.])?blog[.]tionsh[.]example[.]net([/?#]|$)') THEN 'outside the site' ELSE 'no page content' END AS error
    FROM pages WHERE NOT regexp_matches(url, '^https?://(www[.])?blog[.]tionsh[.]example[.]net([/?#]|$)') OR contains(url, '/es/')""")
def rejected_pages(spark, sf):
    pages = table(spark, sf, "pages").withColumn("html", F.when(~F.contains("url", F.lit("/es/")), F.col("html")))
    return collect_records(pages, RULES).rejects


@query("l1_collect_records_posts", f"""
    WITH {PROJECT_PAGES.replace("FROM pages)", "FROM pages WHERE regexp_matches(url, '^https?://(www[.])?blog[.]tionsh[.]example[.]net([/?#]|$)'))")}, {sql_body('src', 'Town Site')}
    SELECT title, date, body_text, url FROM bodies""")
def collected_posts(spark, sf):
    return collect_records(project_pages(spark, sf), RULES).posts


@query("l1_discover_urls", """
    WITH p AS (SELECT conv_id, turn, 'https://' || CASE WHEN conv_id % 2 = 0 THEN 'posts' ELSE 'other' END || '.example.org/?p=' || (conv_id * 1000 + turn) AS url FROM conversations
               WHERE text IS NOT NULL),
    f AS (SELECT url, 'seed' AS found_in FROM p WHERE turn = 1 UNION ALL SELECT url, 'post index' FROM p WHERE turn % 2 = 1)
    SELECT url, max(found_in) AS found_in FROM f WHERE contains(url, '//posts.example.org/') GROUP BY url""")
def discovered_urls(spark, sf):
    talk = table(spark, sf, "conversations").filter("text IS NOT NULL")
    number = F.col("conv_id") * 1000 + F.col("turn")
    link = F.concat(F.lit("https://"), F.when(F.col("conv_id") % 2 == 0, "posts").otherwise("other"), F.lit(".example.org/?p="), number)
    text = F.concat("text", F.when(F.col("turn") % 2 == 1, " The CDF pays for construction of a road.").otherwise(""))
    index = read_post_index(spark, post_files(spark, talk.select(number.alias("number"), "turn", link.alias("link"), "role", text.alias("text"))), multi_line=False)
    seeds = talk.filter("turn = 1").select(link.alias("url"))
    pages = table(spark, sf, "pages").select("url", "html")
    return discover_urls(SiteRules("https://posts.example.org"), seeds, index, pages, pages)


# --- cleaning -------------------------------------------------------------------------------------

SECTORS = {"1-URGENT": " Education ", "2-HIGH": "health", "3-MEDIUM": "Water_Sanitation", "4-NOT SPECIFIED": "agriculture", "5-LOW": "other"}
PROJECT_SQL = f"""
    base AS (SELECT o_orderkey AS project_id, 'Project ' || o_custkey AS project_name,
        CASE o_orderpriority {' '.join(f"WHEN '{k}' THEN '{v.strip().lower()}'" for k, v in SECTORS.items())} END AS sector,
        CASE o_orderstatus WHEN 'F' THEN 'completed' WHEN 'O' THEN 'ongoing' ELSE 'unspecified' END AS status,
        CASE WHEN o_orderpriority <> '5-LOW' THEN round(o_totalprice, 2) END AS funding_amount_zmw, o_orderdate::DATE AS date_reported,
        '<p>The School of ' || o_custkey || ' is not  Completed at 2.9%, ' || o_orderpriority || '</p>' AS description,
        'https://town.example.org/?p=' || (o_custkey % 500) AS source_url FROM orders)"""


def project_table(spark, sf):
    kind, state = F.col("o_orderpriority"), F.col("o_orderstatus")
    sector = F.lit(None).cast("string")
    for k, v in SECTORS.items():
        sector = F.when(kind == k, v).otherwise(sector)
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority", "o_totalprice", "o_orderdate")
    base = spread(orders).select(
        F.col("o_orderkey").alias("project_id"), F.concat(F.lit("Project "), "o_custkey").alias("project_name"), sector.alias("sector"),
        F.when(state == "F", " Completed\t").when(state == "O", "ONGOING").alias("status"),
        F.when(kind != "5-LOW", F.round("o_totalprice", 2).cast("string")).alias("funding_amount_zmw"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("date_reported"),
        F.concat(F.lit("<p>The School of "), "o_custkey", F.lit(" is not  Completed at 2.9%, "), kind, F.lit("</p>")).alias("description"),
        F.concat(F.lit("https://town.example.org/?p="), F.col("o_custkey") % 500).alias("source_url"))
    copies = base.filter("status = 'ONGOING'").withColumn("project_id", F.col("project_id") + 10**9)
    return base.unionByName(copies).withColumn("description_clean", F.lit("old"))


@query("l2_clean_projects", f"""
    WITH {PROJECT_SQL}
    SELECT min(project_id) AS project_id, project_name, sector, status, funding_amount_zmw, date_reported, description, source_url,
           {sql_clean_text('description')} AS description_clean FROM base GROUP BY ALL""")
def cleaned_projects(spark, sf):
    return L.clean_projects(project_table(spark, sf)).clean


@query("l2_clean_projects_review", f"""
    WITH {PROJECT_SQL}, d AS (SELECT min(project_id) AS project_id, * EXCLUDE project_id FROM base GROUP BY ALL)
    SELECT project_id, source_url, project_name FROM d QUALIFY count(*) OVER (PARTITION BY source_url, project_name) > 1""")
def project_review(spark, sf):
    return L.clean_projects(project_table(spark, sf)).review.select("project_id", "source_url", "project_name")


RAW_SQL = f"""
    raw AS (SELECT o_orderkey + c.shift AS project_id, 'Project ' || o_custkey AS project_name,
        CASE o_orderpriority {' '.join(f"WHEN '{k}' THEN '{v}'" for k, v in SECTORS.items())} END AS sector,
        CASE o_orderstatus WHEN 'F' THEN ' Completed' || chr(9) WHEN 'O' THEN 'ONGOING' END AS status,
        CASE WHEN o_orderpriority <> '5-LOW' THEN round(o_totalprice, 2)::VARCHAR END AS funding_amount_zmw, strftime(o_orderdate, '%Y-%m-%d') AS date_reported,
        '<p>The School of ' || o_custkey || ' is not  Completed at 2.9%, ' || o_orderpriority || '</p>' AS description,
        'https://town.example.org/?p=' || (o_custkey % 500) AS source_url, 'old' AS description_clean
        FROM orders JOIN (VALUES (0), (1000000000)) c(shift) ON c.shift = 0 OR o_orderstatus = 'O')"""
RAW_TYPES = {c: "string" for c in ("project_name", "sector", "status", "funding_amount_zmw", "date_reported", "description", "source_url", "description_clean")}
FENCE_SQL = "quantile_cont(funding_amount_zmw, {0}) {1} 1.5 * (quantile_cont(funding_amount_zmw, 0.75) - quantile_cont(funding_amount_zmw, 0.25))"


@query("l2_full_run", f"""
    WITH {PROJECT_SQL}, {RAW_SQL},
    clean AS (SELECT min(project_id) AS project_id, * EXCLUDE project_id, {sql_clean_text('description')} AS description_clean FROM base GROUP BY ALL),
    twins AS (SELECT * FROM clean QUALIFY count(*) OVER (PARTITION BY source_url, project_name) > 1)
    SELECT 'projects' AS file, * FROM ({' UNION ALL '.join([
        *audit_rows('before', 'raw', {'project_id': 'bigint', **RAW_TYPES}),
        *audit_rows('after', 'clean', {'project_id': 'bigint', **RAW_TYPES, 'funding_amount_zmw': 'double', 'date_reported': 'date'}),
        "SELECT 'decision', 'input_rows', count(*)::VARCHAR FROM raw",
        "SELECT 'decision', 'duplicates_removed', ((SELECT count(*) FROM raw) - count(*))::VARCHAR FROM clean",
        "SELECT 'decision', 'output_rows', count(*)::VARCHAR FROM clean",
        "SELECT 'decision', 'repeated_url_rows', (count(*) - count(DISTINCT source_url))::VARCHAR FROM raw",
        "SELECT 'decision', 'near_duplicate_rows', count(*)::VARCHAR FROM twins",
        "SELECT 'decision', 'outliers', '0'",
        f"SELECT 'fence', 'lower funding_amount_zmw', round({FENCE_SQL.format(0.25, '-')}, 4)::DECIMAL(38, 4)::VARCHAR FROM clean",
        f"SELECT 'fence', 'upper funding_amount_zmw', round({FENCE_SQL.format(0.75, '+')}, 4)::DECIMAL(38, 4)::VARCHAR FROM clean"])})""")
def whole_run(spark, sf):
    folder = scratch(spark)
    return rounded(full_run({"projects": Step(project_table(spark, sf), L.clean_projects, f"{folder}/projects")}, folder))


@query("l2_clean_posts", f"""
    SELECT source AS title, DATE '2024-02-01' + (doc_id % 28)::INTEGER AS date, md5(text) AS body_md5, 'https://d.example.org/' || doc_id AS url,
           md5({sql_clean_text('text')}) AS clean_md5 FROM documents""")
def cleaned_posts(spark, sf):
    day = F.date_add(F.lit("2024-02-01").cast("date"), (F.col("doc_id") % 28).cast("int")).cast("string")
    posts = table(spark, sf, "documents").select(
        F.col("source").alias("title"), day.alias("date"), F.col("text").alias("body_text"), F.concat(F.lit("https://d.example.org/"), "doc_id").alias("url"))
    clean = L.clean_posts(posts.unionByName(posts)).clean
    return clean.select("title", "date", F.md5("body_text").alias("body_md5"), "url", F.md5("body_text_clean").alias("clean_md5"))


def contact_table(spark, sf):
    """Contacts rendered from customers; every customer has two rows that agree but for the id."""
    key = F.col("c_custkey")
    base = table(spark, sf, "customer").select(
        F.concat(F.lit("C-"), F.lpad(key.cast("string"), 10, "0")).alias("record_id"),
        F.concat(F.lit("  "), "c_name", F.lit(" &amp;  Sons ")).alias("name"), F.lower("c_mktsegment").alias("role_title"), F.lit("").alias("department"),
        F.concat(F.lit("Tel 097"), key + 8080000, F.lit("\t or +260 977 100 200")).alias("phone"),
        F.concat(F.lit("Mail.C"), key, F.lit("@Example.ORG")).alias("email"), F.lit(None).cast("string").alias("office_address"),
        F.lit("Contact | Us").alias("source_page"), F.concat(F.lit("https://c.example.org/"), key).alias("source_url"))
    return base.unionByName(base.withColumn("record_id", F.replace("record_id", F.lit("C-"), F.lit("D-"))))


CONTACT_SQL = """'C-' || lpad(c_custkey::VARCHAR, 10, '0') AS record_id, c_name || ' & Sons' AS name, lower(c_mktsegment) AS role_title, {blank} AS department,
    {phone} AS phone, 'mail.c' || c_custkey || '@example.org' AS email, {blank} AS office_address, 'Contact | Us' AS source_page,
    'https://c.example.org/' || c_custkey AS source_url"""


@query("l3_clean_contacts_script", "SELECT " + CONTACT_SQL.format(
    blank="''", phone="'097' || (c_custkey + 8080000) || '; +260 977 100 200'") + " FROM customer WHERE c_nationkey > 0")
def contacts_script(spark, sf):
    nameless = table(spark, sf, "customer").filter("c_nationkey = 0").select(F.concat(F.lit("https://c.example.org/"), "c_custkey").alias("source_url"))
    contacts = contact_table(spark, sf).join(nameless.withColumn("gone", F.lit(True)), "source_url", "left")
    contacts = contacts.withColumn("source_url", F.when(F.col("gone").isNull(), F.col("source_url")).otherwise(" "))
    return L.clean_contacts(contacts.select(*CONTACT_COLUMNS), "script").clean


@query("l3_clean_contacts_strict", "SELECT " + CONTACT_SQL.format(
    blank="NULL::VARCHAR", phone="'Tel 097' || (c_custkey + 8080000) || ' or +260 977 100 200'") + " FROM customer")
def contacts_strict(spark, sf):
    return L.clean_contacts(contact_table(spark, sf), "strict").clean


def profile_table(spark, sf):
    pages = fact_pages(spark, sf)
    facts = extract_facts(pages, census_templates("Lenda"), **FACT_ARGS)
    key = F.regexp_extract("source_url", "[0-9]+$", 0)
    facts = facts.withColumns({"name": F.concat("name", F.lit(" "), key), "record_id": F.concat(F.lit("P-"), key, F.lit("-"), "template")})
    text = facts.select(*[F.col(c).cast("string").alias(c) for c in PROFILE_COLUMNS]).withColumn("level", F.lit(" District "))
    return text.unionByName(text.withColumn("record_id", F.replace("record_id", F.lit("P-"), F.lit("Q-"))))


PROFILE_NAMED = "'Lenda ' || c_custkey AS name, 'P-' || c_custkey || '-' || t AS record_id"
PROFILE_REST = ", ".join(c for c in PROFILE_COLUMNS if c not in ("record_id", "name"))


@query("l4_clean_profile_strict", f"WITH {FACTS_SQL} SELECT {PROFILE_NAMED}, {PROFILE_REST} FROM profile")
def profile_strict(spark, sf):
    return L.clean_profile(profile_table(spark, sf), "strict").clean


@query("l4_clean_profile_lax", f"""
    WITH {FACTS_SQL} SELECT {PROFILE_NAMED}, level, population::DOUBLE AS population, population_year::VARCHAR AS population_year, area_km2, province,
           notes, {sql_clean_punct('notes')} AS notes_clean, source_url FROM profile""")
def profile_lax(spark, sf):
    clean = L.clean_profile(profile_table(spark, sf), "lax").clean
    return clean.select("name", "record_id", "level", "population", "population_year", "area_km2", "province", "notes", "notes_clean", "source_url")


# --- review, contacts, profile, summary -----------------------------------------------------------


@query("l5_build_reviewed", """
    SELECT printf('REC-%03d', row_number() OVER (ORDER BY DATE '2024-01-01' + (d.doc_id % 60)::INTEGER, 'https://d.example.org/' || d.doc_id, 'Project ' || quality, lang)) AS project_id,
           'Project ' || quality AS project_name, source AS sector, NULL::VARCHAR AS constituency, 'CDF' AS funding_source, n_chars * 10.5::DOUBLE AS funding_amount_zmw,
           CASE WHEN toxic = 1 THEN 'planned' ELSE 'completed' END AS status, DATE '2024-01-01' + (d.doc_id % 60)::INTEGER AS date_reported, lang AS description,
           'https://d.example.org/' || d.doc_id AS source_url FROM labels l JOIN documents d ON l.doc_id = d.doc_id""")
def reviewed(spark, sf):
    documents = table(spark, sf, "documents")
    posts = documents.select(F.col("doc_id").alias("id"), F.date_add(F.lit("2024-01-01").cast("date"), (F.col("doc_id") % 60).cast("int")).alias("date"),
                             F.concat(F.lit("https://d.example.org/"), "doc_id").alias("link"))
    decisions = table(spark, sf, "labels").join(documents, "doc_id").select(
        F.col("doc_id").alias("post_id"), F.concat(F.lit("Project "), "quality").alias("name"), F.col("source").alias("sector"),
        F.lit(None).cast("string").alias("place"), (F.col("n_chars") * 10.5).alias("amount"),
        F.when(F.col("toxic") == 1, "planned").otherwise("completed").alias("status"), F.col("lang").alias("summary"))
    return build_reviewed(decisions, posts)


SQL_CONTACT_TEXT = sql_strip_plain("'<title>Page of ' || source || ' – Town Site and more</title><p>' || text || '</p>'")


@query("l6_collect_contacts", f"""
    WITH t AS (SELECT doc_id, source, {SQL_CONTACT_TEXT} AS text FROM documents),
    c AS (SELECT doc_id, source, text, {sql_distinct_list(f"regexp_extract_all(text, {q(f'[{WORD[1:-1]}.+-]+@[{WORD[1:-1]}.-]+[.][A-Za-z]{{2,}}')})")} AS emails,
                 {sql_distinct_list(f"regexp_extract_all(text, {q(SQL_PHONE)})")} AS phones FROM t),
    f AS (SELECT 0 AS src, doc_id AS seq, NULL::VARCHAR AS id, NULL::VARCHAR AS name, nullif(array_to_string(phones, '; '), '') AS phone, nullif(array_to_string(emails, '; '), '') AS email,
                 'Page of ' || source AS source_page, 'https://d.example.org/' || doc_id AS source_url FROM c WHERE len(emails) > 0 OR len(phones) > 0
          UNION ALL SELECT 1, s_suppkey, CASE WHEN s_nationkey < 5 THEN 'KEEP-' || s_suppkey END, s_name, '0977' || s_nationkey, NULL, NULL, 'https://s.example.org/' || s_nationkey FROM supplier),
    d AS (SELECT source_url, email, phone, arg_max(id, (src, seq)) AS i0, arg_max(name, (src, seq)) AS n0, arg_max(source_page, (src, seq)) AS p0,
                 max((src, seq)) AS last, min((src, seq)) AS pos FROM f GROUP BY source_url, email, phone),
    l AS (SELECT d.source_url, d.email, d.phone, f.id, f.name, f.source_page, pos FROM d JOIN f ON (f.src, f.seq) = last AND f.source_url = d.source_url)
    SELECT coalesce(id, printf('REC-%03d', row_number() OVER (ORDER BY pos))) AS record_id, name, phone, email, source_page, source_url FROM l""")
def contacts(spark, sf):
    pages = table(spark, sf, "documents").select(
        F.col("doc_id").alias("page_id"), F.concat(F.lit("https://d.example.org/"), "doc_id").alias("url"),
        F.concat(F.lit("<title>Page of "), "source", F.lit(" – Town Site and more</title><p>"), "text", F.lit("</p>")).alias("html"))
    manual = table(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("page_id"), F.when(F.col("s_nationkey") < 5, F.concat(F.lit("KEEP-"), "s_suppkey")).alias("record_id"),
        F.col("s_name").alias("name"), F.concat(F.lit("0977"), "s_nationkey").alias("phone"),
        F.concat(F.lit("https://s.example.org/"), "s_nationkey").alias("source_url"))
    found = collect_contacts(pages, manual, site_name="Town Site")
    return found.select("record_id", "name", "phone", "email", "source_page", "source_url")


@query("l7_collect_profile", f"""
    WITH {FACTS_SQL},
    u AS (SELECT 0 AS kind, c_custkey AS seq, t, * EXCLUDE (c_custkey, t) FROM profile
          UNION ALL SELECT 1, c_custkey, 0, 'constituency', 'Sina', NULL, NULL, NULL, NULL, NULL, NULL, 'Southern', NULL, 'Named on the page', 'https://facts.example.org/' || c_custkey, NULL FROM customer)
    SELECT printf('DIST-%03d', row_number() OVER (ORDER BY kind, seq, t)) AS record_id, * EXCLUDE (kind, seq, t) FROM u""")
def profile(spark, sf):
    pages = fact_pages(spark, sf).select(F.col("c_custkey").alias("page_id"), "url", F.concat(
        F.lit("<html><style>p{}</style><p>"), F.replace("text", F.lit(" "), F.lit(" &nbsp;")), F.lit("</p></html>")).alias("html"))
    mentions = {"Sina": {"level": "constituency", "name": "Sina", "province": "Southern", "notes": "Named on the page"}}
    return collect_profile(pages, census_templates("Lenda"), mentions=mentions, id_prefix="DIST-", **FACT_ARGS)


@query("l8_master_summary", " UNION ALL ".join([
    sql_summary("events", COPIED_EVENTS, 4, ["value"]), sql_summary("customers", "(SELECT c_nationkey, c_mktsegment FROM customer)", 2, []),
    sql_summary("documents", "(SELECT text, lang, n_chars FROM documents)", 3, ["n_chars"]),
    sql_summary("lines", "(SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice FROM lineitem)", 4, ["l_quantity", "l_extendedprice"])]))
def summary(spark, sf):
    return master_summary({
        "events": (copied_events(spark, sf), ["value"]),
        "customers": (table(spark, sf, "customer").select("c_nationkey", "c_mktsegment"), []),
        "documents": (table(spark, sf, "documents").select("text", "lang", "n_chars"), ["n_chars"]),
        "lines": (table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice"), ["l_quantity", "l_extendedprice"]),
    })
