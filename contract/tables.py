"""C, M: classification and cell policies."""

from __future__ import annotations

from pyspark.sql import functions as F

from contract.base import WORD, WS, q, query, sql_any, sql_collapse, sql_strip, sql_unescape, sql_word, table
from trailkeep.functions import classify as C
from trailkeep.functions import values as V
from trailkeep.functions.text import collapse_space
from trailkeep.operators import columns as cols

KEYWORDS = {"first": ("heit", "ouve"), "second": ("erth", "que"), "third": ("ción", "atea")}


@query("c1_classify_keywords", f"""
    SELECT doc_id, CASE WHEN {sql_any('lower(text)', KEYWORDS['first'])} THEN 'first' WHEN {sql_any('lower(text)', KEYWORDS['second'])} THEN 'second'
                        WHEN {sql_any('lower(text)', KEYWORDS['third'])} THEN 'third' ELSE 'other' END AS by_part,
           CASE WHEN {sql_word('lower(text)', 'of|und', '')} THEN 'word' ELSE 'none' END AS by_word FROM documents""")
def categories(spark, sf):
    text = F.col("text")
    return table(spark, sf, "documents").select(
        "doc_id", C.classify_keywords(text, KEYWORDS).alias("by_part"),
        C.classify_keywords(text, {"word": ("of", "und")}, default="none", word=True).alias("by_word"))


@query("c2_classify_regex", f"""
    SELECT doc_id, CASE WHEN {sql_word('text', 'les leaux')} THEN 'A' WHEN {sql_word('text', 'of(?:[ ]+the)?')} THEN 'B'
                        WHEN {sql_word('text', 'und')} THEN 'C' END AS place FROM documents""")
def places(spark, sf):
    rules = [("A", "les leaux"), ("B", "of(?:[ ]+the)?"), ("C", "und")]
    return table(spark, sf, "documents").select("doc_id", C.classify_regex(F.col("text"), rules).alias("place"))


@query("c3_classify_funding", """
    SELECT doc_id, CASE WHEN source IN ('src0', 'src1') OR lang = 'de' THEN 'CDF' WHEN lang = 'fr' THEN 'LGEF'
                        WHEN lang = 'es' THEN 'World Bank' END AS funding FROM documents""")
def funding(spark, sf):
    note = F.when(F.col("source").isin("src0", "src1"), " paid by the (CDF).").when(
        F.col("lang") == "de", " Constituency Development Fund and LGEF").when(F.col("lang") == "fr", " lgef, World Bank").when(
        F.col("lang") == "es", " a WORLD BANK loan").otherwise(" mycdf and lgefs")
    return table(spark, sf, "documents").select("doc_id", C.classify_funding(F.concat("text", note)).alias("funding"))


@query("c4_infer_status", """
    SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN NULL
        WHEN '2-HIGH' THEN CASE o_orderstatus WHEN 'F' THEN 'completed' WHEN 'O' THEN 'near_completion' ELSE 'near_completion' END
        WHEN '3-MEDIUM' THEN 'ongoing' WHEN '4-NOT SPECIFIED' THEN 'planned' ELSE NULL END AS status FROM orders""")
def statuses(spark, sf):
    status, level = F.col("o_orderstatus"), F.col("o_orderpriority")
    phrase = (
        F.when(level == "1-URGENT", F.when(status == "F", "The block is NOT  completed but ongoing").when(
            status == "O", "It will be commissioned, as planned").otherwise("yet to be officially opened"))
        .when(level == "2-HIGH", F.when(status == "F", "Handed over while in progress").when(
            status == "O", "about 95 % complete and ongoing").otherwise("Nearing completion, works underway"))
        .when(level == "3-MEDIUM", F.when(status == "F", "works are ongoing, as approved").otherwise("being constructed, proposed"))
        .when(level == "4-NOT SPECIFIED", F.when(status == "F", "Ground-breaking took place").otherwise("To be constructed"))
        .otherwise("unplanned talks were held")
    )
    return table(spark, sf, "orders").select("o_orderkey", C.infer_status(phrase).alias("status"))


# --- cells ----------------------------------------------------------------------------------------


@query("m1_fill_category", """
    SELECT o_orderkey, CASE o_orderstatus WHEN 'P' THEN 'unspecified' WHEN 'O' THEN 'unspecified' ELSE lower(o_orderpriority) END AS status FROM orders""")
def filled(spark, sf):
    raw = F.when(F.col("o_orderstatus") == "F", F.concat(F.lit(" \t"), "o_orderpriority", F.lit("\n"))).when(F.col("o_orderstatus") == "O", " \n\t")
    return table(spark, sf, "orders").select("o_orderkey", V.fill_category(raw).alias("status"))


SQL_NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"
RAW_NUMBER = """CASE event_type WHEN 'view' THEN value::VARCHAR WHEN 'click' THEN props WHEN 'signup' THEN regexp_extract(props, '[0-9]+') || 'd'
                WHEN 'purchase' THEN ' ' || regexp_extract(props, '[0-9]+') || ' ' WHEN 'error' THEN 'NaN' END"""


def raw_numbers(spark, sf):
    digits, kind = F.regexp_extract("props", "[0-9]+", 0), F.col("event_type")
    raw = F.when(kind == "view", F.col("value").cast("string")).when(kind == "click", F.col("props")).when(
        kind == "signup", F.concat(digits, F.lit("d"))).when(kind == "purchase", F.concat(F.lit(" "), digits, F.lit(" "))).when(kind == "error", "NaN")
    return table(spark, sf, "events").select("event_id", raw.alias("amount"))


@query("m2_to_number_checked", f"""
    WITH r AS (SELECT event_id, trim({RAW_NUMBER}) AS raw FROM events),
    n AS (SELECT event_id, CASE WHEN regexp_matches(raw, {q(SQL_NUMBER)}) THEN try_cast(raw AS DOUBLE) END AS amount FROM r)
    SELECT event_id, round(amount, 4) AS amount, amount IS NULL AS lost FROM n""")
def checked_numbers(spark, sf):
    typed, raw = cols.to_number_checked(raw_numbers(spark, sf), "amount")
    return typed.select("event_id", F.round("amount", 4).alias("amount"), V.lost_in_cast(F.col(raw), F.col("amount")).alias("lost"))


@query("m3_to_number_lenient", f"""
    WITH r AS (SELECT event_id, trim({RAW_NUMBER}) AS raw FROM events),
    n AS (SELECT event_id, CASE WHEN regexp_matches(raw, {q(SQL_NUMBER)}) THEN try_cast(raw AS DOUBLE) END AS amount FROM r)
    SELECT event_id, round(amount, 4) AS amount, CASE WHEN amount = floor(amount) THEN amount::BIGINT END AS whole FROM n""")
def lenient_numbers(spark, sf):
    return raw_numbers(spark, sf).select(
        "event_id", F.round(V.to_number(F.col("amount")), 4).alias("amount"), V.to_whole(F.col("amount")).alias("whole"))


@query("m4_to_date_checked", """
    SELECT o_orderkey, CASE WHEN o_orderpriority <> '5-LOW' AND o_orderstatus <> 'P' THEN o_orderdate::DATE END AS day,
           o_orderpriority = '5-LOW' AS lost FROM orders""")
def checked_dates(spark, sf):
    raw = F.when(F.col("o_orderpriority") == "5-LOW", F.date_format("o_orderdate", "yyyy-02-30")).when(
        F.col("o_orderstatus") != "P", F.concat(F.lit(" "), F.date_format("o_orderdate", "yyyy-MM-dd")))
    typed, kept = cols.to_date_checked(table(spark, sf, "orders").select("o_orderkey", raw.alias("day")), "day")
    return typed.select("o_orderkey", "day", V.lost_in_cast(F.col(kept), F.col("day")).alias("lost"))


@query("m5_standardize_categories", "SELECT c_custkey, lower(c_mktsegment) AS c_mktsegment FROM customer")
def standardized(spark, sf):
    customer = table(spark, sf, "customer").select("c_custkey", F.concat(F.lit("\t "), "c_mktsegment", F.lit(" \n")).alias("c_mktsegment"))
    return cols.standardize_categories(customer, ["c_mktsegment", "absent"])


SQL_HEAD = "regexp_extract(html, '(?s)<title>.*?</title>|<footer>.*?</footer>', 0)"


@query("m6_normalize_text", f"""
    SELECT page_id, nullif(CASE WHEN contains(url, 'spam') THEN '' ELSE {sql_collapse(sql_unescape("regexp_extract(html, '(?s)<footer>(.*)</footer>', 1)"))} END, '') AS footer,
           url AS source_url FROM pages""")
def normalized(spark, sf):
    footer = F.when(F.contains("url", F.lit("spam")), " \t ").otherwise(F.regexp_extract("html", "(?s)<footer>(.*)</footer>", 1))
    pages = table(spark, sf, "pages").select("page_id", footer.alias("footer"), F.concat(F.lit(" "), "url", F.lit("\n")).alias("source_url"))
    return cols.normalize_text(pages)


SQL_RUN = rf"[+]?\p{{Nd}}[\p{{Nd}}{WS[1:-1]}().-]{{6,}}\p{{Nd}}"


@query("m7_normalize_phone", f"""
    WITH p AS (SELECT doc_id, {sql_collapse('text')} AS phone FROM documents),
    r AS (SELECT doc_id, phone, regexp_extract_all(phone, {q(SQL_RUN)}) AS runs FROM p)
    SELECT doc_id, md5(CASE WHEN len(runs) > 0 THEN array_to_string(runs, '; ') ELSE phone END) AS phones, md5(phone) AS collapsed FROM r""")
def phones(spark, sf):
    return table(spark, sf, "documents").select(
        "doc_id", F.md5(V.normalize_phone(F.col("text"))).alias("phones"), F.md5(collapse_space(F.col("text"))).alias("collapsed"))


@query("m8_normalize_email", f"""
    SELECT doc_id, lower(regexp_extract(text, {q(f'{WORD}+@[A-Za-z0-9.]+')})) AS email FROM documents""")
def emails(spark, sf):
    found = F.upper(F.regexp_extract("text", f"{WORD}+@[A-Za-z0-9.]+", 0))
    return table(spark, sf, "documents").select("doc_id", V.normalize_email(found).alias("email"))


@query("m9_parse_grouped_int", """
    SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN NULL ELSE (floor(o_totalprice) * 1000)::BIGINT END AS amount FROM orders""")
def grouped_ints(spark, sf):
    raw = F.when(F.col("o_orderstatus") == "F", "").otherwise(F.format_number(F.floor("o_totalprice") * 1000, 0))
    return table(spark, sf, "orders").select("o_orderkey", V.parse_grouped_int(raw).alias("amount"))


@query("m10_nulls_to_blank", """
    SELECT d.doc_id AS doc_id, lang, coalesce(quality::VARCHAR, '') AS quality, coalesce(toxic::VARCHAR, '') AS toxic
    FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""")
def blanks(spark, sf):
    joined = table(spark, sf, "documents").select("doc_id", "lang").join(table(spark, sf, "labels"), "doc_id", "left")
    return cols.nulls_to_blank(joined, keep=["doc_id", "lang"])
