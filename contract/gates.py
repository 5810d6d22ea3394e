"""V: data-quality gates, each over a table where some rows fail."""

from __future__ import annotations

from pyspark.sql import functions as F

from contract.base import WS, q, query, table
from trailkeep.functions import values as V
from trailkeep.operators import columns as cols
from trailkeep.operators import quality as Q


def sql_rule(name: str, condition: str, key: str, relation: str) -> str:
    return f"SELECT {q(name)} AS rule, count(*) AS failures, min({key})::VARCHAR AS sample_key FROM {relation} WHERE {condition}"


@query("v1_no_cast_loss", sql_rule("number survives", "event_type NOT IN ('view', 'purchase')", "event_id", "events"))
def cast_loss(spark, sf):
    kind = F.col("event_type")
    raw = F.when(kind == "view", F.col("value").cast("string")).when(kind == "purchase", F.lit(" ")).otherwise(F.col("props"))
    typed, kept = cols.to_number_checked(table(spark, sf, "events").select("event_id", raw.alias("amount")), "amount")
    return Q.validate(typed, [Q.no_cast_loss("number survives", kept, "amount")], "event_id")


@query("v2_positive", sql_rule("balance is positive", "c_acctbal <= 0", "c_custkey", "customer"))
def positive_balance(spark, sf):
    return Q.validate(table(spark, sf, "customer"), [Q.positive("balance is positive", "c_acctbal")], "c_custkey")


@query("v3_not_negative_and_whole",
       sql_rule("balance is not negative", "c_acctbal < 0", "c_custkey", "customer") + " UNION ALL "
       + sql_rule("balance is whole", "c_acctbal % 1 <> 0", "c_custkey", "customer"))
def counts(spark, sf):
    return Q.validate(table(spark, sf, "customer"), [
        Q.not_negative("balance is not negative", "c_acctbal"), Q.whole("balance is whole", "c_acctbal")], "c_custkey")


@query("v4_allowed", sql_rule("known priority", "o_orderstatus = 'P' OR o_orderpriority NOT IN ('1-URGENT', '2-HIGH')", "o_orderkey", "orders"))
def known_priority(spark, sf):
    orders = table(spark, sf, "orders").withColumn("o_orderpriority", F.when(F.col("o_orderstatus") != "P", F.col("o_orderpriority")))
    return Q.validate(orders, [Q.allowed("known priority", "o_orderpriority", ["1-URGENT", "2-HIGH"])], "o_orderkey")


@query("v5_requires", sql_rule(
    "a length has its quality", "n_chars > 100 AND quality IS NULL", "d.doc_id", "documents d LEFT JOIN labels l ON d.doc_id = l.doc_id"))
def labelled(spark, sf):
    joined = table(spark, sf, "documents").select("doc_id", F.when(F.col("n_chars") > 100, F.col("n_chars")).alias("n_chars")).join(
        table(spark, sf, "labels"), "doc_id", "left")
    return Q.validate(joined, [Q.requires("a length has its quality", "n_chars", "quality")], "doc_id")


@query("v6_adds_up", sql_rule("lines add up", "l_returnflag <> 'R' AND l_linenumber + l_suppkey <> l_partkey", "l_orderkey", "lineitem"))
def sums(spark, sf):
    lines = table(spark, sf, "lineitem").withColumn("l_suppkey", F.when(F.col("l_returnflag") != "R", F.col("l_suppkey")))
    return Q.validate(lines, [Q.adds_up("lines add up", ["l_linenumber", "l_suppkey"], "l_partkey")], "l_orderkey")


@query("v7_web_source",
       sql_rule("source is named", "contains(url, 'utm')", "page_id", "pages") + " UNION ALL "
       + sql_rule("source is a web address", "contains(url, 'utm') OR contains(url, 'blog')", "page_id", "pages"))
def sources(spark, sf):
    url = F.when(F.contains("url", F.lit("utm")), F.lit(" ")).when(
        F.contains("url", F.lit("blog")), F.replace("url", F.lit("://"), F.lit(":"))).otherwise(F.col("url"))
    pages = table(spark, sf, "pages").select("page_id", url.alias("url"))
    return Q.validate(pages, [Q.present("source is named", "url"), Q.web_url("source is a web address", "url")], "page_id")


@query("v8_unique_id", """
    WITH k AS (SELECT CASE WHEN n_chars < 60 THEN NULL ELSE md5(text) END AS id, doc_id FROM documents),
    d AS (SELECT id, count(*) AS n, min(doc_id::VARCHAR) AS k FROM k WHERE id IS NOT NULL GROUP BY id HAVING count(*) > 1)
    SELECT 'id is present' AS rule, count(*) AS failures, min(doc_id)::VARCHAR AS sample_key FROM k WHERE id IS NULL
    UNION ALL SELECT 'id is unique', coalesce(sum(n), 0)::BIGINT, min(k) FROM d""")
def unique_ids(spark, sf):
    documents = table(spark, sf, "documents").select("doc_id", F.when(F.col("n_chars") >= 60, F.md5("text")).alias("id"))
    return Q.validate(documents, [Q.present("id is present", "id"), Q.unique("id is unique", "id")], "doc_id")


@query("v9_columns", "SELECT c_custkey, c_acctbal, 2 AS lacking FROM customer")
def complete_columns(spark, sf):
    customer = table(spark, sf, "customer").select("c_custkey", "c_acctbal")
    Q.same_columns(customer, ["c_custkey", "c_acctbal"])
    try:
        Q.required_columns(customer, ["c_custkey", "phone", "email"])
        lacking = 0
    except Q.GateError as error:
        lacking = error.failed[0][1]
    return customer.withColumn("lacking", F.lit(lacking))


@query("v10_email_form", f"""
    WITH e AS (SELECT doc_id, CASE WHEN lang = 'de' THEN NULL WHEN lang = 'fr' THEN source || '@' || lang || '.org'
                                   ELSE regexp_extract(text, {q(f'[^{WS[1:-1]}]+')}) || '@x.org' END AS email FROM documents)
    SELECT 'e-mail form' AS rule, count(*) AS failures, min(doc_id)::VARCHAR AS sample_key FROM e
    WHERE email IS NOT NULL AND NOT regexp_full_match(email, {q(f'[^{WS[1:-1]}@]+@[^{WS[1:-1]}@]+[.][^{WS[1:-1]}@]+')})""")
def email_forms(spark, sf):
    lang = F.col("lang")
    email = F.when(lang == "fr", F.concat("source", F.lit("@"), "lang", F.lit(".org"))).when(
        lang != "de", F.concat(F.regexp_extract("text", f"[^{WS[1:-1]}]+", 0), F.lit("@x.org")))
    return Q.validate(table(spark, sf, "documents").select("doc_id", email.alias("email")), [Q.email_form("e-mail form", "email")], "doc_id")


@query("v2_failing_rows", "SELECT c_custkey, c_acctbal FROM customer WHERE c_acctbal <= 0")
def rows_for_review(spark, sf):
    return Q.failing_rows(table(spark, sf, "customer"), Q.positive("balance is positive", "c_acctbal")).select("c_custkey", V.nan_to_null(F.col("c_acctbal")).alias("c_acctbal"))
