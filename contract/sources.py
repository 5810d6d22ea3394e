"""S: sources and sinks."""

from __future__ import annotations

from pyspark.sql import functions as F

from contract.base import q, query, scratch, sql_strip_html, table
from trailkeep.operators.columns import align_to_schema, standardize_categories
from trailkeep.operators.quality import RowRule, quarantine
from trailkeep.plans.collect import CONTACT_SCHEMA
from trailkeep.sources.delimited import read_delimited, verify_round_trip, write_delimited, write_if_changed
from trailkeep.sources.snapshot import audit_report, snapshot_once
from trailkeep.sources.web import read_pages, read_post_index, read_sitemap


@query("s1_read_delimited", """
    SELECT c_custkey, c_name, c_nationkey, c_acctbal,
           CASE WHEN c_mktsegment IN ('MACHINERY', 'FURNITURE', 'BUILDING') THEN NULL ELSE c_mktsegment END AS c_mktsegment
    FROM customer""")
def read_with_missing_tokens(spark, sf):
    path = scratch(spark)
    tokens = F.when(F.col("c_mktsegment") == "MACHINERY", "NA").when(F.col("c_mktsegment") == "FURNITURE", "").when(
        F.col("c_mktsegment") == "BUILDING", "nan").otherwise(F.col("c_mktsegment"))
    customer = table(spark, sf, "customer").withColumn("c_mktsegment", tokens)
    write_delimited(customer, path)
    return read_delimited(spark, path, customer.schema)


@query("s2_read_pages", "SELECT url, length(html)::INTEGER AS html_length, md5(html) AS html_md5 FROM pages")
def page_table(spark, sf):
    return read_pages(spark, f"{sf}/pages.parquet").select(
        "url", F.length("html").alias("html_length"), F.md5("html").alias("html_md5"))


def post_files(spark, posts) -> str:
    """A post index in JSON lines of (number, turn, link, role, text)."""
    path = scratch(spark)
    day = F.date_add(F.to_date(F.lit("2024-01-01")), (F.col("turn") % 28).cast("int"))
    post = F.struct(
        F.col("number").alias("id"), F.concat(day.cast("string"), F.lit("T08:00:00")).alias("date"), "link",
        F.struct(F.concat(F.lit("<b>"), "role", F.lit("</b>")).alias("rendered")).alias("title"),
        F.struct(F.concat(F.lit("<p>"), "text", F.lit("</p>")).alias("rendered")).alias("content"),
    )
    posts.select(F.to_json(F.array(post)).alias("value")).write.text(path)
    return path


@query("s3_read_post_index", f"""
    SELECT conv_id * 1000 + turn AS id, DATE '2024-01-01' + (turn % 28)::INTEGER AS date,
           'https://posts.example.org/?p=' || (conv_id * 1000 + turn) AS link, role AS title,
           {sql_strip_html("'<p>' || text || '</p>'")} AS body
    FROM conversations""")
def post_index(spark, sf):
    number = F.col("conv_id") * 1000 + F.col("turn")
    posts = table(spark, sf, "conversations").select(
        number.alias("number"), "turn", F.concat(F.lit("https://posts.example.org/?p="), number).alias("link"), "role", "text")
    return read_post_index(spark, post_files(spark, posts), multi_line=False)


@query("s4_read_sitemap", """
    SELECT trim(url) AS url FROM pages
    WHERE contains(lower(url), 'blog') OR contains(lower(url), 'page') OR contains(lower(url), 'spam')""")
def sitemap(spark, sf):
    path = scratch(spark)
    loc = F.replace("url", F.lit("&"), F.lit("&amp;"))
    table(spark, sf, "pages").select(F.concat(F.lit("<url><loc> "), loc, F.lit(" </loc></url>"))).write.text(path)
    return read_sitemap(spark, path, slug_words=("blog", "page", "spam"))


@query("s5_align_to_schema", """
    SELECT s_suppkey::VARCHAR AS record_id, s_name AS name, NULL::VARCHAR AS role_title, NULL::VARCHAR AS department,
           NULL::VARCHAR AS phone, NULL::VARCHAR AS email, NULL::VARCHAR AS office_address,
           'suppliers' AS source_page, 'https://example.org/?s=' || s_suppkey AS source_url
    FROM supplier""")
def aligned_contacts(spark, sf):
    manual = table(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("record_id"), F.col("s_name").alias("name"), F.lit("suppliers").alias("source_page"),
        F.concat(F.lit("https://example.org/?s="), "s_suppkey").alias("source_url"), F.col("s_acctbal"))
    return align_to_schema(manual, CONTACT_SCHEMA)


@query("s6_snapshot_once", "SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders")
def preserved_orders(spark, sf):
    path = scratch(spark)
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    snapshot_once(orders, path)
    return snapshot_once(orders.withColumn("o_totalprice", F.lit(0.0)), path)


@query("s7_write_delimited", """
    SELECT o_orderkey, o_totalprice * 1000 AS o_totalprice, o_orderdate::DATE AS o_orderdate,
           o_orderpriority || '|"' AS o_orderpriority,
           CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderstatus END AS o_orderstatus
    FROM orders""")
def exported_orders(spark, sf):
    path = scratch(spark)
    frame = table(spark, sf, "orders").select(
        "o_orderkey", (F.col("o_totalprice") * 1000).alias("o_totalprice"), F.to_date("o_orderdate").alias("o_orderdate"),
        F.concat("o_orderpriority", F.lit('|"')).alias("o_orderpriority"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")).alias("o_orderstatus"))
    write_delimited(frame, path)
    return read_delimited(spark, path, frame.schema)


@query("s8_write_if_changed", """
    SELECT s_suppkey, s_name, s_nationkey, round(s_acctbal + 1, 2) AS s_acctbal,
           true AS first_write, false AS second_write, true AS changed_write FROM supplier""")
def rewritten_suppliers(spark, sf):
    path = scratch(spark)
    supplier = table(spark, sf, "supplier")
    first, second = write_if_changed(supplier, path), write_if_changed(supplier.repartition(3), path)
    changed = write_if_changed(supplier.withColumn("s_acctbal", F.round(F.col("s_acctbal") + 1, 2)), path)
    return read_delimited(spark, path, supplier.schema).select(
        "*", F.lit(first).alias("first_write"), F.lit(second).alias("second_write"), F.lit(changed).alias("changed_write"))


@query("s9_verify_round_trip", """
    SELECT count(*) AS left_rows, count(*) AS right_rows, count(*) - count(*) AS only_left,
           0::BIGINT AS only_right, true AS same_columns FROM customer""")
def round_trip(spark, sf):
    path = scratch(spark)
    customer = table(spark, sf, "customer")
    write_delimited(customer, path)
    return verify_round_trip(customer, path)


@query("s10_quarantine", f"""
    SELECT doc_id, CASE WHEN n_chars < 60 THEN 'too short' WHEN contains(text, '|') THEN 'separator in text'
                        WHEN regexp_matches(text, {q('[0-9]{6}')}) THEN 'long number' END AS error
    FROM documents""")
def quarantined_documents(spark, sf):
    good, rejects = quarantine(table(spark, sf, "documents"), [
        RowRule("too short", F.col("n_chars") < 60),
        RowRule("separator in text", F.contains("text", F.lit("|"))),
        RowRule("long number", F.col("text").rlike("[0-9]{6}")),
    ])
    return rejects.select("doc_id", "error").unionByName(good.select("doc_id", F.lit(None).cast("string").alias("error")))


def audit_rows(stage: str, relation: str, types: dict[str, str]) -> list[str]:
    """The audit of one table; statistics of numbers and dates (as days) with four decimals."""
    rows = [f"SELECT '{stage}' AS stage, 'rows' AS metric, count(*)::VARCHAR AS value FROM {relation} t", f"SELECT '{stage}', 'columns', '{len(types)}'"]
    for c, kind in types.items():
        rows.append(f"SELECT '{stage}', 'missing {c}', (count(*) - count({c}))::VARCHAR FROM {relation} t")
        rows.append(f"SELECT '{stage}', 'type {c}', '{kind}'")
        if kind == "string":
            rows.append(f"SELECT '{stage}', 'unique {c}', count(DISTINCT {c})::VARCHAR FROM {relation} t")
            top = f"(SELECT {c} AS v, count(*) AS n FROM {relation} t WHERE {c} IS NOT NULL GROUP BY 1 ORDER BY n DESC, v LIMIT 1)"
            rows.append(f"SELECT '{stage}', 'top {c}', v FROM {top} t")
            rows.append(f"SELECT '{stage}', 'freq {c}', n::VARCHAR FROM {top} t")
        else:
            x = f"({c} - DATE '1970-01-01')::DOUBLE" if kind == "date" else f"{c}::DOUBLE"
            asked = {"mean": f"avg({x})", "std": f"stddev_samp({x})", "min": f"min({x})", "max": f"max({x})",
                     **{f"q{i}": f"quantile_cont({x}, {i / 4})" for i in (1, 2, 3)}}
            rows += [f"SELECT '{stage}', '{m} {c}', round({v}, 4)::DECIMAL(38, 4)::VARCHAR FROM {relation} t" for m, v in asked.items()]
    return rows


def rounded(audit):
    """The audit with its statistics of numbers given with four decimals."""
    numbers = F.col("metric").rlike("^(mean|std|min|max|q[123]|lower|upper) ")
    text = F.round(F.col("value").try_cast("double"), 4).cast("decimal(38,4)").cast("string")
    return audit.withColumn("value", F.when(numbers, text).otherwise(F.col("value")))


def _audit_sql() -> str:
    frames = {"before": "customer", "after": "(SELECT c_custkey, c_name, c_nationkey, c_acctbal, lower(trim(c_mktsegment)) AS c_mktsegment FROM customer WHERE c_acctbal > 0)"}
    types = {"c_custkey": "bigint", "c_name": "string", "c_nationkey": "int", "c_acctbal": "double", "c_mktsegment": "string"}
    rows = []
    for stage, relation in frames.items():
        rows += audit_rows(stage, relation, types)
    rows.append("SELECT 'decision', 'rows removed', count(*)::VARCHAR FROM customer WHERE c_acctbal <= 0")
    return "SELECT 'customer' AS file, * FROM (" + " UNION ALL ".join(rows) + ")"


@query("s11_audit_report", _audit_sql())
def customer_audit(spark, sf):
    before = table(spark, sf, "customer")
    after = standardize_categories(before.filter("c_acctbal > 0"), ["c_mktsegment", "status"])
    return rounded(audit_report(before, after, {"rows removed": before.filter("c_acctbal <= 0").count()}, "customer"))
