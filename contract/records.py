"""D, J, K, U: duplicates, joins, ids, unions."""

from __future__ import annotations

from pyspark.sql import functions as F

from contract.base import query, table
from trailkeep.operators import dedup as D
from trailkeep.operators import order as K
from trailkeep.operators.joins import apply_review
from trailkeep.operators.outliers import apply_fences, iqr_fences
from trailkeep.operators.quality import frames_equal

# --- duplicates -----------------------------------------------------------------------------------


@query("d1_dedup_keep_first", """
    SELECT doc_id, md5(text) AS text_md5, lang, source FROM documents
    QUALIFY row_number() OVER (PARTITION BY text ORDER BY doc_id) = 1""")
def first_documents(spark, sf):
    documents = table(spark, sf, "documents").select("doc_id", "text", "lang", "source")
    return D.dedup_keep_first(documents, "text", "doc_id").select("doc_id", F.md5("text").alias("text_md5"), "lang", "source")


@query("d2_dedup_except_id", """
    WITH u AS (SELECT * FROM customer UNION ALL SELECT c_custkey + 1000000, c_name, c_nationkey, c_acctbal,
                      CASE WHEN c_nationkey < 12 THEN c_mktsegment END FROM customer)
    SELECT min(c_custkey) AS c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM u GROUP BY ALL""")
def customers_but_id(spark, sf):
    customer = table(spark, sf, "customer")
    copies = customer.withColumns({
        "c_custkey": F.col("c_custkey") + 1000000, "c_mktsegment": F.when(F.col("c_nationkey") < 12, F.col("c_mktsegment"))})
    return D.dedup_except_id(customer.unionByName(copies), "c_custkey")


@query("d3_dedup_last_wins", """
    SELECT user_id, event_type, arg_max(event_id, event_id) AS event_id, arg_max(value, event_id) AS value, min(event_id) AS position
    FROM events GROUP BY user_id, event_type""")
def last_events(spark, sf):
    events = table(spark, sf, "events").select("user_id", "event_type", "event_id", "value")
    return D.dedup_last_wins(events, ["user_id", "event_type"], "event_id")


@query("d4_dedup_by_url_checked", "SELECT page_id, url, md5(html) AS html_md5 FROM pages")
def one_page_per_url(spark, sf):
    pages = table(spark, sf, "pages")
    copies = pages.withColumn("page_id", F.col("page_id") + 1000000)
    # What the check refuses, a URL saved with different contents, stays for review: one page per content.
    settled, disputed = D.split_by_url(pages.unionByName(copies), "url", "page_id")
    kept = D.dedup_by_url_checked(settled, "url", "page_id").unionByName(D.dedup_except_id(disputed, "page_id"))
    return kept.select("page_id", "url", F.md5("html").alias("html_md5"))


@query("d5_distinct_ordered", """
    SELECT text, min(conv_id * 1000 + turn) AS position FROM conversations GROUP BY text""")
def ordered_texts(spark, sf):
    turns = table(spark, sf, "conversations").withColumn("position", F.col("conv_id") * 1000 + F.col("turn"))
    return D.distinct_ordered(turns, "text", "position")


@query("d6_duplicate_counts", """
    SELECT 'text' AS key_set, count(*) AS rows, count(*) - count(DISTINCT text) AS surplus FROM documents
    UNION ALL SELECT 'text and source', count(*), count(*) - (SELECT count(*) FROM (SELECT DISTINCT text, source FROM documents)) FROM documents
    UNION ALL SELECT 'source', count(*), count(*) - count(DISTINCT source) FROM documents""")
def surplus_documents(spark, sf):
    return D.duplicate_counts(table(spark, sf, "documents"), {
        "text": ["text"], "text and source": ["text", "source"], "source": ["source"]})


@query("d7_near_duplicates", """
    WITH u AS (SELECT page_id, url, title FROM (SELECT page_id, url, regexp_extract(html, '<title>(.*?)</title>', 1) AS title FROM pages)
               UNION ALL SELECT page_id + 1000000, url, CASE WHEN contains(url, 'blog') THEN 'changed' ELSE regexp_extract(html, '<title>(.*?)</title>', 1) END FROM pages),
    d AS (SELECT min(page_id) AS page_id, url, title FROM u GROUP BY url, title)
    SELECT page_id, url, title FROM d QUALIFY count(*) OVER (PARTITION BY url) > 1""")
def page_variants(spark, sf):
    pages = table(spark, sf, "pages").select("page_id", "url", F.regexp_extract("html", "<title>(.*?)</title>", 1).alias("title"))
    variants = pages.withColumns({
        "page_id": F.col("page_id") + 1000000,
        "title": F.when(F.contains("url", F.lit("blog")), F.lit("changed")).otherwise(F.col("title"))})
    return D.near_duplicates(pages.unionByName(variants), "url", "page_id")


@query("d8_conflicting_observations", """
    WITH u AS (SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier UNION ALL
               SELECT s_suppkey + 1000000, s_name, s_nationkey, CASE WHEN s_acctbal < 3000 THEN s_acctbal + 1 ELSE s_acctbal END FROM supplier),
    d AS (SELECT min(s_suppkey) AS s_suppkey, s_name, s_nationkey, s_acctbal FROM u GROUP BY ALL)
    SELECT * FROM d QUALIFY count(*) OVER (PARTITION BY s_name, s_nationkey) > 1""")
def supplier_conflicts(spark, sf):
    supplier = table(spark, sf, "supplier")
    other = supplier.withColumns({
        "s_suppkey": F.col("s_suppkey") + 1000000,
        "s_acctbal": F.when(F.col("s_acctbal") < 3000, F.col("s_acctbal") + 1).otherwise(F.col("s_acctbal"))})
    return D.conflicting_observations(supplier.unionByName(other), ["s_name", "s_nationkey"], "s_suppkey")


# --- joins ----------------------------------------------------------------------------------------


@query("j1_apply_review", """
    SELECT l.doc_id, quality, toxic, lang, source, n_chars FROM labels l JOIN documents d ON l.doc_id = d.doc_id""")
def labelled_documents(spark, sf):
    return apply_review(table(spark, sf, "labels"), table(spark, sf, "documents"), "doc_id", ["lang", "source", "n_chars"])


@query("j2_keep_flagged", """
    SELECT doc_id, source, md5(text) AS text_md5 FROM documents QUALIFY count(*) OVER (PARTITION BY text) > 1""")
def copied_documents(spark, sf):
    flagged = D.keep_flagged(table(spark, sf, "documents").select("doc_id", "source", "text"), "text")
    return flagged.select("doc_id", "source", F.md5("text").alias("text_md5"))


@query("j3_apply_fences", """
    WITH f AS (SELECT l_returnflag, quantile_cont(l_extendedprice, 0.25) AS q1, quantile_cont(l_extendedprice, 0.75) AS q3
               FROM lineitem GROUP BY l_returnflag)
    SELECT l_orderkey, l_linenumber, l_returnflag, round(q1 - 1.5 * (q3 - q1), 6) AS lower, round(q3 + 1.5 * (q3 - q1), 6) AS upper
    FROM lineitem JOIN f USING (l_returnflag)""")
def fenced_lines(spark, sf):
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag", "l_extendedprice")
    fences = iqr_fences(lines, ["l_extendedprice"], ["l_returnflag"])
    fenced = apply_fences(lines, fences, ["l_extendedprice"], ["l_returnflag"])
    return fenced.select("l_orderkey", "l_linenumber", "l_returnflag",
                         F.round("__lower_l_extendedprice", 6).alias("lower"), F.round("__upper_l_extendedprice", 6).alias("upper"))


# --- order, ids, sets -----------------------------------------------------------------------------


@query("k1_sort_records", """
    SELECT o_orderkey, o_orderdate::DATE AS day, o_orderpriority FROM orders ORDER BY day, o_orderpriority, o_orderkey""")
def sorted_orders(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("day"), "o_orderpriority")
    return K.sort_records(orders, ["day", "o_orderpriority", "o_orderkey"])


@query("k2_assign_ids", """
    SELECT printf('ORD-%03d', row_number() OVER (ORDER BY o_orderdate, o_orderpriority, o_orderkey)) AS record_id, o_orderkey, o_totalprice
    FROM orders""")
def numbered_orders(spark, sf):
    numbered = K.assign_ids(table(spark, sf, "orders"), ["o_orderdate", "o_orderpriority", "o_orderkey"], "ORD-%03d")
    return numbered.select("record_id", "o_orderkey", "o_totalprice")


@query("k3_assign_missing_ids", """
    SELECT CASE WHEN s_nationkey < 10 THEN 'OLD-' || s_suppkey
                ELSE printf('SUP-%03d', row_number() OVER (ORDER BY s_name, s_suppkey)) END AS record_id, s_suppkey, s_name
    FROM supplier""")
def completed_ids(spark, sf):
    supplier = table(spark, sf, "supplier").select("s_suppkey", "s_name", F.when(
        F.col("s_nationkey") < 10, F.concat(F.lit("OLD-"), "s_suppkey")).when(F.col("s_nationkey") < 15, "").alias("record_id"))
    return K.assign_missing_ids(supplier, ["s_name", "s_suppkey"], "SUP-%03d")


@query("u1_union_records", """
    SELECT c_name AS name, c_nationkey AS nation, c_acctbal AS balance, c_mktsegment AS segment FROM customer
    UNION ALL SELECT s_name, s_nationkey, s_acctbal, NULL FROM supplier""")
def parties(spark, sf):
    customer = table(spark, sf, "customer").select(F.col("c_name").alias("name"), F.col("c_nationkey").alias("nation"),
                                                    F.col("c_acctbal").alias("balance"), F.col("c_mktsegment").alias("segment"))
    supplier = table(spark, sf, "supplier").select(F.col("s_name").alias("name"), F.col("s_nationkey").alias("nation"), F.col("s_acctbal").alias("balance"))
    return K.union_records(customer, supplier)


@query("u2_first_nonempty", """
    SELECT url, min(page_id) AS page_id FROM (SELECT url, page_id FROM pages WHERE contains(url, 'blog')
                                             UNION ALL SELECT url, page_id + 5 FROM pages WHERE contains(url, 'blog')) GROUP BY url""")
def discovered(spark, sf):
    pages = table(spark, sf, "pages").select("url", "page_id")
    nothing = pages.filter(F.contains("url", F.lit("no such site")))
    blogs = pages.filter(F.contains("url", F.lit("blog")))
    twice = K.union_records(blogs.withColumn("page_id", F.col("page_id") + 5), blogs)
    return K.discover(nothing, nothing, twice, pages, key="url", order="page_id")


@query("u3_frames_equal", """
    SELECT (SELECT count(*) FROM customer) AS left_rows, (SELECT count(*) FROM customer WHERE c_nationkey > 0) AS right_rows,
           (SELECT count(*) FROM customer WHERE c_nationkey = 0 OR c_mktsegment = 'BUILDING') AS only_left,
           (SELECT count(*) FROM customer WHERE c_nationkey > 0 AND c_mktsegment = 'BUILDING') AS only_right, true AS same_columns""")
def compared_customers(spark, sf):
    customer = table(spark, sf, "customer")
    other = customer.filter("c_nationkey > 0").withColumn(
        "c_mktsegment", F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_mktsegment")))
    return frames_equal(customer, other.repartition(5))


@query("u4_only_new", "SELECT page_id, url FROM pages WHERE NOT contains(url, 'example.net')")
def new_links(spark, sf):
    pages = table(spark, sf, "pages").select("page_id", "url")
    return K.only_new(pages, pages.filter(F.contains("url", F.lit("example.net"))), "url")
