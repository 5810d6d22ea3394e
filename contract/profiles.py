"""A, O: profiles and outliers."""

from __future__ import annotations

from pyspark.sql import functions as F

from contract.base import query, table
from trailkeep.operators import outliers as O
from trailkeep.operators import profile as A
from trailkeep.operators.quality import GateError

# --- profiles -------------------------------------------------------------------------------------


@query("a1_shape", "SELECT count(*) AS rows, 11 AS columns FROM lineitem")
def lineitem_shape(spark, sf):
    return A.shape(table(spark, sf, "lineitem"))


@query("a2_missing_counts", """
    WITH j AS (SELECT d.doc_id, lang, quality, toxic FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)
    SELECT 'doc_id' AS "column", count(*) - count(doc_id) AS missing FROM j UNION ALL SELECT 'lang', count(*) - count(lang) FROM j
    UNION ALL SELECT 'quality', count(*) - count(quality) FROM j UNION ALL SELECT 'toxic', count(*) - count(toxic) FROM j""")
def missing_labels(spark, sf):
    joined = table(spark, sf, "documents").select("doc_id", "lang").join(table(spark, sf, "labels"), "doc_id", "left")
    return A.missing_counts(joined)


@query("a3_info", """
    SELECT 'c_custkey' AS "column", count(c_custkey) AS non_null, 'bigint' AS type FROM customer
    UNION ALL SELECT 'c_name', count(c_name), 'string' FROM customer UNION ALL SELECT 'c_nationkey', count(c_nationkey), 'int' FROM customer
    UNION ALL SELECT 'c_acctbal', count(CASE WHEN c_acctbal > 0 THEN 1 END), 'double' FROM customer
    UNION ALL SELECT 'c_mktsegment', count(c_mktsegment), 'string' FROM customer""")
def customer_info(spark, sf):
    return A.info(table(spark, sf, "customer").withColumn("c_acctbal", F.when(F.col("c_acctbal") > 0, F.col("c_acctbal"))))


def _describe_text(c: str) -> str:
    return f"""SELECT '{c}' AS "column", sum(n)::BIGINT AS count, count(*) AS "unique", arg_min(v, (-n, v)) AS top, max(n) AS freq,
      NULL::DOUBLE AS mean, NULL::DOUBLE AS std, NULL::DOUBLE AS min, NULL::DOUBLE AS q1, NULL::DOUBLE AS q2, NULL::DOUBLE AS q3, NULL::DOUBLE AS max
      FROM (SELECT {c} AS v, count(*) AS n FROM part GROUP BY 1)"""


def _describe_number(c: str) -> str:
    qs = ", ".join(f"round(quantile_cont({c}::DOUBLE, {p}), 4)" for p in (0.25, 0.5, 0.75))
    return f"""SELECT '{c}', count({c}), NULL, NULL, NULL, round(avg({c}), 4), round(stddev_samp({c}), 4), min({c})::DOUBLE, {qs}, max({c})::DOUBLE FROM part"""


@query("a4_describe_all", " UNION ALL ".join(
    [_describe_text(c) for c in ("p_name", "p_brand", "p_type")] + [_describe_number(c) for c in ("p_size", "p_retailprice")]))
def part_statistics(spark, sf):
    described = A.describe_all(table(spark, sf, "part").drop("p_partkey"))
    return described.withColumns({c: F.round(c, 4) for c in ("mean", "std", "q1", "q2", "q3")})


@query("a5_value_counts", "SELECT CASE WHEN o_orderstatus <> 'P' THEN o_orderpriority END AS o_orderpriority, count(*) AS n FROM orders GROUP BY 1")
def priorities(spark, sf):
    orders = table(spark, sf, "orders").select(F.when(F.col("o_orderstatus") != "P", F.col("o_orderpriority")).alias("o_orderpriority"))
    return A.value_counts(orders, "o_orderpriority")


@query("a6_distinct_values", "SELECT DISTINCT p_brand FROM part WHERE p_size > 10")
def brands(spark, sf):
    part = table(spark, sf, "part").select(F.when(F.col("p_size") > 10, F.col("p_brand")).alias("p_brand"))
    return A.distinct_values(part, "p_brand")


def sql_summary(name: str, relation: str, columns: int, measures: list[str]) -> str:
    if not measures:
        return f"""SELECT '{name}' AS "table", (SELECT count(*) FROM {relation}) AS rows, {columns} AS columns, count(*) AS rows_deduped,
          (SELECT count(*) FROM {relation}) - count(*) AS duplicates_removed, NULL::BIGINT AS outliers, NULL::BIGINT AS rows_clipped,
          NULL::BIGINT AS rows_removed_outliers FROM (SELECT DISTINCT * FROM {relation})"""
    fences = ", ".join(f"quantile_cont({m}::DOUBLE, 0.25) AS a{i}, quantile_cont({m}::DOUBLE, 0.75) AS b{i}" for i, m in enumerate(measures))
    flag = " OR ".join(f"{m} < a{i} - 1.5 * (b{i} - a{i}) OR {m} > b{i} + 1.5 * (b{i} - a{i})" for i, m in enumerate(measures))
    return f"""SELECT '{name}' AS "table", (SELECT count(*) FROM {relation}) AS rows, {columns} AS columns, count(*) AS rows_deduped,
      (SELECT count(*) FROM {relation}) - count(*) AS duplicates_removed, count_if({flag})::BIGINT AS outliers, count(*) AS rows_clipped,
      (count(*) - count_if({flag}))::BIGINT AS rows_removed_outliers
      FROM (SELECT DISTINCT * FROM {relation}) d, (SELECT {fences} FROM (SELECT DISTINCT * FROM {relation}))"""


COPIED_EVENTS = "(SELECT user_id, event_type, value, ts FROM events UNION ALL SELECT user_id, event_type, value, ts FROM events WHERE event_type = 'click')"


def copied_events(spark, sf):
    events = table(spark, sf, "events").select("user_id", "event_type", "value", "ts")
    return events.unionByName(events.filter("event_type = 'click'"))


@query("a7_summarize", sql_summary("events", COPIED_EVENTS, 4, ["value", "user_id"]))
def event_summary(spark, sf):
    return A.summarize(copied_events(spark, sf), ["value", "user_id"], "events")


@query("a8_preview", "SELECT s_suppkey, s_name FROM supplier ORDER BY s_suppkey LIMIT 5")
def supplier_head(spark, sf):
    return A.preview(table(spark, sf, "supplier").select("s_suppkey", "s_name"), "s_suppkey")


# --- outliers -------------------------------------------------------------------------------------


def sql_fence(measure: str, relation: str, by: str) -> str:
    return f"""SELECT {by}, '{measure}' AS "column", count({measure}) AS n, quantile_cont({measure}::DOUBLE, 0.25) AS q1,
      quantile_cont({measure}::DOUBLE, 0.75) AS q3 FROM {relation} GROUP BY {by}"""


@query("o1_iqr_fences", f"""
    WITH f AS ({sql_fence('l_extendedprice', 'lineitem', 'l_returnflag')} UNION ALL {sql_fence('l_quantity', 'lineitem', 'l_returnflag')})
    SELECT l_returnflag, "column", n, round(q1, 6) AS q1, round(q3, 6) AS q3, round(q1 - 1.5 * (q3 - q1), 6) AS lower, round(q3 + 1.5 * (q3 - q1), 6) AS upper FROM f""")
def line_fences(spark, sf):
    fences = O.iqr_fences(table(spark, sf, "lineitem"), ["l_extendedprice", "l_quantity"], ["l_returnflag"])
    return fences.withColumns({c: F.round(c, 6) for c in ("q1", "q3", "lower", "upper")})


VALUE_FENCE = "f AS (SELECT quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3 FROM events)"
TYPE_FENCE = "f AS (SELECT event_type, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3 FROM events GROUP BY event_type)"
BEYOND = "(value < q1 - 1.5 * (q3 - q1) OR value > q3 + 1.5 * (q3 - q1))"


@query("o2_flag_outliers", f"WITH {TYPE_FENCE} SELECT event_id, event_type, {BEYOND} AS is_outlier FROM events JOIN f USING (event_type)")
def flagged_events(spark, sf):
    events = table(spark, sf, "events").select("event_id", "event_type", "value")
    return O.flag_outliers(events, ["value"], ["event_type"]).drop("value")


@query("o3_clip_outliers", f"""
    WITH {VALUE_FENCE} SELECT event_id, round(least(greatest(value, q1 - 1.5 * (q3 - q1)), q3 + 1.5 * (q3 - q1)), 6) AS value FROM events, f""")
def clipped_events(spark, sf):
    clipped = O.clip_outliers(table(spark, sf, "events").select("event_id", "value"), ["value"])
    return clipped.select("event_id", F.round("value", 6).alias("value"))


@query("o4_remove_outliers", """
    WITH f AS (SELECT lang, quantile_cont(n_chars::DOUBLE, 0.25) AS q1, quantile_cont(n_chars::DOUBLE, 0.75) AS q3 FROM documents GROUP BY lang)
    SELECT doc_id, lang, n_chars FROM documents JOIN f USING (lang) WHERE NOT (n_chars < q1 - 1.5 * (q3 - q1) OR n_chars > q3 + 1.5 * (q3 - q1))""")
def usual_documents(spark, sf):
    return O.remove_outliers(table(spark, sf, "documents").select("doc_id", "lang", "n_chars"), ["n_chars"], ["lang"])


@query("o5_gate_outliers", f"WITH {VALUE_FENCE} SELECT 'outliers' AS rule, count(*) AS failures, min(event_id)::VARCHAR AS sample_key FROM events, f WHERE {BEYOND}")
def refused_events(spark, sf):
    try:
        O.gate_outliers(table(spark, sf, "events").select("event_id", "value"), ["value"], "event_id")
        failed = []
    except GateError as error:
        failed = error.failed
    return spark.createDataFrame(failed, "rule string, failures bigint, sample_key string")
