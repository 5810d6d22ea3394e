"""Plans and passes: what is shuffled, how often a table is read, and that exports are read back by many tasks."""
import random

from pyspark.sql import functions as F

from trailkeep.plans import clean as L
from trailkeep.operators.dedup import duplicate_counts
from trailkeep.operators.joins import filter_admitted
from trailkeep.operators.quality import differing_rows, frames_equal
from trailkeep.session import gathered_write
from trailkeep.sources import delimited


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def wide(spark, n=40):
    cells = [F.concat(F.lit(f"c{i} "), F.col("id").cast("string")).alias(f"c{i}") for i in range(n)]
    return spark.range(200).select("id", (F.col("id") / 3).alias("x"), F.array("id").alias("a"), *cells)


def test_one_changed_cell_of_a_wide_row_is_found(spark):
    left = wide(spark)
    right = left.withColumn("c17", F.when(F.col("id") == 150, "other").otherwise(F.col("c17"))).repartition(3)
    assert frames_equal(left, right).first()[:4] == (200, 200, 1, 1)
    found = {r.side: r for r in differing_rows(left, right).collect()}
    assert found["left"].c17 == "c17 150" and found["right"].c17 == "other" and found["left"].id == found["right"].id == 150
    assert differing_rows(left, left.repartition(2)).collect() == []
    twice = differing_rows(left.union(left.where("id = 3")), left).collect()
    assert [(r.id, r.side, r.surplus) for r in twice] == [(3, "left", 1)]


def test_comparison_shuffles_fingerprints_only(spark):
    left = wide(spark)
    plan = plan_of(frames_equal(left, left.select("*")))
    exchanges = [x for x in plan.splitlines() if "Exchange hashpartitioning" in x]
    aggregates = [x for x in plan.splitlines() if "HashAggregate(keys=[__print" in x]
    assert exchanges and aggregates and not any("c17" in x for x in exchanges + aggregates)


def test_an_export_of_one_file_is_read_back_by_many_tasks(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "out")
    table = spark.range(20_000).select(F.col("id").cast("string").alias("id"), F.repeat(F.lit("text "), 20).alias("t"))
    wrote = delimited.write_delimited(table.coalesce(1), path)
    assert wrote["rows"] == 20_000 and wrote["breaks"] == 0
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "256k")
    try:
        assert delimited._read_text(spark, path, table.columns, breaks=False).rdd.getNumPartitions() > 3
        assert delimited.verify_round_trip(table, path).first()[:4] == (20_000, 20_000, 0, 0)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    broken = table.withColumn("t", F.when(F.col("id") == "7", "a\nb\rc").otherwise(F.col("t")))
    assert delimited.write_if_changed(broken, path) and not delimited.write_if_changed(broken, path)
    assert delimited.verify_round_trip(broken, path).first()[:4] == (20_000, 20_000, 0, 0)


def test_all_key_sets_in_one_scan(spark):
    rows = [(1, "a", 1.0), (1, "a", 1.0), (2, "a", float("nan")), (3, None, float("nan")), (3, None, -0.0), (None, "b", 0.0)]
    df = spark.createDataFrame(rows, "k int, t string, x double")
    found = duplicate_counts(df, {"all": ["k", "t", "x"], "k": ["k"], "t": ["t"], "x": ["x"]})
    assert [tuple(r) for r in found.collect()] == [("all", 6, 1), ("k", 6, 2), ("t", 6, 3), ("x", 6, 3)]
    assert [tuple(r) for r in duplicate_counts(df.limit(0), {"k": ["k"], "t": ["t"]}).collect()] == [("k", 0, 0), ("t", 0, 0)]
    plan = plan_of(duplicate_counts(df, {"all": ["k", "t", "x"], "k": ["k"]}))
    assert plan.count("Scan ExistingRDD") == 1 and plan.count("Exchange hashpartitioning") == 1


def test_rules_of_a_hot_host_meet_urls_on_equal_prefixes(spark):
    random.seed(6)
    letters = "abc"
    rules = [("hot.org", i, random.random() < 0.5, "/" + "".join(random.choices(letters, k=random.randrange(0, 9)))) for i in range(10_000)]
    rules += [("cold.org", 1, False, "/"), ("cold.org", 0, True, "/x"), ("hot.org", 5, None, None)]
    urls = ["https://hot.org/" + "".join(random.choices(letters, k=random.randrange(0, 12))) for _ in range(300)]
    urls += ["https://cold.org/x1", "https://cold.org/y", "https://free.org/a", "https://hot.org", None, "no url"]
    found = filter_admitted(
        spark.createDataFrame([(u,) for u in urls], "url string"),
        spark.createDataFrame(rules, "host string, rule_order int, allow boolean, prefix string"))
    plan = plan_of(found)
    assert "NestedLoop" not in plan and "CartesianProduct" not in plan

    def admitted(url):
        host, _, path = (url or "").removeprefix("https://").partition("/")
        fits = [(o, p, a) for h, o, a, p in rules if h == host and p is not None and ("/" + path).startswith(p)]
        return not fits or min(fits)[2] is not False

    assert sorted((r.url for r in found.collect()), key=str) == sorted((u for u in urls if admitted(u)), key=str)


def test_figures_are_gathered_at_the_write(spark):
    kept, figures = gathered_write(spark.range(100).repartition(5), {"n": F.count(F.lit(1)), "top": F.max("id")})
    assert figures == {"n": 100, "top": 99} and kept.count() == 100


def jobs_of(spark, group, run):
    spark.sparkContext.setJobGroup(group, group)
    try:
        run()
    finally:
        spark.sparkContext.setJobGroup("rest", "rest")
    return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))


def test_gates_and_counts_cost_no_job_of_their_own(spark):
    from trailkeep.operators import quality as Q
    from trailkeep.plans.clean import _gated

    df = spark.range(50).withColumn("name", F.lit("x")).repartition(3)
    rules = [Q.present("named", "name"), Q.positive("positive", "id")]
    plain = jobs_of(spark, "plain", lambda: gathered_write(df, {}))

    def gated():
        try:
            _gated(df, rules, "id")
        except Q.GateError as e:
            assert e.failed == [("positive", 1, "0")]
        else:
            raise AssertionError

    assert jobs_of(spark, "gated", gated) == plain


def counted(frame, column):
    """``frame`` with its ``column`` counted each time a row of it is computed, and the counter."""
    seen = frame.sparkSession.sparkContext.accumulator(0)

    @F.udf("string")
    def passed(value):
        seen.add(1)
        return value

    return frame.withColumn(column, passed.asNondeterministic()(column)), seen


def test_a_small_file_is_dealt_to_all_cores(spark, tmp_path):
    from contract.extraction import fact_pages

    rows = [(i, "BUILDING") for i in range(500)]
    spark.createDataFrame(rows, "c_custkey long, c_mktsegment string").coalesce(1).write.parquet(f"{tmp_path}/customer.parquet")
    parts = fact_pages(spark, str(tmp_path)).select(F.spark_partition_id().alias("p")).distinct().count()
    assert parts >= 8


def test_pages_of_a_profile_are_stripped_once(spark):
    from trailkeep.plans.collect import collect_profile
    from trailkeep.rules import census_templates

    text = "It would rise to approximately 98,533 by 2018. Nalo is near."
    frame, seen = counted(spark.createDataFrame([(i, f"https://t/{i}", text) for i in range(20)], "page_id long, url string, html string"), "html")
    found = collect_profile(frame, census_templates("Lenda"), "Lenda", "Novia", ["Kalo"], {"Nalo": {"level": "ward"}, "near": {"level": "ward"}})
    assert found.count() == 60 and seen.value == 20


def profile_rows(spark):
    from trailkeep.rules import PROFILE_COLUMNS

    base = dict(record_id="D-1", level="District", name="Lenda", population="10", population_year="2010", notes="n", source_url="https://t/x")
    rows = [{**base, "record_id": f"D-{i}", "name": f"Lenda {i % 10}"} for i in range(20)]
    return counted(spark.createDataFrame([tuple(r.get(c) for c in PROFILE_COLUMNS) for r in rows], ", ".join(f"{c} string" for c in PROFILE_COLUMNS)), "notes")


def test_rows_of_a_strict_profile_are_computed_once(spark):
    frame, seen = profile_rows(spark)
    found = L.clean_profile(frame)
    assert found.clean.count() == 10 and found.details["duplicates_removed"] == 10 and seen.value == 20


def test_rows_of_a_lax_profile_are_computed_once(spark):
    frame, seen = profile_rows(spark)
    found = L.clean_profile(frame, "lax")
    assert found.clean.count() == 10 and found.details["duplicates_removed"] == 10 and seen.value == 20


def test_projects_of_a_small_file_are_dealt_to_all_cores(spark, tmp_path):
    from contract.plans import project_table

    orders = spark.range(500).selectExpr("id AS o_orderkey", "id AS o_custkey", "'O' AS o_orderstatus", "'5-LOW' AS o_orderpriority",
                                         "1.5D AS o_totalprice", "TIMESTAMP'2024-01-01' AS o_orderdate")
    orders.coalesce(1).write.parquet(f"{tmp_path}/orders.parquet")
    parts = project_table(spark, str(tmp_path)).select(F.spark_partition_id().alias("p")).distinct().count()
    assert parts >= 8


def test_first_places_by_number_are_found_without_sorting(spark, monkeypatch):
    from trailkeep.operators import dedup as D

    plans = []
    monkeypatch.setattr(D, "checkpointed", lambda df: plans.append(plan_of(df)) or df)
    frame = spark.range(100).selectExpr("CASE WHEN id <> 7 THEN id END AS id", "CAST(id % 10 AS string) AS a", "'x' AS b")
    assert sorted(r.id for r in D.dedup_except_id(frame, "id").collect() if r.id is not None) == [0, 1, 2, 3, 4, 5, 6, 8, 9]
    assert D.dedup_except_id(frame, "id").count() == 10 and not any("SortAggregate" in p for p in plans)
