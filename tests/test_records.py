import pytest
from pyspark.sql import functions as F

from trailkeep.operators import dedup as D
from trailkeep.operators import order as K
from trailkeep.operators.joins import apply_review, filter_admitted
from trailkeep.operators.quality import GateError, frames_equal
from trailkeep.operators.skew import is_small, lookup_join


def rows(df):
    return sorted(df.collect(), key=str)


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture()
def skewed(spark):
    """A third of the rows under one key, a missing key, and copies."""
    return spark.range(3000).select(
        "id", F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, (F.col("id") % 500).cast("string")).alias("k"),
        (F.col("id") % 7).alias("v"))


def test_keep_first_does_not_depend_on_partitions(skewed):
    expected = {}
    for r in sorted(skewed.collect(), key=lambda r: r.id):
        expected.setdefault(r.k, r)
    for parts in (1, 7, 13):
        found = D.dedup_keep_first(skewed.repartition(parts, "v"), "k", "id")
        assert found.columns == skewed.columns
        assert rows(found) == sorted(expected.values(), key=str)


def test_keep_first_combines_before_the_shuffle(skewed):
    plan = physical(D.dedup_keep_first(skewed, "k", "id"))
    assert "partial_min_by" in plan and "Window" not in plan


def test_wide_rows_are_not_shuffled(spark, skewed):
    wide = skewed.select("*", F.concat(F.lit("text "), "id").alias("w"), F.lit("x").alias("note"))
    expected = {}
    for r in sorted(wide.collect(), key=lambda r: r.id):
        expected.setdefault(r.k, r)
    for parts in (1, 7):
        found = D.dedup_keep_first(wide.repartition(parts, "v"), "k", "id")
        assert found.columns == wide.columns and rows(found) == sorted(expected.values(), key=str)
    found = D.dedup_keep_first(wide, "k", "id")
    assert "Exchange hashpartitioning" not in physical(found) and "min_by" not in physical(found)
    assert rows(D.dedup_keep_first(wide, "k", "id", derived=True)) == sorted(expected.values(), key=str)


def test_rows_that_order_does_not_tell_apart_leave_one(spark):
    frame = spark.createDataFrame([(1, "a", "x"), (1, "a", "x"), (2, "a", "x"), (1, "b", "x"), (1, None, "y"), (1, None, "y"), (None, "c", "z"), (3, "c", "z")],
                                  "id int, n string, p string")
    found = D.dedup_except_id(frame, "id").collect()
    assert sorted(map(tuple, found), key=str) == sorted([(1, "a", "x"), (1, "b", "x"), (1, None, "y"), (None, "c", "z")], key=str)
    assert D.dedup_except_id(frame.limit(0), "id").count() == 0


def test_except_id_and_missing_cells(spark):
    frame = spark.createDataFrame([(1, "a", None), (2, "a", None), (3, "a", "x"), (4, "a", "x")], "id int, n string, p string")
    assert [r.id for r in D.dedup_except_id(frame, "id").orderBy("id").collect()] == [1, 3]


def test_last_wins_keeps_the_first_place(spark):
    frame = spark.createDataFrame([(1, "a", "old"), (2, "b", "b"), (3, "a", "new"), (4, None, "n")], "i int, k string, v string")
    found = D.dedup_last_wins(frame, "k", "i").orderBy("position").collect()
    assert [(r.k, r.v, r.position) for r in found] == [("a", "new", 1), ("b", "b", 2), (None, "n", 4)]


def test_url_variants_are_refused(spark):
    same = spark.createDataFrame([(1, "u", "x"), (2, "u", "x")], "i int, url string, body string")
    assert [r.i for r in D.dedup_by_url_checked(same, "url", "i").collect()] == [1]
    other = same.union(spark.createDataFrame([(3, "u", "y")], same.schema))
    with pytest.raises(GateError, match="one content per url"):
        D.dedup_by_url_checked(other, "url", "i")


def test_url_variants_are_set_aside_for_review(spark):
    frame = spark.createDataFrame([(1, "u", "x"), (2, "u", "x"), (3, "u", "y"), (4, "v", "x"), (5, "v", "x"), (6, None, "x"), (7, None, "z")],
                                  "i int, url string, body string")
    settled, disputed = D.split_by_url(frame, "url", "i")
    assert [r.i for r in D.dedup_by_url_checked(settled, "url", "i").collect()] == [4]
    assert sorted(r.i for r in D.dedup_except_id(disputed, "i").collect()) == [1, 3, 6, 7]


def test_pages_saved_with_different_contents_pass_the_checked_query(spark, tmp_path):
    from contract.records import one_page_per_url

    rows = [(1, "u", "<p>a</p>"), (2, "u", "<p>b</p>"), (3, "v", "<p>a</p>")]
    spark.createDataFrame(rows, "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    assert sorted((r.page_id, r.url) for r in one_page_per_url(spark, str(tmp_path)).collect()) == [(1, "u"), (2, "u"), (3, "v")]


def test_flagged_groups_hold_all_members_and_missing_keys(skewed):
    counts = {}
    for r in skewed.collect():
        counts[r.k] = counts.get(r.k, 0) + 1
    found = rows(D.keep_flagged(skewed, "k"))
    assert found == sorted((r for r in skewed.collect() if counts[r.k] > 1), key=str)
    wide = D.keep_flagged(skewed.withColumn("w", F.lit("x")), ["k", "w"])
    assert wide.count() == len(found)


@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
def test_lookup_is_the_same_on_every_path(skewed, spark, how):
    names = spark.createDataFrame([("hot", 1), (None, 2), ("4", 3), ("nowhere", 4)], "k string, name int")
    small = lookup_join(skewed, names, ["k"], how)
    shuffled = lookup_join(skewed, names, ["k"], how, broadcast_rows=0)
    assert "BroadcastHashJoin" in physical(small)
    assert rows(small) == rows(shuffled)
    assert small.count() > 0 and shuffled.columns == small.columns


def test_equal_rows_of_a_hot_key_are_spread(spark):
    """Three quarters of the rows are equal; adaptive execution deals them to several tasks."""
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "512b",
                "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512b", "spark.sql.shuffle.partitions": "64",
                "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5"}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        left = spark.range(0, 40000, 1, 32).select(
            F.when(F.col("id") % 4 > 0, -1).otherwise(F.col("id")).alias("k"),
            F.when(F.col("id") % 4 > 0, 0.0).otherwise(F.rand(3)).alias("v"))
        right = spark.range(-1, 40000).select(F.col("id").alias("k"), F.lit(1).alias("x"))
        found = lookup_join(left, right, ["k"], "inner", broadcast_rows=0)
        per_task = found.rdd.mapPartitions(lambda rows: [sum(1 for _ in rows)]).collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert sum(per_task) == 40000 and max(per_task) < 15000


def test_sizes_are_counted(skewed):
    assert is_small(skewed) and not is_small(skewed, max_rows=10) and not is_small(skewed, max_bytes=100)


def test_types_of_keys_may_differ(spark):
    left = spark.range(100).select(F.col("id").cast("int").alias("k"))
    right = spark.range(50).select(F.col("id").alias("k"), F.lit(1).alias("x"))
    assert lookup_join(left, right, ["k"], "inner", broadcast_rows=0).count() == 50


def test_ids_are_dense_and_sorted(spark):
    frame = spark.range(5000).select((F.col("id") * 7919 % 5000).alias("n"), F.lit("x").alias("s"))
    found = K.assign_ids(frame.repartition(6), ["n"], "R-%03d")
    assert [r.record_id for r in found.orderBy("n").collect()] == [f"R-{i:03d}" for i in range(1, 5001)]
    assert "Window" not in physical(found) and "SinglePartition" not in physical(found)


def test_ids_of_an_empty_table(spark):
    assert K.assign_ids(spark.range(0), ["id"], "R-%03d").count() == 0


def test_present_ids_stay(spark):
    frame = spark.createDataFrame([("b", ""), ("a", "X"), ("c", None)], "n string, record_id string")
    assert [r.record_id for r in K.assign_missing_ids(frame, ["n"], "R-%03d").orderBy("n").collect()] == ["X", "R-002", "R-003"]


def test_later_sources_are_not_read(spark):
    broken = spark.range(1).select(F.raise_error(F.lit("read")).cast("string").alias("url"))
    first = spark.createDataFrame([("u",)], "url string")
    assert K.first_nonempty(first.limit(0), first, broken).collect() == first.collect()


def test_seeds_count_as_the_first_source(spark):
    seeds = spark.createDataFrame([("s", 1)], "url string, i int")
    api = seeds.limit(0)
    other = spark.createDataFrame([("o", 2)], "url string, i int")
    assert [r.url for r in K.discover(seeds, api, other, key="url", order="i").collect()] == ["s"]
    assert [r.url for r in K.discover(api, api, other.union(other), key="url", order="i").collect()] == ["o"]


def test_union_fills_absent_columns(spark):
    both = K.union_records(spark.createDataFrame([(1, "a")], "i int, s string"), spark.createDataFrame([(2,)], "i int"))
    assert rows(both.select("i", "s")) == rows(spark.createDataFrame([(1, "a"), (2, None)], "i int, s string"))


def test_only_new(spark):
    links = spark.createDataFrame([("a",), ("b",), ("b",)], "url string")
    assert [r.url for r in K.only_new(links, links.filter("url = 'a'"), "url").collect()] == ["b", "b"]


def test_review_needs_every_post(spark):
    posts = spark.createDataFrame([(1, "l1"), (2, "l2")], "id int, link string")
    decisions = spark.createDataFrame([(1, "x"), (1, "y")], "id int, name string")
    assert [r.link for r in apply_review(decisions, posts, "id", ["link"]).collect()] == ["l1", "l1"]
    lost = decisions.union(spark.createDataFrame([(9, "z")], decisions.schema))
    with pytest.raises(GateError, match="decision without a post: 1 failing, such as 9"):
        apply_review(lost, posts, "id", ["link"])
    with pytest.raises(GateError, match="one post per id"):
        apply_review(decisions, posts.union(posts), "id", ["link"])


def test_first_fitting_rule_decides(spark):
    urls = spark.createDataFrame([("https://www.a.org/x/1",), ("https://a.org/x/open",), ("https://a.org",), ("https://b.org/x",)], "url string")
    rules = spark.createDataFrame([("a.org", 1, True, "/x/open"), ("a.org", 2, False, "/x")], "host string, rule_order int, allow boolean, prefix string")
    assert sorted(r.url for r in filter_admitted(urls, rules).collect()) == ["https://a.org", "https://a.org/x/open", "https://b.org/x"]


def test_frames_as_bags(spark):
    left = spark.createDataFrame([(1, "a"), (1, "a"), (2, None)], "i int, s string")
    same = frames_equal(left, left.repartition(3)).first()
    assert (same.left_rows, same.only_left, same.only_right, same.same_columns) == (3, 0, 0, True)
    other = frames_equal(left, left.distinct().union(spark.createDataFrame([(3, "c")], left.schema))).first()
    assert (other.only_left, other.only_right) == (1, 1)
