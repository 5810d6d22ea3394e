import numpy as np
import pytest
from pyspark.sql import functions as F

from trailkeep.operators import outliers as O
from trailkeep.operators.profile import describe_all, missing_counts, summarize, value_counts
from trailkeep.operators.quality import GateError

AMOUNTS = [240000, 270000, 600000, 800000, 800000, 1265906.80, 1500000, 1746232.59, 2099616.03, 2143990, 2887051]


def amounts(spark, extra=()):
    return spark.createDataFrame([(float(a) if a is not None else None,) for a in [*AMOUNTS, *extra]], "x double")


def test_golden_fences(spark):
    row = O.iqr_fences(amounts(spark, [None, float("nan")]), ["x"]).first()
    assert (row.n, row.q1) == (11, 700000.0)
    assert row.q3 == pytest.approx(1922924.31) and row.lower == pytest.approx(-1134386.465) and row.upper == pytest.approx(3757310.775)
    assert O.flag_outliers(amounts(spark), ["x"]).filter("is_outlier").count() == 0


@pytest.mark.parametrize("shape", ["even", "tied", "long tail"])
@pytest.mark.parametrize("accuracy, slices", [(1000, 4096), (10, 3)])
def test_narrowed_quartiles_are_exact(spark, shape, accuracy, slices):
    """A poor sketch and few slices cost more passes, never the result."""
    rng = np.random.default_rng(3)
    values = {"even": rng.uniform(size=40000), "tied": rng.integers(0, 4, 40000).astype(float), "long tail": rng.pareto(1, 40000)}[shape]
    frame = spark.createDataFrame([(float(v), "ab"[i % 2]) for i, v in enumerate(values)], "x double, g string")
    found = O.exact_quartiles(frame.repartition(9), ["x"], ["g"], accuracy=accuracy, bracket=0.01, slices=slices).collect()
    assert len(found) == 2
    for r in found:
        mine = values["ab".index(r.g)::2]
        assert r.n == len(mine)
        assert np.allclose([r.q1, r.q2, r.q3], np.quantile(mine, [0.25, 0.5, 0.75]), rtol=1e-12)


@pytest.mark.parametrize("values", [
    [7.0], [1.0, 2.0], [0.0, -0.0, 5.0], [-1e308, 1e308, 0.0, 1.0], [5e-324 * i for i in range(1, 6)], [1.0] * 9 + [float("inf")] + [-float("inf")],
])
@pytest.mark.parametrize("by", [[], ["g"]])
def test_quartiles_of_odd_values(spark, values, by):
    frame = spark.createDataFrame([(v, None) for v in values], "x double, g string")
    row = O.exact_quartiles(frame, ["x"], by, accuracy=2, slices=2).first()
    with np.errstate(all="ignore"):
        assert np.array_equal([row.q1, row.q2, row.q3], np.quantile(values, [0.25, 0.5, 0.75]))


def test_ranking_sees_few_rows(spark):
    """What one task ranks is bounded by the number of slices, however many values a column has."""
    long = spark.range(1_000_000).select(F.lit("x").alias("column"), F.xxhash64("id").cast("double").alias("value"))
    low, high = long.agg(F.min("value"), F.max("value")).first()
    state = spark.createDataFrame([("x", [0], [([low, 0.0, high], 0)])], "column string, ranks array<long>, open array<struct<breaks:array<double>,below:long>>")
    counts = O._slice_counts(long.join(F.broadcast(state), "column"), ["column"], 500)
    assert counts.count() <= 3 * 502 and counts.agg(F.sum("c")).first()[0] == 1_000_000


def test_approximate_fences_take_present_values(spark):
    row = O.iqr_fences(amounts(spark), ["x"], approximate=True).first()
    assert row.n == 11 and row.q1 in AMOUNTS and row.q3 in AMOUNTS
    assert row.upper == pytest.approx(row.q3 + 1.5 * (row.q3 - row.q1))


def test_groups_without_values_have_no_fence(spark):
    frame = spark.createDataFrame([("a", 1.0, None), ("a", 3.0, None), ("b", None, None), (None, 5.0, None)], "g string, x double, y double")
    fences = {(r.g, r.column): r for r in O.iqr_fences(frame, ["x", "y"], ["g"]).collect()}
    assert set(fences) == {("a", "x"), (None, "x")}
    flagged = O.flag_outliers(frame, ["x", "y"], ["g"])
    assert flagged.count() == 4 and flagged.filter("is_outlier").count() == 0


def test_clip_keeps_missing_and_moves_extremes(spark):
    frame = amounts(spark, [1e9, None, float("nan"), -1e9])
    fence = O.iqr_fences(frame, ["x"]).first()
    clipped = [r.x for r in O.clip_outliers(frame, ["x"]).collect()]
    assert max(x for x in clipped if x is not None) == fence.upper and min(x for x in clipped if x is not None) == fence.lower
    assert clipped.count(None) == 2 and len(clipped) == 15
    assert O.remove_outliers(frame, ["x"]).count() == 13


def test_gate_stops_with_a_key(spark):
    frame = amounts(spark, [1e9]).withColumn("id", F.monotonically_increasing_id())
    with pytest.raises(GateError, match="outliers: 1 failing"):
        O.gate_outliers(frame, ["x"], "id")
    O.gate_outliers(amounts(spark).withColumn("id", F.lit(1)), ["x"], "id")


def test_no_single_task_over_the_data(spark):
    frame = spark.range(100000).select((F.col("id") % 3).alias("g"), F.rand(1).alias("x"))
    plan = O.iqr_fences(frame, ["x"], ["g"])._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan


def test_summary(spark):
    frame = spark.createDataFrame([(1.0, "a")] * 3 + [(float(i), "b") for i in range(2, 12)] + [(1000.0, "c"), (None, "d")], "x double, s string")
    row = summarize(frame, ["x"], "t").first()
    assert (row.rows, row.columns, row.rows_deduped, row.duplicates_removed, row.outliers, row.rows_clipped, row.rows_removed_outliers) == (
        15, 2, 13, 2, 1, 13, 12)
    bare = summarize(frame, [], "t").first()
    assert (bare.outliers, bare.rows_clipped, bare.rows_removed_outliers) == (None, None, None)


def test_description(spark):
    frame = spark.createDataFrame([("b", 1.0), ("a", 2.0), ("b", None), ("a", float("nan")), (None, 6.0)], "s string, x double")
    found = {r.column: r for r in describe_all(frame).collect()}
    assert (found["s"]["count"], found["s"].unique, found["s"].top, found["s"].freq) == (4, 2, "a", 2)
    x = found["x"]
    assert (x["count"], x.mean, x.min, x.q1, x.q2, x.q3, x.max) == (3, 3.0, 1.0, 1.5, 2.0, 4.0, 6.0)
    assert x["std"] == pytest.approx(np.std([1, 2, 6], ddof=1))


def test_counts(spark):
    frame = spark.createDataFrame([("b", 1.0), ("a", None), (None, float("nan")), ("", 2.0), ("b", 1.0)], "s string, x double")
    assert {r.column: r.missing for r in missing_counts(frame).collect()} == {"s": 1, "x": 2}
    assert {r.column: r.missing for r in missing_counts(frame, blank=True).collect()} == {"s": 2, "x": 1}
    assert [r.column for r in missing_counts(frame.select("s", F.lit(1).alias("full")), only_gaps=True).collect()] == ["s"]
    assert [tuple(r) for r in value_counts(frame, "s").collect()] == [("b", 2), ("", 1), ("a", 1), (None, 1)]


def test_the_table_is_read_twice(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(50_000).select((F.xxhash64("id") % 1_000_003).cast("double").alias("x"), (F.col("id") % 3).alias("g")).write.parquet(path)
    source = spark.read.parquet(path)
    seen = []
    meet = O._meet

    def watched(left, state, group, by):
        seen.append("segment" in left.columns)
        return meet(left, state, group, by)

    O._meet = watched
    try:
        for by in ([], ["g"]):
            seen.clear()
            found = {r[0] if by else None: r for r in O.exact_quartiles(source, ["x"], by).collect()}
            assert seen[0] is False and all(seen[1:-1])
            for g, r in found.items():
                values = np.array([v.x for v in source.where(F.lit(True) if g is None else F.col("g") == g).collect()])
                assert (r.n, r.q1, r.q2, r.q3) == (len(values), *np.percentile(values, [25, 50, 75]))
    finally:
        O._meet = meet


def test_a_rank_beyond_its_bracket_is_found_in_the_table(spark, monkeypatch):
    df = spark.range(5_000).select((F.col("id") * 7 % 5_003).cast("double").alias("x"))
    right = [tuple(r) for r in O.exact_quartiles(df, ["x"]).collect()]
    assert [tuple(r) for r in O.exact_quartiles(df, ["x"], accuracy=3, bracket=1e-9).collect()] == right
