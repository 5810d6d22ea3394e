import pytest
from pyspark.sql import functions as F

from trailkeep.functions import values as V
from trailkeep.operators import columns as cols
from trailkeep.operators import quality as Q

GOOD = ("1", "5.0", 5.0, 2.0, 3.0, "planned", 2010, "http://a", "a@b.co")
SCHEMA = "id string, raw string, amount double, m double, f double, status string, year int, url string, email string"
RULES = [
    Q.no_cast_loss("cast", "raw", "amount"), Q.positive("positive", "amount"), Q.not_negative("negative", "m"), Q.whole("whole", "m"),
    Q.allowed("status", "status", ["planned"]), Q.requires("year", "amount", "year"), Q.adds_up("sum", ["m", "f"], "amount"),
    Q.present("source", "url"), Q.web_url("web", "url"), Q.email_form("email", "email"), Q.present("id", "id"), Q.unique("unique", "id"),
]


def bad(**cells):
    names = [f.split()[0] for f in SCHEMA.split(", ")]
    return tuple({**dict(zip(names, GOOD)), "id": "9", **cells}[n] for n in names)


@pytest.mark.parametrize("rule, row", [
    ("cast", bad(raw="bad", amount=None)), ("positive", bad(amount=0.0, m=0.0, f=0.0)), ("negative", bad(m=-2.0, f=7.0)),
    ("whole", bad(m=2.5, f=2.5)), ("status", bad(status="open")), ("status", bad(status=None)), ("year", bad(year=None)),
    ("sum", bad(m=1.0)), ("source", bad(url=" \t")), ("source", bad(url=None)), ("web", bad(url="ftp://a")), ("web", bad(url=None)),
    ("email", bad(email="a b@c.d")), ("email", bad(email="a@b")), ("id", bad(id=None)), ("unique", bad(id="1")),
])
def test_each_rule_fails_on_a_planted_row_only(spark, rule, row):
    good = spark.createDataFrame([GOOD], SCHEMA)
    assert Q.validate(good, RULES, "id").filter("failures > 0").count() == 0
    planted = good.union(spark.createDataFrame([row], SCHEMA))
    failed = {r.rule for r in Q.validate(planted, RULES, "id").filter("failures > 0").collect()}
    assert rule in failed
    with pytest.raises(Q.GateError):
        Q.enforce(Q.validate(planted, RULES, "id"))


def test_missing_values_are_not_judged(spark):
    frame = spark.createDataFrame([bad(raw=None, amount=None, m=None, f=None, email=None, year=None), bad(raw=" ", amount=None, id="8")], SCHEMA)
    assert Q.validate(frame, RULES, "id").filter("failures > 0").count() == 0


def test_sample_is_the_smallest_key(spark):
    frame = spark.range(20).withColumn("x", -F.col("id") - 1)
    row = Q.validate(frame, [Q.positive("p", "x")], "id").first()
    assert (row.failures, row.sample_key) == (20, "0")
    assert Q.failing_rows(frame, Q.positive("p", "x")).count() == 20


def test_row_rules_are_one_pass(spark):
    plan = Q.validate(spark.createDataFrame([GOOD], SCHEMA), [r for r in RULES if isinstance(r, Q.RowRule)], "id")
    assert plan._jdf.queryExecution().executedPlan().toString().count("Scan ExistingRDD") == 1


def test_quarantine_keeps_every_row(spark):
    good, rejects = Q.quarantine(spark.range(10), [Q.RowRule("even", F.col("id") % 2 == 0), Q.RowRule("big", F.col("id") > 4)])
    assert sorted(r.id for r in good.collect()) == [1, 3]
    assert {r.id: r.error for r in rejects.collect()} == {0: "even", 2: "even", 4: "even", 6: "even", 8: "even", 5: "big", 7: "big", 9: "big"}


def test_columns(spark):
    frame = spark.range(1)
    Q.same_columns(frame, ["id"])
    Q.required_columns(frame, ["id"])
    with pytest.raises(Q.GateError):
        Q.same_columns(frame, ["id", "x"])
    with pytest.raises(Q.GateError, match="x"):
        Q.required_columns(frame, ["id", "x"])


t = F.col("t")


def test_numbers(column):
    texts = ["1", " 2.5 ", "-3e2", "1d", "NaN", "inf", "", None, "1,000", "66725.0", "9007199254740993", "1.5"]
    assert column(V.to_number(t), texts) == [1.0, 2.5, -300.0, None, None, None, None, None, None, 66725.0, 9007199254740992.0, 1.5]
    assert column(V.to_whole(t), texts) == [1, None, -300, None, None, None, None, None, None, 66725, 9007199254740993, None]
    assert column(V.lost_in_cast(t, V.to_number(t)), texts) == [False, False, False, True, True, True, False, False, True, False, False, False]
    assert column(V.parse_grouped_int(t), ["12,345", "", None, "x"]) == [12345, None, None, None]


def test_dates_and_categories(column):
    found = column(V.to_iso_date(t), ["2026-02-28", " 2026-02-28 ", "2026-02-30", "28/02/2026", "", None])
    assert [str(d) if d else None for d in found] == ["2026-02-28", "2026-02-28", None, None, None, None]
    assert column(V.fill_category(t), [" Planned\t", "\n ", None]) == ["planned", "unspecified", "unspecified"]


def test_normalized_cells(spark):
    frame = spark.createDataFrame([(" A &amp;  B ", " \t", " http://x?a=1&amp;b ")], "name string, phone string, source_url string")
    assert tuple(cols.normalize_text(frame).first()) == ("A & B", None, "http://x?a=1&amp;b")
    assert tuple(cols.normalize_text(frame, blank=True).first()) == ("A & B", "", "http://x?a=1&b")
    assert cols.normalize_text(frame.select("source_url")).first()[0] == "http://x?a=1&amp;b"


def test_column_sets(spark):
    from pyspark.sql import types as T
    frame = spark.createDataFrame([("1", "x")], "a string, b string")
    schema = T.StructType([T.StructField("b", T.StringType()), T.StructField("c", T.DoubleType()), T.StructField("a", T.LongType())])
    aligned = cols.align_to_schema(frame, schema)
    assert aligned.schema.simpleString() == schema.simpleString() and tuple(aligned.first()) == ("x", None, 1)
    assert cols.align_to_schema(frame.limit(0), schema).count() == 0
    assert cols.drop_derived(frame, "b", "none").columns == ["a"]
    assert tuple(cols.nulls_to_blank(frame.withColumn("n", F.lit(None).cast("int"))).first()) == ("1", "x", "")
    assert cols.drop_untraceable(frame.withColumn("b", F.lit(" \n")), "b").count() == 0
    assert cols.select_output(frame, ["b", "a"]).columns == ["b", "a"]
    assert cols.standardize_categories(frame.withColumn("b", F.lit(" X ")), ["b", "zz"]).first().b == "x"
