import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trailkeep.operators.quality import GateError
from trailkeep.sources.delimited import read_delimited, require_round_trip, verify_round_trip, write_delimited, write_if_changed
from trailkeep.sources.snapshot import audit_report, drift, replay, snapshot_once, write_audit
from trailkeep.sources.web import read_pages, read_post_index, read_sitemap

SCHEMA = "id string, amount double, day date, note string"


def frame(spark):
    return spark.createDataFrame([("007", 12345678.5, "2024-01-02", 'a|b "q" '), ("8", None, None, None), ("9", 1e-4, "2023-12-31", " x"), ("10", 2143990.0, None, "é")],
                                 "id string, amount double, day string, note string").withColumn("day", F.col("day").cast("date"))


def test_missing_value_policies(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text("﻿id|amount|note\n01|5.5|NA\n02|None|\n03|bad|nan\n04|7|text\n", encoding="utf-8")
    schema = T.StructType([T.StructField("id", T.StringType()), T.StructField("amount", T.DoubleType()), T.StructField("note", T.StringType())])
    default = read_delimited(spark, str(path), schema).orderBy("id").collect()
    assert [tuple(r) for r in default] == [("01", 5.5, None), ("02", None, None), ("03", None, None), ("04", 7.0, "text")]
    text = read_delimited(spark, str(path), schema, cast=False).orderBy("id").collect()
    assert [r.amount for r in text] == ["5.5", None, "bad", "7"]
    blank = read_delimited(spark, str(path), schema, na="none").orderBy("id").collect()
    assert [tuple(r) for r in blank][:2] == [("01", "5.5", "NA"), ("02", "None", "")]


def test_header_must_fit(spark, tmp_path):
    (tmp_path / "t.csv").write_text("a|b\n1|2\n")
    with pytest.raises(Exception, match="(?i)header"):
        read_delimited(spark, str(tmp_path / "t.csv"), T.StructType([T.StructField("a", T.StringType()), T.StructField("c", T.StringType())])).collect()


def test_round_trip(spark, tmp_path):
    path = str(tmp_path / "out")
    write_delimited(frame(spark), path)
    lines = [line for f in tmp_path.glob("out/part-*") for line in f.read_text(encoding="utf-8").splitlines()]
    assert "007|12345678.5|2024-01-02|\"a|b \"\"q\"\" \"" in lines and "8|||" in lines and "9|0.0001|2023-12-31| x" in lines
    found = verify_round_trip(frame(spark), path).first()
    assert (found.left_rows, found.right_rows, found.only_left, found.only_right) == (4, 4, 0, 0)
    require_round_trip(frame(spark), path)
    with pytest.raises(GateError):
        require_round_trip(frame(spark).withColumn("note", F.lit("z")), path)
    assert sorted(map(str, read_delimited(spark, path, frame(spark).schema).collect())) == sorted(map(str, frame(spark).collect()))


def test_unchanged_exports_are_not_rewritten(spark, tmp_path):
    path = str(tmp_path / "out")
    assert write_if_changed(frame(spark), path)
    before = sorted(f.stat().st_mtime_ns for f in (tmp_path / "out").iterdir())
    assert not write_if_changed(frame(spark).repartition(3), path)
    assert before == sorted(f.stat().st_mtime_ns for f in (tmp_path / "out").iterdir())
    shifted = frame(spark).select("id", "amount", "day", F.lit(None).cast("string").alias("note"))
    assert write_if_changed(shifted, path)
    assert write_if_changed(shifted.withColumnRenamed("note", "remark"), path)
    # the new content may come from the export itself
    again = read_delimited(spark, path, T.StructType([T.StructField(c, T.StringType()) for c in ("id", "amount", "day", "remark")]))
    assert write_if_changed(again.filter("id <> '8'"), path)
    assert read_delimited(spark, path, again.schema).count() == 3


def test_snapshot_replays_the_first_input(spark, tmp_path):
    path = str(tmp_path / "snap")
    assert snapshot_once(spark.range(5), path).count() == 5
    assert snapshot_once(spark.range(9), path).count() == 5 == replay(spark, path).count()
    (tmp_path / "snap" / "_SUCCESS").unlink()  # a lost first run
    assert snapshot_once(spark.range(9), path).count() == 9


def test_drift_names_what_changed(spark, tmp_path):
    path = str(tmp_path / "snap")
    source = spark.createDataFrame([(1, "a", None), (2, "b", 0.0), (3, None, 2.5)], "id int, name string, rate double")
    assert drift(source, path).isEmpty()  # nothing preserved yet
    snapshot_once(source, path)
    assert drift(source.repartition(3).orderBy(F.desc("id")), path).isEmpty()

    def changed(df):
        return {r.metric: (r.preserved, r.now) for r in drift(df, path).collect()}

    renamed = source.withColumn("name", F.when(F.col("id") == 2, "B").otherwise(F.col("name")))
    assert set(changed(renamed)) == {"row contents", "contents name"}
    swapped = spark.createDataFrame([(2, "a", None), (1, "b", 0.0), (3, None, 2.5)], source.schema)
    assert set(changed(swapped)) == {"row contents"}
    assert changed(source.where("id < 3"))["rows"] == ("3", "2")
    other = changed(source.drop("rate").withColumn("id", F.col("id").cast("long")))
    assert other["type id"] == ("int", "bigint") and other["type rate"] == ("double", None) and "contents id" not in other
    (tmp_path / "snap.manifest" / "_SUCCESS").unlink()  # a copy of an earlier version
    assert drift(source, path).isEmpty() and set(changed(renamed)) == {"row contents", "contents name"}


def test_pages(spark, tmp_path):
    (tmp_path / "a.html").write_text("<p>1</p>\n<p>2</p>")
    (tmp_path / "b.html").write_text("x")
    rows = read_pages(spark, str(tmp_path / "*.html")).orderBy("url").collect()
    assert [r.html for r in rows] == ["<p>1</p>\n<p>2</p>", "x"] and rows[0].url.endswith("/a.html")


def test_post_index(spark, tmp_path):
    posts = [{"id": 5, "date": "2024-03-04T10:00:00", "link": "https://x/?p=5", "title": {"rendered": "A &amp; <b>B</b>"}, "content": {"rendered": "<p>One</p>\n<p>Two</p>"}},
             {"id": 6, "date": None, "link": None, "title": {}, "content": None, "extra": 1}]
    (tmp_path / "page_1.json").write_text(json.dumps(posts, indent=2))
    rows = read_post_index(spark, str(tmp_path / "*.json")).orderBy("id").collect()
    assert (rows[0].title, rows[0].body, str(rows[0].date)) == ("A & B", "One Two", "2024-03-04")
    assert (rows[1].title, rows[1].body, rows[1].date) == ("", "", None)


def test_sitemap(spark, tmp_path):
    (tmp_path / "map.xml").write_text("<urlset><url><loc> https://www.t.org/cdf?a=1&amp;b=2 </loc></url><url><LOC>https://t.org/x</LOC></url>\n<url><loc>https://u.org/project</loc></url></urlset>")
    assert [r.url for r in read_sitemap(spark, str(tmp_path / "map.xml"), "https://t.org").collect()] == ["https://www.t.org/cdf?a=1&b=2"]
    assert read_sitemap(spark, str(tmp_path / "map.xml"), slug_words=()).count() == 3


def test_audit(spark, tmp_path):
    report = audit_report(frame(spark), frame(spark).filter("amount is not null"), {"removed": 1}, "f")
    cells = {(r.stage, r.metric): r.value for r in report.collect()}
    assert cells["before", "rows"] == "4" and cells["after", "rows"] == "3" and cells["before", "missing amount"] == "1"
    assert cells["before", "type day"] == "date" and cells["decision", "removed"] == "1"
    write_audit(report, str(tmp_path / "audit"))
    assert spark.read.json(str(tmp_path / "audit")).count() == report.count()
