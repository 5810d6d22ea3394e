"""Values that must not be lost: small numbers, microseconds, case forms, dates, a replaced table."""
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trailkeep.functions.text import case_fold
from trailkeep.operators.dedup import duplicate_counts
from trailkeep.operators.profile import describe_all
from trailkeep.operators.skew import fingerprint
from trailkeep.operators.quality import GateError
from trailkeep.sources import delimited
from trailkeep.sources.delimited import export_text, read_delimited, write_if_changed
from trailkeep.sources.storage import replace_folder


def test_exported_numbers_keep_every_digit(spark):
    numbers = [1e-20, 1.2345678901234567e-7, -4.9e-324, 1.7976931348623157e308, 1e7, 12345678.25, -1.5e10, 0.1, 0.0, 123.0, 1.2345678e7]
    texts = [r.x for r in export_text(spark.createDataFrame([(x,) for x in numbers], "x double")).collect()]
    assert [float(t) for t in texts] == numbers and not any("E" in t for t in texts)
    assert texts[0] == "0.00000000000000000001" and texts[4] == "10000000" and texts[5] == "12345678.25"


def test_fingerprints_tell_values_apart(spark):
    rows = [("2024-01-01 00:00:00.000001", 0.0, "a", "b"), ("2024-01-01 00:00:00.000002", 0.0, "a", "b"), ("2024-01-01 00:00:00.000001", -0.0, "a", "b"),
            ("2024-01-01 00:00:00.000001", 0.0, "a1:b", ""), ("2024-01-01 00:00:00.000001", 0.0, None, "b"), ("2024-01-01 00:00:00.000001", 0.0, "", "b"),
            (None, float("nan"), "a", "b"), (None, float("nan"), "a", "b")]
    df = spark.createDataFrame(rows, "t string, v double, x string, y string").withColumn("t", F.col("t").cast("timestamp"))
    assert df.select(fingerprint(df, df.columns)).distinct().count() == df.distinct().count() == 6
    assert duplicate_counts(df, {"all": df.columns}).first().surplus == 2


def test_case_fold_equals_full_folding(column):
    texts = ["µg", "ſtraße", "ﬁn ŉ", "İstanbul", "ΟΔΟΣ", "ẞ", "plain", "ǰ ΐ ᾳ Ꭰ", None]
    assert column(case_fold(F.col("t")), texts) == [None if t is None else t.casefold() for t in texts]


def test_dates_are_described(spark):
    df = spark.sql("SELECT DATE'1970-01-02' AS d, TIMESTAMP'1970-01-01 00:00:01.5' AS t UNION ALL SELECT DATE'1970-01-04', NULL")
    got = {r.column: r for r in describe_all(df).collect()}
    assert (got["d"]["count"], got["d"]["mean"], got["d"]["min"], got["d"]["q2"], got["d"]["max"]) == (2, 2.0, 1.0, 2.0, 3.0)
    assert (got["t"]["count"], got["t"]["max"]) == (1, 1.5)


def test_a_failed_replacement_leaves_the_old_table(spark, tmp_path):
    target = str(tmp_path / "table")
    spark.range(3).write.parquet(target)
    with pytest.raises(Exception):
        replace_folder(spark, str(tmp_path / "missing"), target)
    assert spark.read.parquet(target).count() == 3
    spark.range(5).write.parquet(str(tmp_path / "new"))
    replace_folder(spark, str(tmp_path / "new"), target)
    assert spark.read.parquet(target).count() == 5 and os.listdir(tmp_path) == ["table"]


def test_rows_of_the_wrong_length_are_not_cut(spark, tmp_path):
    (tmp_path / "t.psv").write_text("a|b|c\n1|2|3\n1|2|3|4\n5|6\n")
    schema, path = T.StructType([T.StructField(c, T.StringType()) for c in "abc"]), str(tmp_path / "t.psv")
    with pytest.raises(Exception, match="MALFORMED"):
        read_delimited(spark, path, schema).select("a").collect()
    kept = read_delimited(spark, path, schema, broken="line")
    assert [r.line for r in kept.orderBy("a", "line").collect()] == [None, "1|2|3|4", "5|6"]


def test_cells_that_do_not_parse_stop_the_read(spark, tmp_path):
    (tmp_path / "t.psv").write_text("a|v\nx|1.5\ny|bad amount\nz|NA\n")
    schema, path = T.StructType([T.StructField("a", T.StringType()), T.StructField("v", T.DoubleType())]), str(tmp_path / "t.psv")
    with pytest.raises(Exception, match="v is no double: bad amount"):
        read_delimited(spark, path, schema, strict=True).collect()
    assert [r.v for r in read_delimited(spark, path, schema, cast=False).orderBy("a").collect()] == ["1.5", "bad amount", None]


def test_line_breaks_survive_an_export(spark, tmp_path):
    texts = ["one\ntwo", "one\rtwo", "one\r\ntwo", 'a "b" | c', "\\", "", " x "]
    rows = spark.createDataFrame([(str(i), t) for i, t in enumerate(texts)], "id string, t string")
    path = str(tmp_path / "out")
    assert write_if_changed(rows, path) and not write_if_changed(rows, path)
    assert write_if_changed(rows.limit(3), path)


def test_an_export_that_does_not_read_back_leaves_the_old_one(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "out")
    write_if_changed(spark.createDataFrame([("1", "old")], "id string, t string"), path)
    good = delimited.write_delimited
    monkeypatch.setattr(delimited, "write_delimited", lambda df, p, mode="overwrite": good(df.limit(0), p, mode))
    with pytest.raises(GateError):
        write_if_changed(spark.createDataFrame([("1", "new")], "id string, t string"), path)
    assert [r.t for r in read_delimited(spark, path, T.StructType([T.StructField(c, T.StringType()) for c in ("id", "t")])).collect()] == ["old"]
