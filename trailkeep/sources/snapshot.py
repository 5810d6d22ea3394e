"""Preserved inputs and the audit trail of a run."""

from __future__ import annotations

from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from trailkeep.operators.profile import STATISTICS, describable, describe_all, is_missing
from trailkeep.operators.skew import cell_text
from trailkeep.session import shared_folder
from trailkeep.sources.storage import is_complete


def replay(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def _manifest_path(path: str) -> str:
    return path.rstrip("/") + ".manifest"


def _contents(df: DataFrame) -> dict[str, Column]:
    """Row count and order-free digests of the whole rows and of each column, missing cells among them."""
    wide = "decimal(38,0)"
    cells = [cell_text(f) for f in df.schema]
    digests = {"row contents": F.xxhash64(*cells)} | {f"contents {f.name}": F.xxhash64(c) for f, c in zip(df.schema, cells)}
    return {"rows": F.count(F.lit(1)), **{n: F.coalesce(F.sum(d.cast(wide)), F.lit(0).cast(wide)) for n, d in digests.items()}}


def _described(df: DataFrame, figures: Mapping[str, object]) -> dict[str, str]:
    return {"columns": ", ".join(df.columns)} | {f"type {f.name}": f.dataType.simpleString() for f in df.schema} | {
        n: str(v) for n, v in figures.items()}


def _aggregated(df: DataFrame) -> dict[str, str]:
    wanted = _contents(df)
    row = df.agg(*[c.alias(f"m{i}") for i, c in enumerate(wanted.values())]).first()
    return _described(df, dict(zip(wanted, row)))


def snapshot_once(df: DataFrame, path: str) -> DataFrame:
    """Preserve the input on the first run; later runs read the preserved copy, whatever ``df`` is.

    The writing tasks also count and digest what they write: the manifest beside the copy, from which ``drift`` tells
    whether a source has changed since.
    """
    spark = df.sparkSession
    if not is_complete(spark, path):
        seen, wanted = Observation(), _contents(df)
        names = [f"m{i}" for i in range(len(wanted))]
        df.observe(seen, *[c.alias(n) for n, c in zip(names, wanted.values())]).write.mode("overwrite").parquet(path)
        got = dict(seen.get)
        found = _described(df, {w: got[n] for w, n in zip(wanted, names)})
        spark.createDataFrame(list(found.items()), "metric string, value string").coalesce(1).write.mode("overwrite").json(_manifest_path(path))
    return replay(spark, path)


def drift(df: DataFrame, path: str) -> DataFrame:
    """(metric, preserved, now): in what a source differs from its preserved copy; no rows if it does not.

    One aggregation over the source: rows, columns, types, and digests of rows and columns, compared with the manifest
    (a copy preserved without one is read once more). Rows in another order are the same contents. With nothing
    preserved yet there is nothing to differ from.
    """
    spark, schema = df.sparkSession, "metric string, preserved string, now string"
    if not is_complete(spark, path):
        return spark.createDataFrame([], schema)
    if is_complete(spark, _manifest_path(path)):
        kept = {r.metric: r.value for r in spark.read.schema("metric string, value string").json(_manifest_path(path)).collect()}
    else:
        kept = _aggregated(replay(spark, path))
    now = _aggregated(df)
    rows = [(m, kept.get(m), now.get(m)) for m in dict.fromkeys([*kept, *now]) if kept.get(m) != now.get(m)]
    return spark.createDataFrame(rows, schema)


def _repeatable(number: Column) -> Column:
    """A sum's figure to 13 digits: its last ones depend on the order in which tasks end, and an audit repeats itself."""
    return F.when(number.isNotNull(), F.format_string("%.12e", number).cast("double"))


def _metrics(frame: DataFrame, stage: str, file: str) -> DataFrame:
    """One aggregation for sizes and missing cells, then the statistics of every column that has some."""
    def entry(metric: str, value: Column) -> Column:
        return F.struct(F.lit(metric).alias("metric"), value.cast("string").alias("value"))

    cells = [entry("rows", F.count(F.lit(1))), entry("columns", F.lit(len(frame.columns)))]
    for f in frame.schema:
        cells += [entry(f"missing {f.name}", F.count_if(is_missing(f))), entry(f"type {f.name}", F.lit(f.dataType.simpleString()))]
    named = [c.alias(f"m{i}") for i, c in enumerate(cells)]
    report = frame.agg(*named).select(F.inline(F.array(*[f"m{i}" for i in range(len(named))])))
    kinds = describable(frame)
    if kinds:
        labelled = [
            F.struct(F.concat(F.lit(f"{m} "), "column").alias("metric"), (_repeatable(F.col(m)) if m in ("mean", "std") else F.col(m)).cast("string").alias("value"))
            for m in ("unique", "top", "freq", *STATISTICS)
        ]
        described = describe_all(frame.select(*kinds)).select(F.inline(F.array(*labelled)))
        report = report.unionByName(described.filter(F.col("value").isNotNull()))
    return report.select(F.lit(file).alias("file"), F.lit(stage).alias("stage"), "metric", "value")


def audit_report(before: DataFrame, after: DataFrame, decisions: Mapping[str, object],
                 file: str = "table") -> DataFrame:
    """(file, stage, metric, value): profiles before and after, and the decisions taken between."""
    spark = before.sparkSession
    shared_folder(spark)  # settled before the threads ask for it
    with ThreadPoolExecutor(2) as pool:
        sides = list(pool.map(lambda side: _metrics(*side, file), [(before, "before"), (after, "after")]))
    report = sides[0].unionByName(sides[1])
    if decisions:
        rows = [(file, "decision", str(k), None if v is None else str(v)) for k, v in decisions.items()]
        report = report.unionByName(spark.createDataFrame(rows, "file string, stage string, metric string, value string"))
    return report


def write_audit(report: DataFrame, path: str) -> None:
    report.write.mode("overwrite").json(path)
