"""Session settings the operators are written for, and intermediate tables that survive a lost executor."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Observation, SparkSession


def build_session(app: str = "trailkeep", master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution on; ``master`` only for local runs (a cluster sets its own)."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; a temporary one only in a local session without it."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        current = spark.sparkContext.getCheckpointDir()
        if current is not None:
            return current
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder all executors share")
        folder = tempfile.mkdtemp(prefix="trailkeep-")
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def spread(df: DataFrame) -> DataFrame:
    """``df`` dealt to all cores: a small file is read by one task, which would then do all dear work on its rows."""
    return df.repartition(max(32, 4 * df.sparkSession.sparkContext.defaultParallelism))


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` computed once and kept in the shared folder, partition by partition in its row order."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame) -> DataFrame:
    """``df`` computed once and kept in the shared folder as Parquet, for several passes over few columns."""
    return gathered_write(df, {})[0]


def gathered_write(df: DataFrame, figures: Mapping[str, Column]) -> tuple[DataFrame, dict[str, object]]:
    """``written``, and aggregates of its rows gathered by the tasks that write them, without another pass."""
    path = f"{shared_folder(df.sparkSession).rstrip('/')}/table-{uuid.uuid4().hex}"
    seen = Observation()
    observed = df.observe(seen, *[c.alias(n) for n, c in figures.items()]) if figures else df
    observed.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), dict(seen.get) if figures else {}
