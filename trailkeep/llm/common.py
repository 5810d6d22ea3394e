"""What several operators share: staged tables, a checked broadcast, and connected components."""

from __future__ import annotations

import ctypes
import os
import shutil
import tempfile
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trailkeep.session import written

#: A side is broadcast only if it was counted and has no more rows than this (of a few numbers each).
BROADCAST_ROWS = 500_000


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the workers, once per application."""
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        _shipped.add(context.applicationId)
        package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
        archive = os.path.join(tempfile.mkdtemp(), "trailkeep")
        context.addPyFile(shutil.make_archive(archive, "zip", os.path.dirname(package), os.path.basename(package)))


def trim() -> None:
    """Give freed memory back to the system, as far as the platform can."""
    pa.default_memory_pool().release_unused()
    freed = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if freed is not None:
        freed(0)


def map_arrow(df: DataFrame, fn: Callable, schema: str) -> DataFrame:
    """``df.mapInArrow(fn, schema)``, with this package at hand on the workers, which keep no memory at a partition's end."""
    ship(df.sparkSession)

    def tidy(batches):
        yield from fn(batches)
        trim()

    return df.mapInArrow(tidy, schema)


def staged(df: DataFrame) -> DataFrame:
    """``df`` computed once and kept as Parquet in the shared folder."""
    return written(df)


def broadcast_if_small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` (staged, so that counting is cheap) with a broadcast hint if it has at most ``rows`` rows."""
    return F.broadcast(df) if df.count() <= rows else df


def components(edges: DataFrame) -> DataFrame:
    """Columns ``id, root`` for every id in ``edges(a, b)``: root is the smallest id reachable.

    Alternates large-star and small-star steps (each a minimum per node and a join back), so that a node with
    many links is aggregated map-side and its join can be split. Stops when the edges no longer change.
    Self-links and repeated links are allowed; an empty table gives an empty result.
    """
    links = staged(
        edges.select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).where("hi > lo").distinct()
    )
    state = None
    while True:
        both = links.select(F.col("hi").alias("u"), F.col("lo").alias("v")).unionByName(
            links.select(F.col("lo").alias("u"), F.col("hi").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = (
            both.where("v > u").join(least, "u")
            .select(F.col("v").alias("hi"), F.col("m").alias("lo")).where("hi > lo").distinct()
        )
        least = large.groupBy("hi").agg(F.min("lo").alias("m"))
        hooked = large.join(least, "hi").where("lo <> m").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
        small = least.select("hi", F.col("m").alias("lo")).unionByName(hooked).where("hi > lo").distinct()
        links = staged(small)
        found = links.agg(
            F.count("*").alias("n"), F.sum(F.xxhash64("hi", "lo").cast("decimal(20,0)")).alias("s")).first()
        if state == (found.n, found.s):
            break
        state = (found.n, found.s)
    roots = links.select(F.col("lo").alias("id")).distinct()
    return links.select(F.col("hi").alias("id"), F.col("lo").alias("root")).unionByName(
        roots.select("id", F.col("id").alias("root")))
