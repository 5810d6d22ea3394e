"""Near-duplicate vectors by Euclidean p-stable hashing.

Normalised vectors are projected on random directions; the projections, shifted and cut into steps, are a
bucket key per table. Vectors that share label and bucket in some table are compared by exact cosine.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trailkeep.llm.common import components, map_arrow, staged

COSINE = 0.93
#: Two unit vectors at the cosine above agree on one of STEPS hashes with probability 0.80, so in one of the
#: tables with 0.97; nearer ones more surely.
TABLES, STEPS, WIDTH = 32, 10, 1.5
SEED = 5


def _matrix(column: pa.ListArray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Row numbers and vectors, by length of the vectors."""
    lengths = np.asarray(column.value_lengths())
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    starts = np.cumsum(lengths) - lengths
    return [(rows, flat[starts[rows][:, None] + np.arange(size)])
            for size in np.unique(lengths) if len(rows := np.flatnonzero(lengths == size))]


def _hash(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for rows, x in _matrix(batch.column(1)):
            random = np.random.default_rng([SEED, x.shape[1]])
            directions = random.standard_normal((x.shape[1], TABLES * STEPS))
            shifts = random.uniform(0, WIDTH, TABLES * STEPS)
            x = x / np.abs(x).max(axis=1, keepdims=True)
            x = x / np.linalg.norm(x, axis=1, keepdims=True)
            steps = np.floor((x @ directions + shifts) / WIDTH).astype(np.int64).reshape(len(x), TABLES, STEPS)
            key = np.broadcast_to(np.arange(TABLES, dtype=np.int64), (len(x), TABLES)).copy()
            for i in range(STEPS):
                key = (key * 31 + steps[:, :, i]) * np.int64(0x5851F42D4C957F2D) + 12345
            ids = batch.column(0).take(pa.array(rows))
            yield pa.RecordBatch.from_arrays(
                [ids, pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * TABLES), pa.array(key.ravel()))],
                ["rep", "keys"])


def _confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        good = np.zeros(len(batch), bool)
        right = batch.column(3)
        for rows, x in _matrix(batch.column(2)):
            y = np.stack([np.asarray(right[i].values, np.float64) if len(right[i]) == x.shape[1] else np.zeros(x.shape[1]) for i in rows.tolist()])
            norms = np.linalg.norm(x, axis=1) * np.linalg.norm(y, axis=1)
            with np.errstate(invalid="ignore", divide="ignore"):
                good[rows] = np.einsum("ij,ij->i", x, y) / norms >= COSINE
        yield batch.select([0, 1]).filter(pa.array(good))


def near_duplicates(rows: DataFrame) -> DataFrame:
    """Columns ``vec_id, n_links, component_id, kept`` for each row of ``rows(vec_id, embedding, label)``.

    Only vectors of one label are compared. Null labels, null or zero vectors, and vectors with null or
    non-finite parts or of different length, link with nothing. Equal vectors are one node with its count, so
    copies are linked without being paired. Rows with one vec_id are separate vectors under the same
    component; a null vec_id has no component and is kept. An empty table gives an empty result.
    """
    slim = rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label"), F.col("embedding").cast("array<double>").alias("v"))
    infinite = float("inf")
    sound = (
        F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("v").isNotNull()
        & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < infinite)) & F.exists("v", lambda x: x != 0)
    )
    slim = slim.withColumn("sound", F.coalesce(sound, F.lit(False)))
    classes = staged(slim.where("sound").groupBy("label", "v").agg(F.min("vec_id").alias("first"), F.count("*").alias("n"))
                     .withColumn("rep", F.col("first")))
    hashed = map_arrow(classes.select("rep", "v"), _hash, "rep long, keys array<long>")
    keyed = staged(hashed.join(classes.select("rep", "label"), "rep").select("rep", "label", F.explode("keys").alias("key")))
    pairs = (
        keyed.alias("x").join(keyed.alias("y"), F.expr("x.label = y.label AND x.key = y.key AND x.rep < y.rep"))
        .select(F.col("x.rep").alias("a"), F.col("y.rep").alias("b")).distinct()
    )
    vectors = classes.select("rep", "v")
    both = pairs.join(vectors.select(F.col("rep").alias("a"), F.col("v").alias("x")), "a").join(
        vectors.select(F.col("rep").alias("b"), F.col("v").alias("y")), "b").select("a", "b", "x", "y")
    links = staged(map_arrow(both, _confirm, "a long, b long"))
    counts = classes.select("rep", "n")
    ways = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    others = ways.join(counts.withColumnRenamed("rep", "b"), "b").groupBy(F.col("a").alias("rep")).agg(F.sum("n").alias("far"))
    roots = components(links).withColumnRenamed("id", "rep")
    known = classes.join(others, "rep", "left").join(roots, "rep", "left").select(
        "label", "v", (F.col("n") - 1 + F.coalesce("far", F.lit(0))).alias("n_links"), F.coalesce("root", "rep").alias("component_id"))
    found = slim.join(known.withColumn("sound", F.lit(True)), ["label", "v", "sound"], "left")
    return found.select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id"),
    ).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
