"""The manifest against a tree built in plain Python, and its registered query against its SQL."""
import hashlib
import os
import random
import zlib

import duckdb
import pytest
from pyspark.sql import functions as F

from trailkeep.llm import merkle, queries

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
needs_tables = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain_leaf(doc_id, text, lang, source, n_chars):
    cells = [None if c is None else str(c) for c in (doc_id, source, lang, n_chars, text)]
    return sha("".join("-" if c is None else f"{len(c.encode())}:{c}" for c in cells))


def climb(hashes):
    levels = [hashes]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([sha("".join(last[i:i + 8])) for i in range(0, len(last), 8)])
    return levels


def steps(levels, idx):
    out = []
    for level in levels[:-1]:
        run = idx // 8 * 8
        out.append((level[run:idx], level[idx + 1:run + 8]))
        idx //= 8
    return out


def plain(rows, tampered):
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified) of every row, by whole trees in memory."""
    langs = sorted({r[2] for r in rows}, key=lambda x: (x is not None, (x or "").encode()))
    trees = {}
    for lang in langs:
        mine = sorted((r for r in rows if r[2] == lang), key=lambda r: (r[0] is not None, r[0] or 0, plain_leaf(*r)))
        trees[lang] = mine, climb([plain_leaf(*r) for r in mine])
    top = climb([trees[x][1][-1][0] for x in langs])
    out = []
    for k, lang in enumerate(langs):
        mine, levels = trees[lang]
        for i, r in enumerate(mine):
            path = steps(levels, i) + steps(top, k)
            low = None if r[1] is None else "".join(c.lower() if "A" <= c <= "Z" else c for c in r[1])
            value = plain_leaf(r[0], low, *r[2:]) if tampered(r[0]) else levels[0][i]
            for left, right in path:
                value = sha("".join(left) + value + "".join(right))
            proof = sha("".join("".join(a) + "".join(b) for a, b in path))
            out.append((r[0], levels[0][i], levels[-1][0], top[-1][0], proof, value, value == top[-1][0]))
    return sorted(out, key=str)


def table(n_of):
    random.seed(3)
    rows, i = [], 0
    for lang, n in n_of.items():
        for _ in range(n):
            i += 1
            rows.append((i, random.choice(["Ab", "ab", "É x", "", None]), lang, random.choice(["s", None]), i % 7))
    random.shuffle(rows)
    return rows


def tampers(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 3 == 0


def proved(spark, rows):
    docs = spark.createDataFrame(rows, DOCS).withColumn("leaf", F.lit(1)).withColumn("idx", F.lit("x")).withColumn("tree", F.lit(0))
    odd = F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(3)) == 0, F.lit(False))
    claimed = F.when(odd, merkle.lowered(F.col("text"))).otherwise(F.col("text"))
    return merkle.prove(merkle.build(docs, claimed), whole=True)


@pytest.mark.parametrize("n_of", [
    {"en": 1500, "de": 513, "fr": 64, "es": 9, "é": 8, None: 1, "": 2, **{f"x{i}": 1 for i in range(8)}}, {"en": 512}, {None: 1}, {"a": 1, "b": 9}])
def test_equals_whole_trees(spark, n_of):
    rows = table(n_of)
    found = proved(spark, rows)
    got = sorted((tuple(r)[:7] for r in found.drop("proof").collect()), key=str)
    assert got == plain(rows, tampers)
    for r in found.limit(20).collect():
        assert sha("".join(r.proof)) == r.proof_sha256


def test_repeated_rows_null_ids_and_empty_tables(spark):
    rows = [(1, "A", "en", "s", 1)] * 3 + [(None, None, None, None, None)] * 2 + [(1, "B", "en", "s", 1), (None, "C", "en", None, 2)]
    got = sorted((tuple(r)[:7] for r in proved(spark, rows).collect()), key=str)
    assert got == plain(rows, tampers)
    assert proved(spark, []).collect() == []
    assert merkle.build(spark.createDataFrame([], DOCS)).root is None


def test_missing_is_least():
    """Every coordinate asked for is needed, and with them the root follows."""
    for n, first, last in ((1, 0, 1), (9, 8, 9), (100, 3, 21), (600, 512, 600), (513, 512, 513), (4096, 512, 1024)):
        levels = climb([sha(str(i)) for i in range(n)])
        asked = list(merkle.missing(first, last, n))
        known = {(0, i) for i in range(first, last)} | set(asked)
        assert not set(asked) & {(0, i) for i in range(first, last)}
        for k in range(len(levels) - 1):
            for run in {i // 8 for j, i in known if j == k}:
                assert all((k, i) in known for i in range(run * 8, min(run * 8 + 8, len(levels[k]))))
                assert (k + 1, run) not in asked
                known.add((k + 1, run))
        assert (len(levels) - 1, 0) in known


@needs_tables
def test_query_equals_its_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    found = queries.QUERIES["op11_merkle"](spark, SF)
    sql = con.execute(queries.ORACLES["op11_merkle"]).to_arrow_table().select(found.columns).to_pylist()
    assert sorted(map(str, (tuple(r.values()) for r in sql))) == sorted(map(str, map(tuple, found.collect())))
