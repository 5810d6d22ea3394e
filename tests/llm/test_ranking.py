"""Ranked search against plain scoring of every document, and its registered query against its SQL."""
import math
import os
import random
import re
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

from trailkeep.llm import queries, ranking

SF = "/root/testdata/sf0.001"
needs_tables = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


def words(text):
    out, run = [], ""
    for c in (text or "") + " ":
        if ord(c) > 0x7F or c.isalnum():
            run += c.lower() if "A" <= c <= "Z" else c
        elif run:
            out.append(run)
            run = ""
    return out


def plain(docs, items, top):
    """(item_id, rank, doc_id, score) by scoring every document for every item."""
    bags = [(k, Counter(words(t))) for k, t in docs]
    many = sum(bool(b) for _, b in bags)
    length = sum(b.total() for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    out = []
    for item_id, text in items:
        scored = []
        for k, b in bags:
            score = 0
            for t in words(text):
                if b[t]:
                    m = 100 - 25 + 25 * b.total() * many // length
                    score += math.floor(1000 * math.log((2 * many + 2) / (2 * df[t] + 1))) * (10**9 * b[t] // (1000 * b[t] + 12 * m))
            if score > 0:
                scored.append((-score, (k is not None, k or 0), k))
        out += [(item_id, i + 1, k, -s) for i, (s, _, k) in enumerate(sorted(scored)[:top])]
    return sorted(out, key=str)


def ranked(spark, docs, items, **more):
    d = spark.createDataFrame(docs, "doc_id long, text string").withColumn("item", F.lit(1)).withColumn("n", F.lit("x")).repartition(3)
    q = spark.createDataFrame(items, "item_id long, text string").withColumn("doc_id", F.lit(2)).withColumn("doc", F.lit("x"))
    return sorted((tuple(r) for r in ranking.rank(d, q, **more).collect()), key=str)


@pytest.fixture(scope="module")
def corpus():
    random.seed(5)
    vocabulary = [f"w{i}" for i in range(300)]
    weights = [1 / (i + 1) for i in range(300)]
    docs = [(i, " ".join(random.choices(vocabulary, weights, k=random.randrange(1, 80)))) for i in range(400)]
    items = [(i, " ".join(random.choices(vocabulary, weights, k=random.randrange(1, 40)))) for i in range(40)]
    docs += [(1000 + i, items[0][1]) for i in range(60)]
    docs += [(2000, None), (2001, ""), (2002, " \n\t.-_"), (2003, "Éa É w1_W2-ß½ x"), (2004, "w0 " * 50_000), (None, "w1 w2 É"), docs[3], docs[3]]
    items += [(100, None), (101, ""), (102, "É ß½ unknown"), (None, "w5 w5 w6"), items[1], (103, "w0 " * 3_000)]
    return docs, items


@pytest.mark.parametrize("top, owners", [(20, 4), (3, 1), (1, 7), (1_000, 3)])
def test_equals_plain_scoring(spark, corpus, top, owners):
    docs, items = corpus
    assert ranked(spark, docs, items, top=top, owners=owners) == plain(docs, items, top)


def test_several_blocks_and_bundles(spark, corpus, monkeypatch):
    docs, items = corpus
    assert ranked(spark, docs, items, block=64, bundle=7) == plain(docs, items, 20)
    monkeypatch.setattr(ranking, "BROADCAST_ROWS", 0)
    assert ranked(spark, docs, items, block=64, bundle=7) == plain(docs, items, 20)


def test_empty_tables(spark, corpus):
    docs, items = corpus
    assert ranked(spark, [], items) == [] and ranked(spark, docs, []) == [] and ranked(spark, [(1, None)], items) == []
    assert ranked(spark, [(1, "a b")], [(1, "A")]) == plain([(1, "a b")], [(1, "A")], 20)


def test_terms():
    assert ranking.terms_of("Ab ab-AB É½_é 1a") == Counter({"ab": 3, "É½": 1, "é": 1, "1a": 1})
    assert re.sub(r"\s", "", "".join(ranking.terms_of("\x7f\x80"))) == "" or ranking.terms_of("\x7f\x80") == Counter({"\x80": 1})


@needs_tables
def test_query_equals_its_sql(spark):
    con = duckdb.connect()
    for name in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    found = queries.QUERIES["op13_ranking"](spark, SF)
    answer = con.sql(queries.ORACLES["op13_ranking"])
    assert answer.columns == found.columns
    assert sorted(map(tuple, found.collect())) == sorted(answer.fetchall())
    assert found.schema["rank"].dataType.simpleString() == "int"
