"""Token counts against the vocabulary's own library."""
import os
import random

import pytest
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor

from trailkeep.llm import queries, transducer
from trailkeep.llm.pieces import MODEL, SPACE

SF = "/root/testdata/sf0.001"
needs_tables = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture(scope="module")
def machine():
    return transducer.Machine(transducer.Vocabulary())


@pytest.fixture(scope="module")
def library():
    return SentencePieceProcessor(model_file=MODEL)


def count(machine, text, width=transducer.CHUNK, before=transducer.BEFORE):
    return machine.count(SPACE + text.replace(" ", SPACE), width, before) if text else 0


def test_counts_of_random_texts(machine, library):
    random.seed(1)
    for alphabet in ("aaabcdeeeinotrst   \n éüñ.,;:\t0123▁ß日本الт𝒳", "ab", "0", "- =", "ion ", ["the", "tion", " a", "in", "  "]):
        for _ in range(400):
            text = "".join(random.choices(alphabet, k=random.randrange(60)))
            assert count(machine, text) == len(library.encode(text)), text


def test_special_strings_and_odd_characters(machine, library):
    for text in ("<s>", "</s> <unk>", "<0x0A>", "a<s>b", "▁a", "ﬁ ½ ①", "\x00", "a\r\n", "　x", " ", "   ", "\n\n", "​", "👩‍👩‍👧 é", "á"):
        assert count(machine, text) == len(library.encode(text)), text


@pytest.mark.parametrize("width, before", [(1, 0), (2, 1), (7, 0), (50, 64)])
def test_state_maps_of_chunks_give_the_same(machine, library, width, before):
    """Also where the likely entry state is wrong, so that maps are extended before they compose."""
    random.seed(2)
    for unit in ("ab", "aab ", "0", "=", "tion", ["in", "ter", "na"], "  a"):
        text = "".join(random.choices(unit, k=150))
        assert count(machine, text, width, before) == len(library.encode(text)), text


def test_scan_composes_every_prefix():
    maps = [{i: (i + 1, 10 ** i), 99: (98, 1)} for i in range(7)]
    assert [m[0] for m in transducer.scan(maps)] == [(i + 1, int("1" * (i + 1))) for i in range(7)]
    assert transducer.compose({1: (2, 3)}, {4: (5, 6)}) == {}


def test_long_unbroken_texts(machine, library):
    for text in ("QUJD" * 50_000, "a" * 100_000, "日" * 40_000, "é\n" * 30_000):
        assert count(machine, text) == len(library.encode(text))


def test_forgetting_changes_nothing(library):
    machine = transducer.Machine(transducer.Vocabulary())
    for text in ("The quick brown fox", "jumps over", "the lazy dog. The quick"):
        assert count(machine, text) == len(library.encode(text))
        machine.clear()
        assert not machine.states and not machine.known


def test_rows(spark, library):
    rows = [(1, "The cat"), (1, "The cat"), (2, None), (3, ""), (None, " \n"), (4, "a " * 5_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("n_tokens", F.lit("x")).withColumn("n_bytes", F.lit(1))
    found = sorted(map(tuple, transducer.count_tokens(docs).collect()), key=str)
    size = [(k, len((t or "").encode()), len(library.encode(t or ""))) for k, t in rows]
    assert found == sorted(((k, b, n, n > 4096) for k, b, n in size), key=str)
    assert transducer.count_tokens(docs.limit(0)).collect() == []


@needs_tables
def test_query_equals_the_library(spark, library):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    plain = {r.doc_id: len(library.encode(r.text or "")) for r in docs}
    found = queries.QUERIES["op12_tokens"](spark, SF)
    assert found.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
    assert {r.doc_id: r.n_tokens for r in found.collect()} == plain
