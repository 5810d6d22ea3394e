"""What the scorer adds to the base spans: planted forms of personal data and secrets, and none of their look-alikes."""

import random

import pytest
from pyspark.sql import functions as F

from trailkeep.llm import pii

WORDS = "the river meets a quiet harbour where old boats wait for spring and people count seven bridges over it".split()


def luhn_digit(body):
    total = sum(x if i % 2 else 2 * x - 9 * (x > 4) for i, x in enumerate(int(c) for c in reversed(body)))
    return str(-total % 10)


def some(rng, n, letters="0123456789"):
    return "".join(rng.choice(letters) for _ in range(n))


def card(rng, apart=" "):
    body = "4" + some(rng, 14)
    digits = body + luhn_digit(body)
    return apart.join(digits[i:i + 4] for i in range(0, 16, 4))


def national(rng):
    return f"({rng.randrange(200, 999)}) {some(rng, 3)}-{some(rng, 4)}"


KNOWN = [
    lambda r: f"{r.choice(WORDS)}.{some(r, 2)}@mail{some(r, 1)}.example.com", card, lambda r: f"+1 {national(r)}",
    lambda r: f'token = "{some(r, 40, "0123456789abcdef")}"', lambda r: f"api_key: {some(r, 32, 'abcdefghkmABCDEFGHKM23456789')}",
]
ALIKE = [
    lambda r: f"2024-{r.randrange(10, 13)}-{r.randrange(10, 29)}", lambda r: f"version {some(r, 2)}.{some(r, 2)}.{some(r, 2)}.999",
    lambda r: f"{some(r, 2)}/{some(r, 2)}/{some(r, 4)}", lambda r: "well-known/index-2-of-the-old-town-and-its-harbour", lambda r: f"10:{some(r, 2)}:{some(r, 2)}:{some(r, 2)}",
]


def text_of(rng, *parts):
    words = [rng.choice(WORDS) for _ in range(30)]
    for part in parts:
        words.insert(rng.randrange(4, 26), part)
    return " ".join(words)


@pytest.fixture(scope="module")
def scorer(spark):
    rng = random.Random(5)
    texts = [text_of(rng, make(rng)) for make in KNOWN + ALIKE for _ in range(120)]
    return pii.train(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))


def added(spark, scorer, parts):
    """Kind and value of the spans added to one text for each part."""
    rng = random.Random(9)
    texts = [text_of(rng, p) for p in parts]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    base = {r.doc_id: set(r.spans.split(",")) for r in pii.find(frame).collect()}
    found = {}
    for r in pii.find(frame, scorer).collect():
        spans = [s.split(":") for s in r.spans.split(",") if s and s not in base[r.doc_id]]
        found[r.doc_id] = [(k, texts[r.doc_id][int(a):int(b)]) for k, a, b in spans]
    return [found[i] for i in range(len(parts))]


def test_planted_forms_are_added(spark, scorer):
    rng = random.Random(7)
    dotted, hidden, plain = card(rng, "."), "river.42 [at] mail7 [dot] example [dot] com", national(rng)
    bare = some(rng, 40, "0123456789abcdef")
    assert added(spark, scorer, [dotted, hidden, plain, f'"{bare}"']) == [
        [("card", dotted)], [("email", hidden)], [("phone", plain)], [("secret", bare)]]


def test_look_alikes_are_not_added(spark, scorer):
    rng = random.Random(8)
    good = card(rng, ".")
    failing = good[:-1] + str((int(good[-1]) + 1) % 10)
    assert added(spark, scorer, [make(rng) for make in ALIKE] + [failing, "meet [at] noon", "harbour-1-old-boats"]) == [[]] * (len(ALIKE) + 3)


def test_added_spans_overlap_no_base_span(spark, scorer):
    assert added(spark, scorer, [make(random.Random(i)) for i, make in enumerate(KNOWN[:3])]) == [[]] * 3


def test_nothing_is_learned_from_one_sided_or_empty_samples(spark):
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(["", None, "no data here"])], "doc_id long, text string")
    assert pii.train(rows) is None and pii.train(rows.limit(0)) is None
    assert [r.spans for r in pii.find(rows, None).collect()] == ["", "", ""]


def test_every_document_is_learned_from(spark):
    """The only right phones are in one document in a thousand: a sample of the documents would hold hardly any."""
    rng = random.Random(3)
    known, alike = [f"+1 {national(rng)}" for _ in range(40)], [f"10:{some(rng, 2)}:{some(rng, 2)}:{some(rng, 2)}" for _ in range(40)]
    rare = [(i, text_of(rng, part)) for i, part in enumerate(known + alike)]
    many = spark.range(1000, 41_000).select(F.col("id").alias("doc_id"), F.concat(F.lit("an empty harbour "), "id").alias("text"))
    few = spark.createDataFrame(rare, "doc_id long, text string")
    alone = pii.train(few)
    for tasks in (pii.TASK_ROWS, 5):
        assert set(pii.train(few.unionByName(many), tasks).thresholds) == set(alone.thresholds) == {"phone"}
    assert pii.train(few.unionByName(many)).trees == alone.trees
