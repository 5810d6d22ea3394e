"""Benchmark decontamination by template windows, DataFrame functions only.

Texts become templates: words without punctuation, with typed placeholders for numbers, units and names; a run of
names or of numbers is one placeholder. Windows of benchmark templates are looked up at every word of the documents'
templates; the first hit of a run of agreeing words fixes an alignment, which is then compared word by word, also
with parts of the item that stand a few words off. Equal values of the item's slots must stand for equal values in
the document, so a question asked again with other numbers or names is found and a chance likeness is not.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trailkeep.llm.common import broadcast_if_small, staged

#: Window widths in words; an item uses the first of which it has 2 * width - 1 words, and one of fewer than five its own length.
WIDTHS = (8, 4, 3)
SHORT = 4
#: An alignment counts if at least this share of the item's words agrees, and of its words that are no slots.
SHARE = 0.5
#: Parts of an item count if they agree in so many words in a row at most so many words off the alignment.
RUN, DRIFT = 3, 6
#: Windows looked up at once: more are broadcast one part after the other.
KEYS_AT_ONCE = 500_000
JOINED = "\ue003"
NUMBER, UNIT, NAME = "\ue000", "\ue001", "\ue002"
#: Names begin with a capital within a sentence; words of capitals alone are names only beside a lower-case word.
_CAPITALS = r"\p{Lu}[\p{Lu}'’-]*(?![\p{L}'’-])"
_NAMES = (rf"(?<=[^.!?:;\s] )(?:\p{{Lu}}[\p{{Lu}}'’-]*\p{{Ll}}[\p{{L}}'’-]*|(?<=\p{{Ll}} ){_CAPITALS}|"
          rf"{_CAPITALS}(?=[^\p{{L}}\p{{N}}]{{1,3}}\p{{Ll}}))")
_NUMBERS = r"(?<![\p{L}\p{N}])[$€£+-]?\p{Nd}[\p{L}\p{Nd}]*(?:[.,:/]\p{Nd}+)*"
# Units that follow a number.
_UNITS = (
    "mm|cm|m|km|inch|inches|ft|feet|foot|yard|yards|mile|miles|mg|g|kg|gram|grams|ton|tons|tonnes|lb|lbs|pound|pounds|ounce|ounces|ml|l|liter|liters|"
    "litre|litres|gallon|gallons|s|sec|second|seconds|min|minute|minutes|h|hour|hours|day|days|week|weeks|month|months|year|years|dollar|dollars|"
    "cent|cents|euro|euros|usd|eur|percent|degree|degrees|mph|kmh|watt|watts|volt|volts|hz|kb|mb|gb")


def marked(text: Column) -> Column:
    """The words of a text in lower case without punctuation; numbers, units and names begin with their placeholder, and a
    run of names or of numbers is one word."""
    plain = F.translate(text, NUMBER + UNIT + NAME + JOINED, "")
    named = F.regexp_replace(plain, f"({_NAMES})", f"{NAME}$1")
    numbered = F.regexp_replace(named, f"({_NUMBERS})", f"{NUMBER}$1")
    kept = F.regexp_replace(F.lower(numbered), rf"[^\p{{L}}\p{{N}}{NUMBER}{UNIT}{NAME}\s]+", "")
    words = F.regexp_replace(F.trim(F.regexp_replace(kept, r"\s+", " ")), f"({NUMBER}[^ ]* )((?:{_UNITS})(?= |$))", f"$1{UNIT}$2")
    for kind in (NAME, NUMBER):
        words = F.regexp_replace(words, f"((?<![^ ]){kind}[^ ]*) (?={kind})", f"$1{JOINED}")
    return words


def template(words: Column) -> Column:
    """The words of a ``marked`` text with bare placeholders; word for word aligned with ``values``."""
    return F.split(F.regexp_replace(words, f"(?<![^ ])([{NUMBER}{UNIT}{NAME}])[^ ]*", "$1"), " ")


def values(words: Column) -> Column:
    return F.split(words, " ")


def _window(words: str, at: Column, width: int) -> Column:
    return F.xxhash64(F.lit(width), *[F.get(F.col(words), at + k) for k in range(width)])


def _is_slot(word: Column) -> Column:
    return word.isin(NUMBER, UNIT, NAME)


def find(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Columns ``doc_id, item_id, start, n_words, n_same, n_slots, exact``: one row per aligned item of ``benchmark(item_id,
    text)`` in ``docs(doc_id, text)``; ``exact`` tells that slots have the item's own values.

    Every place with ``width`` agreeing words in a row is looked at; parts of the item up to ``DRIFT`` words off it are
    added. Items of fewer than five words match by their whole template, those of slots alone only with their own
    values; items without a word, and null texts on either side, match nothing. ``start`` counts the document's
    words; in the other numbers a run of names or of numbers is one word. Documents or items that share an id are
    reported under it once per start; null ids stay null. Other columns are ignored; an empty table on either side
    gives an empty result.
    """
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), marked(F.col("text").cast("string")).alias("m")).where("m <> ''")
    items = staged(items.select("item_id", template(F.col("m")).alias("wanted"), values(F.col("m")).alias("asked"))
                   .withColumn("item", F.xxhash64("item_id", "wanted", "asked")))
    n = F.size("wanted")
    width = F.coalesce(*[F.when(n >= 2 * w - 1, F.lit(w)) for w in WIDTHS], n)
    used = sorted(r.w for r in items.select(width.alias("w")).distinct().collect())
    if not used:
        used = [WIDTHS[0]]
    looked = [items.where(width == w).select("item", "wanted", F.explode(F.sequence(F.lit(0), n - w)).alias("of")).select(
        "item", "of", _window("wanted", F.col("of"), w).alias("h"),
        F.when(F.col("of") > 0, F.xxhash64(F.get("wanted", F.col("of") - 1))).alias("before")) for w in used]
    keys = looked[0]
    for more in looked[1:]:
        keys = keys.unionByName(more)
    keys = staged(keys)
    parts = -(-keys.count() // KEYS_AT_ONCE) or 1

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), marked(F.col("text").cast("string")).alias("m")).where("text IS NOT NULL")
    cut = texts.withColumn("words", template(F.col("m")))
    cut = cut.withColumn("at", F.explode(F.sequence(F.lit(0), F.size("words") - 1)))
    hashes = [F.when(F.col("at") + w <= F.size("words"), _window("words", F.col("at"), w)) for w in used]
    cut = cut.withColumn("h", hashes[0] if len(hashes) == 1 else F.explode(F.array(*hashes)))
    # of a run of agreeing words only the first window goes on
    begins = F.col("before").isNull() | (F.col("at") == 0) | (F.xxhash64(F.get("words", F.col("at") - 1)) != F.col("before"))
    hits = None
    for part in range(parts):
        some = F.broadcast(keys.where(F.pmod("h", F.lit(parts)) == part))
        found = cut.join(some, "h").where(begins).select("doc_id", "m", "words", "item", (F.col("at") - F.col("of")).alias("start"))
        hits = found if hits is None else hits.unionByName(found)
    return _compared(hits.join(broadcast_if_small(items, 20_000), "item"))


def _compared(hits: DataFrame) -> DataFrame:
    n = F.size("wanted")
    at = lambda column, i: F.get(F.col(column), i)

    def agrees(i: Column, d: Column) -> Column:
        place = F.col("start") + i + d
        return F.coalesce((i >= 0) & (place >= 0) & (at("wanted", i) == at("words", place)), F.lit(False))

    def in_run(i: Column, d: Column) -> Column:
        runs = [reduce(lambda a, b: a & b, [agrees(i + k, d) for k in range(low, low + RUN) if k]) for low in range(1 - RUN, 1)]
        return agrees(i, d) & reduce(lambda a, b: a | b, runs)

    each = F.sequence(F.lit(0), n - 1)
    pair = lambda i, d: F.struct(i.alias("i"), d.alias("d"), at("asked", i).alias("item"), at("values", F.col("start") + i + d).alias("doc"))
    drifts = F.array(*[F.lit(d) for d in sorted(range(-DRIFT, DRIFT + 1), key=abs)])
    straight = F.transform(F.filter(each, lambda i: agrees(i, F.lit(0))), lambda i: pair(i, F.lit(0)))
    shifted = F.filter(F.transform(each, lambda i: pair(i, F.get(F.filter(drifts, lambda d: in_run(i, d)), F.lit(0)))), lambda p: p["d"].isNotNull())
    # as inputs of generators the comparisons run once a hit; a filter on their result would repeat them inside the join
    hits = hits.withColumn("values", values(F.col("m")))
    hits = hits.withColumn("same", F.explode(F.array(F.struct(straight.alias("straight"), shifted.alias("shifted")))))
    literal = F.size(F.filter("wanted", lambda w: ~_is_slot(w)))

    def judged(same: Column) -> Column:
        slots = F.filter(same, lambda p: _is_slot(at("wanted", p["i"])))
        pairs = F.array_distinct(F.transform(slots, lambda p: F.struct(p["item"].alias("item"), p["doc"].alias("doc"))))
        literal_same = F.size(same) - F.size(slots)
        consistent = F.size(F.array_distinct(F.transform(pairs, lambda p: p["item"]))) == F.size(pairs)
        exact = F.forall(pairs, lambda p: p["item"] == p["doc"])
        enough = F.when(n <= SHORT, (F.size(same) == n) & ((literal > 0) | exact)).otherwise(
            (F.size(same) >= SHARE * n) & (literal_same >= SHARE * literal) & (literal_same >= 3))
        first = F.col("start") + F.get(same, F.lit(0))["d"]
        # words of the document before the first one, where runs are one word here
        gone = F.array_join(F.slice("values", 1, F.greatest(first, F.lit(0))), "")
        start = first + F.length(gone) - F.length(F.translate(gone, JOINED, ""))
        return F.when(consistent & enough, F.struct(
            start.alias("start"), F.size(same).alias("n_same"), F.size(pairs).alias("n_slots"), exact.alias("exact")))

    good = F.filter(F.array(F.coalesce(judged(F.col("same.shifted")), judged(F.col("same.straight")))), lambda x: x.isNotNull())
    return hits.withColumn("x", F.explode(good)).groupBy(
        "doc_id", F.expr("item"), F.col("x.start").alias("start")).agg(
        F.min("item_id").alias("item_id"), F.max(n).alias("n_words"), F.max("x.n_same").alias("n_same"), F.max("x.n_slots").alias("n_slots"),
        F.bool_or("x.exact").alias("exact"),
    ).select("doc_id", "item_id", F.col("start").cast("long").alias("start"), "n_words", "n_same", "n_slots", "exact").distinct()


def without_benchmark(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that hold no benchmark item, all columns as they were; a null id cannot be named and stays."""
    found = find(docs, benchmark).select(F.col("doc_id").alias("_found")).where("_found IS NOT NULL").distinct()
    found = broadcast_if_small(staged(found))
    return docs.join(found, F.col("doc_id").cast("long") == F.col("_found"), "left_anti")
