"""The registered queries of this subpackage, with SQL where SQL can state them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trailkeep.llm import (
    codec, decontaminate, html_text, language, licenses, lines, merkle, minhash, pii, ranking, sharding, transducer, vectors,
)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def _query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def _table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


@_query("op1_licenses")
def op1_licenses(spark: SparkSession, sf: str) -> DataFrame:
    return licenses.scan(_table(spark, sf, "documents"))


@_query("op2_sharding")
def op2_sharding(spark: SparkSession, sf: str) -> DataFrame:
    names = [f"shard-{i:03d}" for i in range(sharding.SHARDS)]
    return sharding.place(_table(spark, sf, "documents").select("doc_id", "source", "n_chars"), "doc_id", names)


@_query("op3_language")
def op3_language(spark: SparkSession, sf: str) -> DataFrame:
    docs = _table(spark, sf, "documents").select("doc_id", "text", "lang")
    held = F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))
    found = language.identify(docs, language.train(docs.where(~held)))
    return found.select("doc_id", held.alias("held_out"), "lang_pred", "score")


@_query("op4_minhash")
def op4_minhash(spark: SparkSession, sf: str) -> DataFrame:
    return minhash.near_duplicates(_table(spark, sf, "documents"))


@_query("op5_vectors")
def op5_vectors(spark: SparkSession, sf: str) -> DataFrame:
    return vectors.near_duplicates(_table(spark, sf, "embeddings"))


@_query("op6_sentencepiece")
def op6_sentencepiece(spark: SparkSession, sf: str) -> DataFrame:
    return codec.encode(_table(spark, sf, "documents"))


@_query("op7_html")
def op7_html(spark: SparkSession, sf: str) -> DataFrame:
    return html_text.extract(_table(spark, sf, "pages"))


@_query("op8_decontamination")
def op8_decontamination(spark: SparkSession, sf: str) -> DataFrame:
    return decontaminate.find(_table(spark, sf, "documents"), _table(spark, sf, "benchmark"))


@_query("op9_pii")
def op9_pii(spark: SparkSession, sf: str) -> DataFrame:
    docs = _table(spark, sf, "documents")
    return pii.find(docs, pii.train(docs))


@_query("op10_lines", """
WITH each AS (SELECT doc_id, source, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM documents),
spread AS (
  SELECT trim(line) AS line, min(doc_id) AS first_doc FROM each WHERE source IS NOT NULL AND trim(line) <> ''
  GROUP BY 1 HAVING count(DISTINCT source) >= 10),
kept AS (
  SELECT e.doc_id, e.pos, e.line, s.line IS NULL OR e.doc_id = s.first_doc AS stays
  FROM each e LEFT JOIN spread s ON trim(e.line) = s.line)
SELECT d.doc_id, count(k.pos) AS n_lines, count(k.pos) FILTER (NOT stays) AS n_removed,
       CASE WHEN d.text IS NOT NULL THEN coalesce(string_agg(k.line, chr(10) ORDER BY pos) FILTER (stays), '') END AS text
FROM documents d LEFT JOIN kept k USING (doc_id) GROUP BY d.doc_id, d.text""")
def op10_lines(spark: SparkSession, sf: str) -> DataFrame:
    return lines.dedup_lines(_table(spark, sf, "documents"))


def _merkle_sql(levels: int = 8, top: int = 4) -> str:
    """Trees of up to 8 ** levels leaves and 8 ** top languages, one query part a level."""
    def sha(cells: str) -> str:
        return f"sha256({cells})"

    def cell(c: str) -> str:
        return f"coalesce(strlen(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), '-')"

    def text_leaf(text: str) -> str:
        return sha(" || ".join(map(cell, ("doc_id", "source", "lang", "n_chars", text))))

    low = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    digits = "list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: ord(x)::BIGINT)"
    bit = "list_reduce(list_prepend(xor(c, b), range(8)), lambda x, i: CASE WHEN x % 2 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)"
    crc = f"xor(list_reduce(list_prepend(4294967295, {digits}), lambda c, b: {bit}), 4294967295)"

    def grow(name: str, key: str, depth: int) -> str:
        parts = ""
        for i in range(depth):
            parts += f""",
{name}{i}g AS (SELECT {key} AS k, idx // 8 AS run, count(*) AS c, max(n) AS n, list(h ORDER BY idx) AS hs FROM {name}{i} GROUP BY 1, 2),
{name}{i + 1} AS (SELECT k, run AS idx, CASE WHEN n = 1 THEN hs[1] ELSE {sha("array_to_string(hs, '')")} END AS h,
  CAST(ceil(n / 8.0) AS BIGINT) AS n FROM {name}{i}g)"""
        return parts

    joins, left, right, names = [], [], [], []
    for name, depth, at, key in (("a", levels, "z.idx", "z.k"), ("t", top, "z.tree", "0")):
        for i in range(depth):
            g = f"{name}{i}g"
            names.append(g)
            joins.append(f"JOIN {g} ON {g}.k = {key} AND {g}.run = {at} // {8 ** (i + 1)}")
            place = f"({at} // {8 ** i}) % 8"
            left.append(f"array_to_string({g}.hs[1:{place}], '')")
            right.append(f"array_to_string({g}.hs[{place} + 2:], '')")
    steps = [f"CASE WHEN {g}.n = 1 THEN '' ELSE {x} || {y} END" for g, x, y in zip(names, left, right)]
    ones = ", ".join(f"{g}.n = 1" for g in names)
    folds = []
    for i in range(len(names)):
        folded = sha(f"lefts[{i + 1}] || v || rights[{i + 1}]")
        folds.append(f"f{i + 1} AS (SELECT f{i}.* EXCLUDE v, CASE WHEN one[{i + 1}] THEN v ELSE {folded} END AS v FROM f{i})")
    return f"""
WITH each AS (
  SELECT doc_id, lang, {text_leaf("text")} AS leaf,
         CASE WHEN {crc} % 3 = 0 THEN {text_leaf(low)} ELSE {text_leaf("text")} END AS claimed FROM documents),
langs AS (SELECT lang, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS tree, count(*) AS n FROM each GROUP BY lang),
placed AS (
  SELECT l.tree AS k, l.tree, l.n, e.doc_id, e.leaf, e.claimed,
         row_number() OVER (PARTITION BY l.tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx
  FROM each e JOIN langs l ON e.lang IS NOT DISTINCT FROM l.lang),
a0 AS (SELECT k, idx, leaf AS h, n FROM placed){grow("a", "k", levels)},
t0 AS (SELECT 0 AS k, k AS idx, h, count(*) OVER () AS n FROM a{levels}){grow("t", "k", top)},
f0 AS (
  SELECT z.doc_id, z.leaf, a{levels}.h AS subroot, t{top}.h AS root, sha256({" || ".join(steps)}) AS proof_sha256,
         [{ones}] AS one, [{", ".join(left)}] AS lefts, [{", ".join(right)}] AS rights, z.claimed AS v
  FROM placed z {" ".join(joins)} JOIN a{levels} ON a{levels}.k = z.k CROSS JOIN t{top}),
{", ".join(folds)}
SELECT doc_id, leaf, subroot, root, proof_sha256, v AS folded_root, v = root AS verified FROM f{len(folds)}"""


@_query("op11_merkle", _merkle_sql())
def op11_merkle(spark: SparkSession, sf: str) -> DataFrame:
    docs = _table(spark, sf, "documents")
    tampered = F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(3)) == 0, F.lit(False))
    claimed = F.when(tampered, merkle.lowered(F.col("text"))).otherwise(F.col("text"))
    return merkle.prove(merkle.build(docs, claimed)).drop("proof")


@_query("op12_tokens")
def op12_tokens(spark: SparkSession, sf: str) -> DataFrame:
    return transducer.count_tokens(_table(spark, sf, "documents"))


_TERMS = "regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')"


@_query("op13_ranking", f"""
WITH d AS (SELECT doc_id, unnest({_TERMS}) AS term FROM documents),
q AS (SELECT item_id, term, count(*) AS times FROM (SELECT item_id, unnest({_TERMS}) AS term FROM benchmark) GROUP BY 1, 2),
len AS (SELECT doc_id, count(*) AS n FROM d GROUP BY 1),
total AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM len),
tf AS (SELECT doc_id, term, count(*) AS tf FROM d GROUP BY 1, 2),
w AS (SELECT term, CAST(floor(1000 * ln((2 * any_value(docs) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM tf CROSS JOIN total GROUP BY 1),
scored AS (
  SELECT item_id, doc_id, CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * docs) // terms)))) AS BIGINT) AS score
  FROM q JOIN tf USING (term) JOIN w USING (term) JOIN len USING (doc_id) CROSS JOIN total GROUP BY 1, 2)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
FROM scored WHERE score > 0 QUALIFY rank <= 20""")
def op13_ranking(spark: SparkSession, sf: str) -> DataFrame:
    return ranking.rank(_table(spark, sf, "documents"), _table(spark, sf, "benchmark"))
