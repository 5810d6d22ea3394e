"""Review decisions joined to their evidence, and access rules applied to URLs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trailkeep.functions.extract import url_host
from trailkeep.operators.dedup import refuse_repeated
from trailkeep.operators.quality import GateError
from trailkeep.operators.skew import lookup_join
from trailkeep.session import checkpointed


def apply_review(decisions: DataFrame, posts: DataFrame, key: str, found: Sequence[str]) -> DataFrame:
    """Each decision with the ``found`` columns of its post. An unknown or repeated post is an error.

    The decisions are the small side: only the posts they name are kept and checked.
    """
    named = decisions.select(F.col(key).cast(posts.schema[key].dataType).alias(key)).distinct()
    known = checkpointed(lookup_join(posts.select(key, *found), named, [key], "left_semi"))
    refuse_repeated(known.select(key), key, "one post per id")
    reviewed = lookup_join(decisions, known.withColumn("__known", F.lit(True)), [key], "left")
    lost = reviewed.filter(F.col("__known").isNull()).agg(
        F.count(F.lit(1)).alias("n"), F.min(key).cast("string").alias("k")
    ).first()
    if lost.n:
        raise GateError([("decision without a post", lost.n, lost.k)])
    return reviewed.drop("__known")


def filter_admitted(urls: DataFrame, rules: DataFrame, url: str = "url") -> DataFrame:
    """URLs that the rules of their host do not forbid: the first rule whose prefix fits decides.

    ``rules`` holds (host, rule_order, allow, prefix); a host without rules admits everything. Of rules
    with one order the one of smaller prefix decides. A path is tried at the lengths of its host's prefixes, of
    which there are few, and meets the rules on equal host and prefix, however many rules a host has.
    """
    each = urls.select(F.col(url).alias("__url")).distinct()
    path = F.regexp_replace("__url", r"\A[^:/?#]+://[^/?#]*|#.*", "")
    keyed = each.select("__url", url_host(F.col("__url")).alias("__host"), F.when(path == "", "/").otherwise(path).alias("__path"))
    best = F.min_by(F.struct("rule_order", "allow"), F.struct("rule_order", "allow"))
    rules = checkpointed(
        rules.filter(F.col("prefix").isNotNull()).groupBy(F.col("host").alias("__host"), "prefix").agg(best.alias("__rule")))
    spans = checkpointed(rules.groupBy("__host").agg(F.collect_set(F.length("prefix")).alias("__spans")))
    ruled = lookup_join(keyed, spans, ["__host"], "inner")
    heads = F.filter("__spans", lambda n: n <= F.length("__path"))
    tried = ruled.select("__url", "__host", "__path", F.explode(heads).alias("__n")).select(
        "__url", "__host", F.substring("__path", F.lit(1), F.col("__n")).alias("prefix"))
    fits = lookup_join(tried, rules, ["__host", "prefix"], "inner")
    first = fits.groupBy("__url").agg(F.min_by("__rule.allow", F.struct("__rule.rule_order", "prefix", "__rule.allow")).alias("allow"))
    denied = checkpointed(first.filter(~F.col("allow")).select(F.col("__url").alias(url)))
    return lookup_join(urls, denied, [url], "left_anti")
