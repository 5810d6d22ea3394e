"""Which pages to look at: seeds and the post index, else the site map, else the news listings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trailkeep.functions.classify import is_relevant
from trailkeep.functions.extract import same_site
from trailkeep.functions.text import strip
from trailkeep.operators.dedup import dedup_keep_first
from trailkeep.operators.order import first_nonempty, union_records
from trailkeep.operators.pages import extract_links
from trailkeep.rules import SiteRules


def discover_urls(rules: SiteRules, seeds: DataFrame | None = None, posts: DataFrame | None = None,
                  sitemap: DataFrame | None = None, listings: DataFrame | None = None) -> DataFrame:
    """(url, found_in): the distinct addresses on the site, each with the first place that names it.

    ``seeds(url)`` are always in. ``posts`` (a post index) counts where a post on the site is about the topic;
    only if neither names any address is ``sitemap(url)`` read, and only if that is empty as well the
    record-like links of the ``listings(url, html)``. Blank addresses, and those of other sites, are left out.
    """
    def named(urls: DataFrame, rank: int, place: str) -> DataFrame:
        kept = urls.filter(F.coalesce(strip(F.col("url")), F.lit("")) != "").filter(same_site(F.col("url"), base))
        return kept.select("url", F.lit(rank).alias("rank"), F.lit(place).alias("found_in"))

    base, places = F.lit(rules.base_url), []
    first = []
    if seeds is not None:
        first.append(named(seeds.select("url"), 0, "seed"))
    if posts is not None:
        about = same_site(F.col("link"), base) & is_relevant(F.col("title"), F.col("body"), rules.topic, rules.action_terms)
        first.append(named(posts.filter(about).select(F.col("link").alias("url")), 1, "post index"))
    if first:
        places.append(union_records(*first))
    if sitemap is not None:
        places.append(named(sitemap.select("url"), 2, "site map"))
    if listings is not None:
        links = extract_links(listings, rules.base_url, rules.slug_words).select(F.col("target").alias("url"))
        places.append(named(links, 3, "listing"))
    if not places:
        raise ValueError("discovery needs seeds, a post index, a site map or listings")
    found = first_nonempty(*places)
    return dedup_keep_first(found, "url", ["rank", "found_in"], derived=True).select("url", "found_in")
