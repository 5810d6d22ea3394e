"""Saved web evidence: page files, post archives, site maps."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trailkeep.functions.classify import mentions_any
from trailkeep.functions.extract import same_site, to_date
from trailkeep.functions.text import html_unescape, strip, strip_html
from trailkeep.rules import SLUG_WORDS

POST_INDEX_SCHEMA = (
    "id bigint, date string, link string, title struct<rendered:string>, content struct<rendered:string>"
)


def read_pages(spark: SparkSession, path: str, url: str = "url", html: str = "html") -> DataFrame:
    """(url, html) of a page table in Parquet, or of saved files (``*.html``) named by their path."""
    if path.rstrip("/").endswith(".parquet"):
        return spark.read.parquet(path).select(F.col(url).alias("url"), F.col(html).alias("html"))
    files = spark.read.text(path, wholetext=True)
    return files.select(F.col("_metadata.file_path").alias("url"), F.col("value").alias("html"))


def read_post_index(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """(id, date, link, title, body) of JSON arrays of posts; markup removed.

    ``multi_line`` reads one array per file, however it is laid out; without it every line holds an
    array or a post, and large files are split among tasks.
    """
    posts = spark.read.schema(POST_INDEX_SCHEMA).option("multiLine", multi_line).json(path)
    return posts.select(
        "id", to_date(F.left("date", F.lit(10))).alias("date"), "link",
        F.coalesce(strip_html(F.col("title.rendered")), F.lit("")).alias("title"),
        F.coalesce(strip_html(F.col("content.rendered")), F.lit("")).alias("body"),
    )


def read_sitemap(spark: SparkSession, path: str, base_url: str | None = None,
                 slug_words: Sequence[str] = SLUG_WORDS) -> DataFrame:
    """(url) entries of XML site maps, read line by line, on the site whose address holds a slug word."""
    lines = spark.read.text(path)
    locs = lines.select(F.explode(F.regexp_extract_all("value", F.lit(r"(?i)<loc>(.*?)</loc>"), F.lit(1))).alias("loc"))
    urls = locs.select(html_unescape(strip(F.col("loc"))).alias("url")).filter(F.col("url") != "")
    if base_url:
        urls = urls.filter(same_site(F.col("url"), F.lit(base_url)))
    return urls.filter(mentions_any(F.lower("url"), slug_words)) if slug_words else urls
