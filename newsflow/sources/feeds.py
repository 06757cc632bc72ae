"""Feeds: the registry of what to read, landed feed documents, and their entries as articles."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from newsflow import schemas
from newsflow.functions.text import SPACE
from newsflow.operators.identity import article_id
from newsflow.operators.sizing import broadcast_if_small

# The categories in registry order, and the prefix of the settings that list feeds.
CATEGORIES = "technology business science world".split()
SETTING_PREFIX = "RSS_FEEDS_"

ISO_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"

ITEMS = """
item ARRAY<STRUCT<
  title: STRING, link: STRING, guid: STRUCT<_VALUE: STRING, _isPermaLink: STRING>,
  description: STRING, `content:encoded`: STRING, author: STRING, `dc:creator`: STRING,
  pubDate: STRING, `dc:date`: STRING>>,
_corrupt_record STRING
"""
RSS_SCHEMA = f"title STRING, {ITEMS}"
# RSS 1.0 has its items beside the channel.
RDF_SCHEMA = f"channel STRUCT<title: STRING>, {ITEMS}"
ATOM_SCHEMA = """
title STRING,
entry ARRAY<STRUCT<
  title: STRING, link: ARRAY<STRUCT<_href: STRING, _rel: STRING>>, summary: STRING,
  content: ARRAY<STRING>, author: STRUCT<name: STRING>, published: STRING, updated: STRING>>,
_corrupt_record STRING
"""


def flatten_registry(settings: DataFrame) -> DataFrame:
    """``(category, category_pos, feeds)`` rows, feeds comma-separated, to one row per feed."""
    listed = settings.select(
        "category", "category_pos", F.posexplode(F.split("feeds", ",")).alias("feed_pos", "listed")
    )
    trimmed = F.regexp_replace("listed", f"^[{SPACE}]+|[{SPACE}]+$", "")
    return (
        listed.withColumn("feed_url", trimmed)
        .where(F.col("feed_url") != "")
        .select(*schemas.REGISTRY.fieldNames())
    )


def registry_from_settings(spark: SparkSession, settings: Mapping[str, str]) -> DataFrame:
    """Registry from ``{'RSS_FEEDS_<CATEGORY>': 'url, url'}`` (for instance the environment)."""
    rows = [
        (category, pos, settings.get(SETTING_PREFIX + category.upper(), ""))
        for pos, category in enumerate(CATEGORIES)
    ]
    return flatten_registry(
        spark.createDataFrame(rows, "category STRING, category_pos INT, feeds STRING")
    )


def attach_category(
    feeds: DataFrame, registry: DataFrame, feed_key: Column | None = None
) -> DataFrame:
    """Give every landed feed or entry the category and registry position of its feed.

    ``feed_key`` is the MD5 of the feed address when feeds are known by their landing folder;
    without it the two sides share ``feed_url``.
    """
    if feed_key is not None:
        keyed = registry.withColumn("_feed_key", F.md5("feed_url"))
        side = broadcast_if_small(keyed)
        return feeds.withColumn("_feed_key", feed_key).join(side, "_feed_key").drop("_feed_key")
    return feeds.join(broadcast_if_small(registry), "feed_url")


def _landing(df: DataFrame) -> DataFrame:
    path = F.col("_metadata.file_path")
    return df.select(
        "*",
        F.regexp_extract(path, "([^/]+)/[^/]+$", 1).alias("feed_key"),
        F.col("_metadata.file_modification_time").alias("ingested_at"),
    )


def rss_entries(channels: DataFrame, *carried: str) -> DataFrame:
    """One row per entry of parsed RSS channels, in feed order; unreadable feeds give none."""
    items = channels.where(F.col("_corrupt_record").isNull()).select(
        *carried, F.col("title").alias("source"), F.posexplode("item").alias("entry_pos", "item")
    )
    return items.select(
        *carried,
        "entry_pos",
        F.col("item.title").alias("title"),
        F.col("item.description").alias("summary"),
        F.col("item.content:encoded").alias("content"),
        _item_link(F.col("item")).alias("link"),
        F.coalesce("item.author", "item.dc:creator").alias("author"),
        F.coalesce("item.pubDate", "item.dc:date").alias("published"),
        "source",
    )


def _item_link(item: Column) -> Column:
    """The link, or else the identifier where it is not said to be no permanent link."""
    permanent = F.lower(F.coalesce(item["guid"]["_isPermaLink"], F.lit("true"))) == "true"
    return F.coalesce(F.nullif(item["link"], F.lit("")), F.when(permanent, item["guid"]["_VALUE"]))


def rdf_entries(feeds: DataFrame, *carried: str) -> DataFrame:
    """One row per entry of parsed RSS 1.0 documents."""
    return rss_entries(feeds.withColumn("title", F.col("channel.title")), *carried)


def atom_entries(feeds: DataFrame, *carried: str) -> DataFrame:
    """One row per entry of parsed Atom feeds; the link is the first alternate one.

    Content is text, or the markup inside the element where it is given as elements.
    """
    entries = feeds.where(F.col("_corrupt_record").isNull()).select(
        *carried, F.col("title").alias("source"), F.posexplode("entry").alias("entry_pos", "entry")
    )
    alternate = F.filter(
        "entry.link", lambda link: F.coalesce(link["_rel"], F.lit("alternate")) == "alternate"
    )
    return entries.select(
        *carried,
        "entry_pos",
        F.col("entry.title").alias("title"),
        F.col("entry.summary").alias("summary"),
        F.get("entry.content", F.lit(0)).alias("content"),
        F.get(alternate, F.lit(0))["_href"].alias("link"),
        F.col("entry.author.name").alias("author"),
        F.coalesce("entry.published", "entry.updated").alias("published"),
        "source",
    )


DIALECTS = {
    "rss": ("channel", RSS_SCHEMA, rss_entries),
    "rdf": ("rdf:RDF", RDF_SCHEMA, rdf_entries),
    "atom": ("feed", ATOM_SCHEMA, atom_entries),
}


def read_feeds(
    spark: SparkSession,
    path: str,
    dialect: str = "any",
    streaming: bool = False,
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """Entries of landed feed documents, ``<path>/<md5 of feed address>/<file>.xml``.

    ``dialect`` is rss, rdf (RSS 1.0) or atom, or ``any`` for folders that hold all of them: each
    document then gives entries in its own dialect and none in the others. A malformed document
    yields no rows. Adds ``feed_key`` (the folder) and ``ingested_at``.
    """
    if dialect == "any":
        found = [read_feeds(spark, path, d, streaming, max_files_per_trigger) for d in DIALECTS]
        return reduce(DataFrame.unionByName, found)
    tag, schema, entries = DIALECTS[dialect]
    reader = spark.readStream if streaming else spark.read
    reader = reader.format("xml").schema(schema).option("rowTag", tag)
    reader = reader.option("columnNameOfCorruptRecord", "_corrupt_record")
    reader = reader.option("recursiveFileLookup", "true")
    if streaming and max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return entries(_landing(reader.load(path)), "feed_key", "ingested_at")


def normalize_articles(entries: DataFrame, *carried: str) -> DataFrame:
    """Fill the defaults of missing entry fields and give every article its id.

    ``crawled_at`` and a missing ``published`` are the time the document was landed.
    """
    def filled(name: str, default: str = "") -> Column:
        return F.coalesce(F.col(name), F.lit(default)).alias(name)

    crawled = F.date_format("ingested_at", ISO_FORMAT)
    return entries.select(
        article_id(F.col("link")).alias("id"),
        filled("title"),
        filled("summary"),
        filled("content"),
        filled("link"),
        filled("author", "Unknown"),
        F.coalesce(F.col("published"), crawled).alias("published"),
        filled("source", "Unknown"),
        "category",
        crawled.alias("crawled_at"),
        *carried,
    )
