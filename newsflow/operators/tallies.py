"""Tallies kept beside the stored table: one set per batch, rolled up when they are looked at.

A batch's tally is taken from what is stored of it, under the batch's own run and number, so a replay
adds nothing and a batch whose tally was lost gets it at the replay. Tallies add up: over batches, over
hours and over facets. Where the table's small folders are merged, tallies are merged to sums.
"""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsflow.functions.text import SPACE
from newsflow.operators import dashboard as D
from newsflow.operators import reports as R
from newsflow.schemas import PROCESSED
from newsflow.sources.articles import read_processed
from newsflow.sources.stored import StoredTable, date_of

FOLDERS = {"facets": "_tallies/facets", "keywords": "_tallies/keywords"}
SUMS = ("articles", "compound_sum", "compound_seen", "length_sum", "length_seen")
SCHEMAS = {
    "facets": "category string, source string, sentiment string, processed_at timestamp, "
    "articles long, compound_sum double, compound_seen long, length_sum double, length_seen long",
    "keywords": "category string, source string, sentiment string, keyword string, count long",
}


def keyword_tally(df: DataFrame) -> DataFrame:
    """How many articles of each choice of facets list each keyword, by day."""
    listed = F.explode(F.split("keywords", ",")).alias("listed")
    day = F.to_date("processed_at").alias("date")
    words = df.select(*D.FACETS, day, listed)
    word = F.regexp_replace("listed", f"^[{SPACE}]+|[{SPACE}]+$", "").alias("keyword")
    return words.groupBy(*D.FACETS, "date", word).agg(F.count(F.lit(1)).alias("count"))


def facet_tally(df: DataFrame) -> DataFrame:
    """Counts and sums of each choice of facets and clock hour, by day."""
    return D.board_tally(df).withColumn("date", F.to_date("processed_at"))


TALLIES = {"facets": facet_tally, "keywords": keyword_tally}


def combine(kind: str, tallies: DataFrame) -> DataFrame:
    """Tallies of one kind added up: one row per key."""
    sums = [c for c in (*SUMS, "count") if c in tallies.columns]
    keys = [c for c in tallies.columns if c not in sums]
    return tallies.groupBy(*keys).agg(*(F.sum(c).alias(c) for c in sums))


def top_keywords(tallies: DataFrame, limit: int = R.DEFAULT_TOP_KEYWORDS) -> DataFrame:
    """As ``dashboard.top_keywords``, from a tally."""
    counts = tallies.groupBy("keyword").agg(F.sum("count").alias("count"))
    return counts.orderBy(F.desc("count"), "keyword").limit(limit)


class TalliedTable:
    """The stored table under a path with its tallies."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.table = spark, StoredTable(spark, path)
        self.tallies = {
            kind: StoredTable(spark, f"{self.table.path}/{folder}") for kind, folder in FOLDERS.items()
        }

    def append(self, df: DataFrame, run: str, batch_id: int) -> bool:
        """Store a batch (with a column ``date``) and its tallies; False if all of it was there."""
        new = self.table.append(df, run, batch_id)
        missing = [
            kind for kind, stored in self.tallies.items() if not stored.state().committed(run, batch_id)
        ]
        if missing:
            folders = self.table.batch_folders(run, batch_id)
            rows = self.table.read(PROCESSED, folders)
            for kind in missing:
                new = self.tallies[kind].append(TALLIES[kind](rows), run, batch_id) or new
        return new

    def is_complete(self) -> bool:
        """Whether every stored batch has its tallies (those from before tallies were kept do not)."""
        batches = self.table.state().known()
        return all(stored.state().known() == batches for stored in self.tallies.values())

    def compact(self, **settings) -> int:
        """Merge small folders of the table, and the tallies' to sums. Call it when every batch has
        its tallies."""
        if not self.is_complete():
            raise RuntimeError("some stored batch has no tallies yet")
        for kind, stored in self.tallies.items():
            stored.compact(combine=lambda df, kind=kind: combine(kind, df), **settings)
        return self.table.compact(**settings)

    def tally(self, kind: str, since: str | None = None, until: str | None = None) -> DataFrame:
        stored = self.tallies[kind]
        return stored.read(SCHEMAS[kind], stored.folders(since, until))

    def latest(self, limit: int = R.DEFAULT_LATEST, **facets: str) -> DataFrame:
        return latest_stored(self.spark, self.table.path, limit, **facets)

    def view(self, **facets: str) -> dict[str, DataFrame]:
        """Every dashboard figure; no article but the latest ones is read."""
        counted = D.filter_articles(self.tally("facets"), **facets)
        return {
            "kpis": D.tallied_kpis(counted),
            "sentiment_counts": D.SENTIMENT_COUNTS.roll_up(counted),
            "category_counts": D.CATEGORY_COUNTS.roll_up(counted),
            "category_sentiment_counts": D.CATEGORY_SENTIMENT_COUNTS.roll_up(counted),
            "articles_over_time": D.tallied_over_time(counted),
            "top_keywords": top_keywords(D.filter_articles(self.tally("keywords"), **facets)),
            "source_stats": D.SOURCE_STATS.roll_up(counted),
            "latest": self.latest(**facets),
        }


def latest_stored(
    spark: SparkSession, path: str, limit: int = R.DEFAULT_LATEST, **facets: str
) -> DataFrame:
    """The newest stored articles, as ``reports.latest_articles`` lists them, from few folders.

    Folders of dates are read from the newest on, twice as many each time, until they hold enough
    rows; the day before the oldest of them is read as well, since the days of two time zones
    overlap. Articles without a time come last.
    """
    table = StoredTable(spark, path)
    if not table.is_logged():
        return R.latest_articles(D.filter_articles(read_processed(spark, path), **facets), limit)
    by_date: dict[str, list[str]] = {}
    for folder in table.folders():
        by_date.setdefault(date_of(folder), []).append(folder)
    dated = sorted((d for d in by_date if d[:1].isdigit()), reverse=True)
    dates = dated + [d for d in by_date if d not in set(dated)]

    def rows_of(some: list[str]) -> DataFrame:
        rows = table.read(PROCESSED, [folder for d in some for folder in by_date[d]])
        return D.filter_articles(rows, **facets)

    taken = 1
    while taken < len(dates) and rows_of(dates[:taken]).limit(limit).count() < limit:
        taken *= 2
    taken = min(taken, len(dates))
    if taken and dates[taken - 1][:1].isdigit():
        bound = (date.fromisoformat(dates[taken - 1]) - timedelta(days=1)).isoformat()
        taken = max(taken, sum(d >= bound for d in dated))
    return R.latest_articles(rows_of(dates[:taken]), limit)
