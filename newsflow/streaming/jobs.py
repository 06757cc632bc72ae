"""The continuous job: messages in, processed articles out."""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from newsflow.operators.identity import dedupe_stream
from newsflow.operators.tallies import TalliedTable
from newsflow.sources.articles import decode_articles, malformed_messages, read_processed
from newsflow.sources.feeds import attach_category, normalize_articles, read_feeds
from newsflow.sources.stored import StoredTable

SINKS = {"parquet": ("parquet",), "console": ("console",), "both": ("parquet", "console")}
# How often each kind of sink is fed.
PARQUET_TRIGGER = "30 seconds"
CONSOLE_TRIGGER = "10 seconds"


def checkpoint_root(spark: SparkSession, given: str | None = None) -> str:
    """Where stream state is kept: the caller's choice, else the cluster's shared folder."""
    root = given or spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        raise ValueError("no checkpoint folder: set spark.checkpoint.dir or pass one")
    return root.rstrip("/")


def table_checkpoint(root: str, path: str | None) -> str:
    """The one checkpoint of a table, whatever else is fed; without a table that of the console."""
    return f"{root}/{hashlib.md5(path.rstrip('/').encode()).hexdigest() if path else 'console'}"


def run_of(spark: SparkSession, checkpoint: str) -> str:
    """The name of the run that a checkpoint belongs to; made up and kept there at its start.

    Batches are numbered from zero in every new checkpoint, so their folders carry this name.
    """
    kept = f"{checkpoint}/newsflow_run"
    try:
        return spark.read.text(kept).first()["value"]
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
    run = uuid.uuid4().hex
    spark.createDataFrame([(run,)], "value string").coalesce(1).write.text(kept)
    return run


def write_batch(
    df: DataFrame,
    batch_id: int,
    path: str,
    run: str,
    store: type[StoredTable] | type[TalliedTable] = StoredTable,
) -> bool:
    """Store one micro-batch by date of processing; False if it is stored already.

    The batch can be read once all of it is there. A replay of a stored batch writes nothing; one of
    a batch that failed half-way writes it anew. No other run has its folder.
    """
    dated = df.withColumn("date", F.to_date("processed_at"))
    return store(df.sparkSession, path).append(dated, run, batch_id)


def show_batch(df: DataFrame, batch_id: int, rows: int = 20) -> None:
    print(f"batch {batch_id}")
    df.show(rows, truncate=False)


def start_processing(
    messages: DataFrame,
    process: Callable[[DataFrame], DataFrame],
    sink: str = "parquet",
    path: str | None = None,
    checkpoint: str | None = None,
    trigger: dict | None = None,
    malformed: str = "keep",
    console_rows: int = 20,
    quarantine: str | None = None,
    compact_every: int | None = None,
    tallies: bool = False,
) -> StreamingQuery:
    """Decode, process and store a stream of messages.

    ``process`` is the batch function (see ``process_articles``). With two sinks the source is still
    read and scored once per micro-batch: the result is kept while both are written. A table has one
    checkpoint under the checkpoint root, so changing between ``parquet`` and ``both`` goes on where
    the other stopped. The console shows ``console_rows`` rows of a batch. Messages that are no JSON
    object are stored under the path ``quarantine``, if given, in the same way. With
    ``compact_every`` the small folders of the table are merged after every so many batches; with
    ``tallies`` each batch's figures for the dashboard are stored beside it (``operators/tallies.py``).
    """
    if sink not in SINKS:
        raise ValueError(f"unknown sink {sink!r}: choose one of {', '.join(SINKS)}")
    targets, spark = SINKS[sink], messages.sparkSession
    if "parquet" in targets and not path:
        raise ValueError("the parquet sink needs a path")

    table = path if "parquet" in targets else None
    state = table_checkpoint(checkpoint_root(spark, checkpoint), table)
    run = run_of(spark, state) if table or quarantine else ""

    def handle(batch: DataFrame, batch_id: int) -> None:
        if quarantine:
            stamped = malformed_messages(batch).withColumn("processed_at", F.current_timestamp())
            write_batch(stamped, batch_id, quarantine, run)
        articles = process(decode_articles(batch, malformed))
        if len(targets) > 1:
            articles = articles.persist()
        try:
            if "parquet" in targets:
                store = TalliedTable if tallies else StoredTable
                write_batch(articles, batch_id, path, run, store)
                if compact_every and batch_id % compact_every == compact_every - 1:
                    store(spark, path).compact()
            if "console" in targets:
                show_batch(articles, batch_id, console_rows)
        finally:
            if len(targets) > 1:
                articles.unpersist()

    every = PARQUET_TRIGGER if "parquet" in targets else CONSOLE_TRIGGER
    return (
        messages.writeStream.foreachBatch(handle)
        .option("checkpointLocation", state)
        .trigger(**(trigger or {"processingTime": every}))
        .start()
    )


def feed_articles_stream(
    spark: SparkSession,
    path: str,
    registry: DataFrame,
    dialect: str = "any",
    horizon: str | None = None,
    max_files_per_trigger: int | None = None,
    stored: str | None = None,
) -> DataFrame:
    """Landed feed documents as a stream of new articles, each id once (or within ``horizon``).

    Of the copies of an id that land together the first in registry order passes. With ``stored``,
    the path of the processed table, a query with a new checkpoint knows the ids stored there.
    """
    entries = read_feeds(spark, path, dialect, True, max_files_per_trigger)
    placed = attach_category(entries, registry, F.col("feed_key"))
    order = ("ingested_at", "category_pos", "feed_pos", "entry_pos")
    known = read_processed(spark, stored).select("id") if stored else None
    return dedupe_stream(normalize_articles(placed, *order), horizon, known=known).drop(*order)
