"""Article messages (JSON, on a topic or in files) and the processed-article table."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from newsflow.schemas import PROCESSED, RAW, RAW_FIELDS
from newsflow.sources.stored import StoredTable


def kafka_source_options(
    servers: str,
    topic: str,
    starting_offsets: str = "earliest",
    fail_on_data_loss: bool = False,
    max_offsets_per_trigger: int | None = None,
) -> dict[str, str]:
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting_offsets,
        "failOnDataLoss": str(fail_on_data_loss).lower(),
    }
    if max_offsets_per_trigger:
        options["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    return options


def kafka_sink_options(servers: str, topic: str) -> dict[str, str]:
    """Wait for all replicas and retry, as a publisher that must not lose articles does."""
    return {
        "kafka.bootstrap.servers": servers,
        "topic": topic,
        "kafka.acks": "all",
        "kafka.retries": "3",
    }


def read_kafka_stream(spark: SparkSession, servers: str, topic: str, **settings) -> DataFrame:
    """Message values of one topic as a stream of one column, ``value``.

    Needs the Kafka connector that belongs to the running Spark build on the class path.
    """
    options = kafka_source_options(servers, topic, **settings)
    return spark.readStream.format("kafka").options(**options).load().select("value")


def encode_articles(df: DataFrame) -> DataFrame:
    """One JSON message per article, in the column ``value``; absent fields are left out."""
    return df.select(F.to_json(F.struct(*RAW_FIELDS)).alias("value"))


def _decoded(value: Column) -> Column:
    return F.from_json(value.cast("string"), RAW)


def decode_articles(messages: DataFrame, malformed: str = "keep") -> DataFrame:
    """Articles from JSON messages.

    A message that is no JSON object becomes a row of NULLs; ``malformed='drop'`` leaves such rows
    out (see also :func:`malformed_messages`).
    """
    if malformed not in ("keep", "drop"):
        raise ValueError(f"malformed must be keep or drop, not {malformed!r}")
    rows = messages.select(_decoded(F.col("value")).alias("article")).select("article.*")
    return rows.dropna(how="all") if malformed == "drop" else rows


def malformed_messages(messages: DataFrame) -> DataFrame:
    """Messages that yield no field at all, for a side table."""
    article = F.col("_article")
    empty = F.coalesce(*(article[name] for name in RAW_FIELDS)).isNull()
    return messages.withColumn("_article", _decoded(F.col("value"))).where(empty).drop("_article")


def publish_articles(df: DataFrame, fmt: str, options: dict[str, str]) -> int:
    """Write articles as messages and return how many were written.

    The write either succeeds as a whole (failed tasks are retried) or raises.
    """
    written = Observation("published")
    messages = encode_articles(df).observe(written, F.count(F.lit(1)).alias("articles"))
    messages.write.format(fmt).options(**options).mode("append").save()
    return written.get["articles"]


def publish_stream(df: DataFrame, checkpoint: str, fmt: str, options: dict[str, str]):
    """Stream articles out as messages; offsets are kept in ``checkpoint``."""
    writer = encode_articles(df).writeStream.format(fmt).options(**options)
    return writer.option("checkpointLocation", checkpoint).outputMode("append")


def read_processed(
    spark: SparkSession, path: str, since: str | None = None, until: str | None = None
) -> DataFrame:
    """The processed table; a path that does not exist yet reads as empty, other errors raise.

    A table with a log (see ``sources/stored.py``) is read as of its last whole batch; writes that go
    on or have failed are not seen. Any other folder of Parquet files is read as it is. With
    ``since`` or ``until`` (dates, both included) only the folders of those dates are read.
    """
    table = StoredTable(spark, path)
    if table.is_logged():
        return table.read(PROCESSED, table.folders(since, until))
    try:
        df = spark.read.schema(PROCESSED).option("recursiveFileLookup", "false").parquet(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return spark.createDataFrame([], PROCESSED)
        raise
    for bound, date in ((">=", since), ("<=", until)):
        if date:
            df = df.where(f"date {bound} date'{date}'")
    return df.select(*PROCESSED.fieldNames())
