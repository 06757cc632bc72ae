"""Article identity and removal of repeats."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKS_DB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
ARRIVAL_ORDER = ("ingested_at", "category_pos", "feed_pos", "entry_pos")


def article_id(link: Column) -> Column:
    """Content id of a link: MD5 in hexadecimal; a missing link counts as the empty one."""
    return F.md5(F.coalesce(link, F.lit("")))


def _split_linkless(df: DataFrame, linkless: str) -> tuple[DataFrame, DataFrame | None]:
    if linkless == "collapse":
        return df, None
    if linkless == "keep":
        missing = F.coalesce(F.col("link"), F.lit("")) == ""
        return df.where(~missing), df.where(missing)
    raise ValueError(f"linkless must be collapse or keep, not {linkless!r}")


def dedupe_first_wins(
    df: DataFrame,
    order: Sequence[str] = ARRIVAL_ORDER,
    key: str = "id",
    linkless: str = "collapse",
) -> DataFrame:
    """Keep the earliest row per id.

    The rank filter is pushed below the shuffle as a partial group limit, so each task sends at
    most one row per id, however many copies a hot id has. Entries without a link share one id:
    ``collapse`` keeps the first of them, ``keep`` keeps them all.
    """
    linked, rest = _split_linkless(df, linkless)
    earliest = Window.partitionBy(key).orderBy(*order)
    first = (
        linked.withColumn("_rank", F.row_number().over(earliest))
        .where(F.col("_rank") == 1)
        .drop("_rank")
    )
    return first if rest is None else first.unionByName(rest)


class FirstOfId(StatefulProcessor):
    """Passes the earliest row of an id that is not known yet; the state is one flag per id."""

    def __init__(self, order: Sequence[str], keep_ms: int | None) -> None:
        self._order, self._keep_ms = list(order), keep_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._known = handle.getValueState("known", "known boolean", self._keep_ms)

    def handleInitialState(self, key, initialState, timerValues) -> None:  # noqa: N802, N803
        self._known.update((True,))

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:  # noqa: N802, N803
        def place(row: Row) -> list:
            return [(row[c] is not None, row[c]) for c in self._order]

        best = None
        if not self._known.exists():
            best = min(rows, key=place)  # one row is held at a time
        if best is not None or self._keep_ms:
            self._known.update((True,))
        if best is not None:
            yield best

    def close(self) -> None:
        pass


def dedupe_stream(
    df: DataFrame,
    horizon: str | None = None,
    order: Sequence[str] = ARRIVAL_ORDER,
    key: str = "id",
    linkless: str = "collapse",
    known: DataFrame | None = None,
) -> DataFrame:
    """Streaming form of :func:`dedupe_first_wins`: the earliest row of a new id passes.

    An id that passed is known for good, or with ``horizon`` (for queries that run on, not for those
    that stop when all is read) for that much processing time after it was last seen. The rows' own
    times drop nothing, so an article that arrives late passes if its id is new. The state is one
    typed flag per known id, in the RocksDB state store, which this function chooses for the session;
    flags that are older than ``horizon`` expire by themselves. ``known`` is a table with ids that
    have passed before, as a rule those of the stored articles: a new checkpoint begins with them, so
    a lost one does not let everything pass again. It is read once, when the checkpoint is new. The
    copies of a hot id in one micro-batch meet in one task, which holds a single row of them at a
    time; bound the micro-batch at the source.
    """
    linked, rest = _split_linkless(df, linkless)
    keep_ms = int(pd.Timedelta(horizon).total_seconds() * 1000) if horizon else None
    df.sparkSession.conf.set(STATE_STORE, ROCKS_DB)
    before = None
    if known is not None:
        before = known.where(F.col(key).isNotNull()).select(key).distinct().groupBy(key)
    once = linked.groupBy(key).transformWithState(
        FirstOfId(order, keep_ms),
        linked.schema,
        "append",
        "ProcessingTime" if keep_ms else "None",
        before,
    )
    return once if rest is None else once.unionByName(rest)
