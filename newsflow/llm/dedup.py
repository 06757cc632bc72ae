"""Exact copies of texts, with frequent texts split off by a heavy-hitter sketch.

Texts are equal when they are identical after every run of ASCII white space became one space. The
work is done on SHA-256 digests of the normalised texts: a Misra-Gries sketch (the frequent-items
sketch behind ``approx_top_k``) names the digests that may be frequent, one exact pass verifies
their counts and winners, and these few rows are broadcast, so that rows of frequent texts are
settled where they are. The rest, whose groups are small by the sketch's guarantee, are shuffled.
Built-in functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from newsflow.operators.scratch import written

BLANKS = r"[\x20\x09-\x0D]+"
# Items a sketch holds, the most digests it may name, and the groups in which sketches are merged.
TRACKED, NAMED, MERGERS = 4096, 1000, 64


def digest(text: Column) -> Column:
    """SHA-256 in hex of a text normalised for comparison; NULL counts as empty."""
    plain = F.coalesce(text.cast("string"), F.lit(""))
    return F.sha2(F.regexp_replace(plain, BLANKS, " ").cast("binary"), 256)


def frequent_digests(prints: DataFrame, tracked: int = TRACKED, named: int = NAMED) -> DataFrame:
    """Column ``digest``: at most ``named`` digests, among them all that are frequent.

    A sketch per task, merged in two levels. Of the digests that hold more than a share of
    ``1 / (0.75 * tracked)`` of the rows, none is missing unless ``named`` others are as frequent.
    """
    sketch = F.expr(f"approx_top_k_accumulate(digest, {tracked})").alias("sketch")
    merged = F.expr(f"approx_top_k_combine(sketch, {tracked})").alias("sketch")
    top = F.expr(f"approx_top_k_estimate(sketch, {named})")
    merger = (F.spark_partition_id() % MERGERS).alias("merger")
    sketches = prints.groupBy(merger).agg(sketch)
    one = sketches.groupBy(F.lit("all")).agg(merged)  # no row for an empty table
    return one.select(F.explode(top).alias("top")).select(F.col("top.item").alias("digest"))


def _winner(rows: DataFrame, *over) -> list[Column]:
    """The first row by id (NULL last; repeated rows by row number) and the number of rows."""
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row"))
    size = F.count(F.lit(1))
    if over:
        first, size = first.over(over[0]), size.over(over[0])
    return [first.alias("first"), size.alias("group_size")]


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    ``keep_id`` is the smallest id of the texts equal to the row's, ``kept`` marks its row. Of rows
    repeated with one id, exactly one is kept; a NULL id ranks after all others; NULL and empty
    texts, and texts of white space alone after its reduction, are compared like any other. An
    empty table gives an empty table. Other columns of ``docs`` are not looked at.
    """
    prints = written(
        docs.select(
            F.col(id_col).alias("doc_id"),
            digest(F.col(text_col)).alias("digest"),
            F.monotonically_increasing_id().alias("row"),
        ),
        "digests",
    )
    # At most NAMED rows of fixed width: safe to broadcast at any size of the table.
    suspects = F.broadcast(frequent_digests(prints))
    counted = prints.join(suspects, "digest").groupBy("digest").agg(*_winner(prints))
    winners = F.broadcast(written(counted, "winners"))

    same = Window.partitionBy("digest")
    frequent = prints.join(winners, "digest")
    others = prints.join(winners.select("digest"), "digest", "left_anti")
    others = others.select("*", *_winner(prints, same))
    return frequent.unionByName(others).select(
        "doc_id",
        F.col("first.doc_id").alias("keep_id"),
        "group_size",
        (F.col("row") == F.col("first.row")).alias("kept"),
        F.col("digest").alias("text_sha256"),
    )


def drop_exact_copies(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The rows of ``docs``, all columns, that :func:`exact_groups` keeps.

    Only ids and digests of the dropped rows are joined back, not the texts among themselves. Of
    rows repeated with id and text, one is taken by an aggregation with partial results.
    """
    groups = written(exact_groups(docs, id_col, text_col), "groups")
    again = F.col("doc_id").eqNullSafe(F.col("keep_id"))
    copies = groups.where(~F.col("kept") & ~again)
    repeated = groups.where(~F.col("kept") & again).distinct()

    keyed = docs.select(
        F.struct("*").alias("whole"),
        F.col(id_col).alias("key_id"),
        digest(F.col(text_col)).alias("key_digest"),
    )
    same_row = F.col("key_id").eqNullSafe(F.col("doc_id")) & (
        F.col("key_digest") == F.col("text_sha256")
    )
    kept = keyed.join(copies, same_row, "left_anti")
    if repeated.isEmpty():
        return kept.select("whole.*")
    once = kept.join(repeated, same_row, "left_semi")
    once = once.groupBy("key_id", "key_digest").agg(F.first("whole").alias("whole"))
    rest = kept.join(repeated, same_row, "left_anti")
    return rest.select("whole.*").unionByName(once.select("whole.*"))
