"""The given tables in the shape of articles, lexicons and feed documents (batch only)."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from newsflow.functions import keywords as K
from newsflow.functions import phrases as P
from newsflow.functions import sentiment as S
from newsflow.functions import text as X
from newsflow.operators.scratch import written
from newsflow.operators.sizing import spread_if_narrow
from newsflow.sources.feeds import CATEGORIES


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """The columns of a text table, ready for work that is heavy per row."""
    return spread_if_narrow(table(spark, sf_dir, name).select(*columns))


def category_of(position: Column) -> Column:
    return F.get(F.array(*[F.lit(c) for c in CATEGORIES]), position)


def host_of(url: str) -> Column:
    return F.regexp_extract(url, r"^https?://([^/:?#]+)", 1)


def articles_from_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Web pages as raw articles: real markup, script bodies and entities."""
    null = F.lit(None).cast("string")
    return texts(spark, sf_dir, "pages", "page_id", "url", "html").select(
        F.md5("url").alias("id"),
        F.regexp_extract("html", "<title>([^<]*)</title>", 1).alias("title"),
        F.lit("").alias("summary"),
        F.col("html").alias("content"),
        F.col("url").alias("link"),
        F.lit("Unknown").alias("author"),
        null.alias("published"),
        host_of("url").alias("source"),
        category_of((F.col("page_id") % 4).cast("int")).alias("category"),
        null.alias("crawled_at"),
    )


def articles_from_documents(spark: SparkSession, sf_dir: str, *carried: str) -> DataFrame:
    """Documents as raw articles: long texts in four languages, with exact and near copies."""
    null = F.lit(None).cast("string")
    key = F.col("doc_id").cast("string")
    stamp = F.expr("timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 0, 0, doc_id * 977)")
    return (
        texts(spark, sf_dir, "documents", "doc_id", "text", "lang", "source")
        .withColumn("processed_at", stamp)
        .select(
            F.md5(key).alias("id"),
            F.substring("text", 1, 80).alias("title"),
            F.substring("text", 81, 200).alias("summary"),
            F.col("text").alias("content"),
            F.concat(F.lit("doc://"), key).alias("link"),
            F.lit("Unknown").alias("author"),
            null.alias("published"),
            "source",
            F.col("lang").alias("category"),
            null.alias("crawled_at"),
            *carried,
        )
    )


def processed_from_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as processed articles: isolates the reports from text processing."""
    m = F.col("event_id") * 37 % 2001 - 1000
    return table(spark, sf_dir, "events").select(
        F.md5(F.col("event_id").cast("string")).alias("id"),
        F.concat(F.lit("src"), (F.col("user_id") % 20).cast("string")).alias("source"),
        F.col("event_type").alias("category"),
        (m / F.lit(1000.0)).cast("float").alias("sentiment_compound"),
        F.when(m >= 50, "positive").when(m <= -50, "negative").otherwise("neutral").alias(
            "sentiment"
        ),
        F.concat_ws(
            ",", "event_type", F.concat(F.lit("u"), (F.col("user_id") % 50).cast("string"))
        ).alias("keywords"),
        F.length("props").alias("text_length"),
        F.concat_ws(" ", "event_type", F.col("event_id").cast("string")).alias("title_clean"),
        F.col("ts").alias("processed_at"),
    )


# Bytes of text whose distinct runs are held at a time.
HELD = 16 * 1024 * 1024


def distinct_runs(documents: DataFrame, held: int = HELD) -> DataFrame:
    """``run``: the runs without ASCII white space of a column of texts, once per ``held`` bytes."""

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, size = set(), 0
        for batch in batches:
            for text in batch.column(0).cast(pa.binary()):
                words = text.as_py() or b""
                seen.update(words.split())
                size += len(words)
                if size >= held:
                    yield pa.record_batch({"run": pa.array(list(seen), pa.binary())})
                    seen, size = set(), 0
        yield pa.record_batch({"run": pa.array(list(seen), pa.binary())})

    return documents.mapInArrow(runs, "run binary").select(F.col("run").cast("string").alias("run"))


def _corpus_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    # White space parts words, so the words of a text are those of its runs, most of which recur.
    runs = distinct_runs(texts(spark, sf_dir, "documents", "text"))
    return runs.select(F.explode(K.tokenize(F.col("run"))).alias("token")).distinct()


def marks_from_documents(spark: SparkSession, sf_dir: str, context: bool = True) -> DataFrame:
    """Stand-in valences (and degree words and negations) of the corpus's own words.

    No real lexicon would hit the invented words. One pass finds the vocabulary.
    """
    token = F.col("token")
    valence = (
        F.ascii(F.substring(token, 1, 1)) * 7
        + F.ascii(F.substring(token, 2, 1)) * 3
        + F.length(token)
    ) % 9 - 4
    sign = F.when(F.ascii(token) % 2 == 0, 0.293).otherwise(-0.293)
    marked = _corpus_words(spark, sf_dir).select(
        "token",
        F.when((F.length(token) % 3 == 0) & (valence != 0), valence.cast("double")).alias(
            "valence"
        ),
        F.when(F.lit(context) & (F.length(token) % 5 == 4), sign).alias("delta"),
        F.when(F.lit(context) & (F.length(token) % 7 == 4), True).alias("negates"),
    )
    return marked.dropna(how="all", subset=["valence", "delta", "negates"])


def _run_counts(listed: DataFrame, n: int, words: list[str] | None) -> DataFrame:
    """``(n, phrase, count)`` of the runs of ``n`` words, or of those of the given words alone."""
    starts = f"sequence(1, size(words) - {n - 1})"
    if words is not None:
        quoted = [w.replace("\\", "\\\\").replace("'", "\\'") for w in words]
        known = "false" if not quoted else "w in ('" + "', '".join(quoted) + "')"
        listed = listed.select("words", F.expr(f"transform(words, w -> {known})").alias("known"))
        starts = f"filter({starts}, k -> {' and '.join(f'get(known, k - 1 + {i})' for i in range(n))})"
    runs = f"""if(size(words) < {n}, array(), transform({starts},
        k -> named_struct('n', {n}, 'phrase', array_join(slice(words, k, {n}), ' '))))"""
    return listed.select(F.inline(F.expr(runs))).groupBy("n", "phrase").count()


# Words whose runs give a first bound, and words that a row is searched for at most.
BOUND_WORDS, MAX_WORDS = 300, 20_000


def _common_runs(listed: DataFrame, single: DataFrame, n: int, top: int) -> DataFrame:
    """Counts of runs of ``n`` words, among them the ``top`` commonest and all as common as those.

    A run is no commoner than its words. So the runs of the commonest words bound the count of the
    last run wanted from below, and only words of that count can be in the others. If those are too
    many, all runs are counted.
    """
    ordered = single.orderBy(F.desc("count"), "phrase").limit(BOUND_WORDS)
    first = written(_run_counts(listed, n, [r["phrase"] for r in ordered.collect()]), "runs")
    best = [r["count"] for r in first.orderBy(F.desc("count")).limit(top).collect()]
    bound = best[-1] if len(best) == top else 1
    needed = single.where(F.col("count") >= bound).limit(MAX_WORDS + 1).collect()
    if len(needed) <= BOUND_WORDS:
        return first
    return _run_counts(listed, n, None if len(needed) > MAX_WORDS else [r["phrase"] for r in needed])


# How many phrases of one, two and three words stand in.
PHRASES_OF = {1: 6, 2: 40, 3: 30}


def phrases_from_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stand-in phrases: the commonest runs of one to three words, with a kind and value by rank."""
    words = F.transform(S.split_tokens(X.clean(F.col("text"))), F.lower)
    listed = written(texts(spark, sf_dir, "documents", "text").select(words.alias("words")), "words")
    each = listed.select(F.explode("words").alias("phrase")).groupBy("phrase").count()
    single = written(each.select(F.lit(1).alias("n"), "phrase", "count"), "words")
    longer = [_common_runs(listed, single, n, top) for n, top in PHRASES_OF.items() if n > 1]
    counts = reduce(DataFrame.union, longer, single)
    rank = F.row_number().over(Window.partitionBy("n").orderBy(F.desc("count"), "phrase"))
    wanted = F.get(F.array(F.lit(0), *map(F.lit, PHRASES_OF.values())), F.col("n"))
    ranked = counts.withColumn("rank", rank).where(F.col("rank") <= 40).where(F.col("rank") <= wanted)
    one = F.get(F.array(F.lit("flip"), F.lit("mute")), F.col("rank") % 2)
    more = F.get(F.array(*map(F.lit, P.KINDS)), F.col("rank") % len(P.KINDS))
    return ranked.select(
        "phrase",
        F.when(F.col("n") == 1, one).otherwise(more).alias("kind"),
        ((F.col("rank") * 7 % 11 - 5) / 2.0).cast("double").alias("value"),
    )


def lexicon_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The corpus's words as lines of a lexicon file, some of them wrong: ``line``."""
    token = F.col("token")
    ratings = F.transform(
        F.sequence(F.lit(1), F.lit(10)), lambda k: (F.ascii(token) * k + F.length(token)) % 9 - 4
    )
    mean = F.format_number(F.aggregate(ratings, F.lit(0), lambda a, x: a + x) / 10.0, 1)
    kind = (F.ascii(F.substring(token, 2, 1)) + F.length(token)) % 8
    line = F.concat_ws("\t", token, F.when(kind == 3, "9.9").otherwise(mean), F.lit("0.5"),
                       F.concat(F.lit("["), F.array_join(ratings, ", "), F.lit("]")))
    cut = F.when(kind == 1, F.concat_ws("\t", token)).when(kind == 2, F.concat_ws("\t", token, F.lit("high")))
    return _corpus_words(spark, sf_dir).select(F.coalesce(cut, line).alias("line"))


def arrivals_from_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as feed entries arriving over time; many share a link, some have none."""
    key = (F.col("event_id") * 7919) % 1500
    link = F.when(F.col("event_id") % 3 == 0, "").otherwise(
        F.concat(F.lit("https://news.example/"), key.cast("string"))
    )
    return table(spark, sf_dir, "events").select(
        F.md5(link).alias("id"),
        link.alias("link"),
        F.col("event_type").alias("title"),
        F.col("ts").alias("ingested_at"),
        (F.col("user_id") % 4).cast("int").alias("category_pos"),
        (F.col("user_id") % 7).cast("int").alias("feed_pos"),
        F.col("event_id").cast("int").alias("entry_pos"),
    )


def _xml(text: Column) -> Column:
    """Escape a text for an XML document, dropping characters XML cannot hold."""
    safe = F.regexp_replace(text, r"[\x00-\x08\x0b\x0c\x0e-\x1f\x{fffe}\x{ffff}]", "")
    for raw, escaped in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        safe = F.replace(safe, F.lit(raw), F.lit(escaped))
    return safe


def feed_documents_from_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each turn as one RSS channel of two entries, as XML text; nothing is grouped."""
    link = F.concat_ws("/", F.lit("https://talk.example"), "conv_id", "turn")

    def entry(suffix: str, body: Column) -> Column:
        return F.concat(
            F.lit("<item><title>"), F.col("role"), F.lit(f"{suffix}</title><link>"), link,
            F.lit(f"/{suffix}</link><description>"), body, F.lit("</description></item>"),
        )

    document = F.concat(
        F.lit("<channel><title>conversation "),
        F.col("conv_id").cast("string"),
        F.lit("</title>"),
        entry("head", _xml(F.substring("text", 1, 40))),
        entry("text", _xml(F.col("text"))),
        F.lit("</channel>"),
    )
    turns = texts(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text")
    return turns.select("conv_id", "turn", document.alias("xml"))


def atom_documents_from_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each turn as one Atom feed of one entry, its text as escaped content."""
    link = F.concat_ws("/", F.lit("https://talk.example"), "conv_id", "turn")
    document = F.concat(
        F.lit("<feed><title>conversation "), F.col("conv_id").cast("string"),
        F.lit('</title><entry><title>'), F.col("role"),
        F.lit('</title><link rel="self" href="x"/><link href="'), link,
        F.lit('"/><content type="html">'), _xml(F.col("text")), F.lit("</content></entry></feed>"),
    )
    turns = texts(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text")
    return turns.select("conv_id", "turn", document.alias("xml"))


def feed_documents_from_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each page as one RSS channel of one entry, its markup as escaped content."""
    document = F.concat(
        F.lit("<channel><title>"), _xml(host_of("url")), F.lit("</title><item><title>"),
        _xml(F.regexp_extract("html", "<title>([^<]*)</title>", 1)),
        F.lit('</title><guid isPermaLink="true">'), _xml(F.col("url")),
        F.lit("</guid><content:encoded>"), _xml(F.col("html")),
        F.lit("</content:encoded></item></channel>"),
    )
    pages = texts(spark, sf_dir, "pages", "page_id", "url", "html")
    return pages.select("page_id", document.alias("xml"))
