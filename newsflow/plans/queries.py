"""One query per operator, over whole tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from newsflow.functions import keywords as K
from newsflow.functions import sentiment as S
from newsflow.functions import text as X
from newsflow.functions.entities import html_unescape
from newsflow.operators import dashboard as D
from newsflow.operators import reports as R
from newsflow.operators import tallies as TL
from newsflow.operators.enrich import enrich_text, process_articles
from newsflow.operators.identity import article_id, dedupe_first_wins
from newsflow.operators.sentiment import score_with_marks
from newsflow.operators.stopwords import (
    add_keywords,
    drop_stop_rows,
    frequent_words,
    prepare_stop_words,
)
from newsflow.plans import adapters as A
from newsflow.sources.articles import decode_articles, encode_articles, malformed_messages
from newsflow.sources.feeds import (
    ATOM_SCHEMA,
    RSS_SCHEMA,
    atom_entries,
    attach_category,
    flatten_registry,
    normalize_articles,
    rss_entries,
)
from newsflow.sources.lexicons import parse_lexicon

Query = Callable[[SparkSession, str], DataFrame]
# Words in so many of 100 documents are stop words of the corpus.
STOP_PERCENT = 20
# Filter choices used where a view is shown over a selection.
CATEGORY, SENTIMENT = "click", "positive"


def _rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c).cast("double"), 6) for c in columns})


# Text, one step at a time


def _on_pages(step: Callable[[Column], Column]) -> Query:
    return lambda spark, sf: A.texts(spark, sf, "pages", "page_id", "html").select(
        "page_id", step(F.col("html")).alias("text")
    )


def _on_documents(step: Callable[[Column], Column]) -> Query:
    return lambda spark, sf: A.texts(spark, sf, "documents", "doc_id", "text").select(
        "doc_id", step(F.col("text")).alias("text")
    )


def _enriched(spark: SparkSession, sf: str) -> DataFrame:
    return enrich_text(A.articles_from_documents(spark, sf, "doc_id", "processed_at"))


def full_text(spark, sf):
    return _enriched(spark, sf).select("doc_id", "title_clean", "full_text")


def text_length(spark, sf):
    return _enriched(spark, sf).select("doc_id", "text_length")


def article_text_pages(spark, sf):
    return enrich_text(A.articles_from_pages(spark, sf)).select(
        "id", "title_clean", "full_text", "keywords", "text_length"
    )


# Keywords


# The array goes straight into the generator: behind a column name the optimizer would add a filter
# on its size and so evaluate it twice.


def _documents(spark, sf, *columns: Column) -> DataFrame:
    return A.texts(spark, sf, "documents", "doc_id", "text").select("doc_id", *columns)


def _words() -> Column:
    return K.drop_stop_words(K.tokenize(F.col("text")))


def tokenize(spark, sf):
    return _documents(spark, sf, F.posexplode(K.tokenize(F.col("text"))).alias("pos", "word"))


def stopword_filter(spark, sf):
    return _documents(spark, sf, F.posexplode(_words()).alias("pos", "word"))


def term_frequency(spark, sf):
    return _documents(spark, sf, F.inline(K.term_frequency(_words())))


def top_terms_per_article(spark, sf):
    terms = _documents(spark, sf, F.posexplode(K.top_terms(_words())).alias("pos", "word"))
    return terms.select("doc_id", (F.col("pos") + 1).alias("rank"), "word")


def article_keywords(spark, sf):
    return _enriched(spark, sf).select("doc_id", "keywords")


def corpus_stop_words(spark, sf):
    """Words of at least a fifth of the documents, and in how many they stand."""
    return frequent_words(A.texts(spark, sf, "documents", "doc_id", "text"), STOP_PERCENT)


def _stop_table(spark, sf):
    """The fixed stop words and those of the corpus, as a caller's table."""
    fixed = spark.createDataFrame([(w,) for w in K.STOP_WORDS], "word string")
    return prepare_stop_words(fixed.union(corpus_stop_words(spark, sf).select("word")))


def _stop_table_tokens(lookup: str) -> Query:
    return lambda spark, sf: drop_stop_rows(
        tokenize(spark, sf), _stop_table(spark, sf), "doc_id", lookup
    )


def _stop_table_keywords(lookup: str) -> Query:
    return lambda spark, sf: add_keywords(
        _documents(spark, sf, F.col("text")), _stop_table(spark, sf), "text", lookup=lookup
    ).select("doc_id", "keywords")


# Sentiment


def _scored(
    spark, sf, lookup: str = "auto", context: bool = False, phrases: bool = False
) -> DataFrame:
    documents = A.texts(spark, sf, "documents", "doc_id", "text").select(
        "doc_id", X.clean(F.col("text")).alias("full_text")
    )
    return score_with_marks(
        documents,
        A.marks_from_documents(spark, sf, context),
        rules=S.Rules(context=context),
        lookup=lookup,
        phrases=A.phrases_from_documents(spark, sf) if phrases else None,
    )


def blank_articles(spark, sf):
    """Articles of white space alone, as long as the documents: neutral without a look-up."""
    blank = X.blanked(F.col("text")).alias("full_text")
    documents = A.texts(spark, sf, "documents", "doc_id", "text").select("doc_id", blank)
    scored = score_with_marks(documents, A.marks_from_documents(spark, sf))
    return _rounded(scored.drop("full_text"), *SCORES)


SCORES = ("sentiment_compound", "sentiment_pos", "sentiment_neg", "sentiment_neu")


def _scores(spark, sf, **options) -> DataFrame:
    return _rounded(_scored(spark, sf, **options).drop("full_text"), *SCORES)


def lexicon_sentiment(spark, sf):
    return _scores(spark, sf)


def lexicon_sentiment_joined(spark, sf):
    return _scores(spark, sf, lookup="join")


def context_sentiment(spark, sf):
    return _scores(spark, sf, context=True)


def phrase_sentiment(spark, sf):
    return _scores(spark, sf, context=True, phrases=True)


def phrase_sentiment_joined(spark, sf):
    return _scores(spark, sf, context=True, phrases=True, lookup="join")


def lexicon_file(spark, sf):
    """Entries of a lexicon file over the corpus's words."""
    good, _ = parse_lexicon(A.lexicon_lines(spark, sf))
    return good.select("token", "valence", "deviation", F.array_join("ratings", " ").alias("ratings"))


def lexicon_file_rejects(spark, sf):
    """Lines of the same file that are set aside, and why."""
    return parse_lexicon(A.lexicon_lines(spark, sf))[1].select("line", "reason")


def classify_sentiment(spark, sf):
    compound = (F.col("event_id") * 37 % 2001 - 1000) / F.lit(1000.0)
    return A.table(spark, sf, "events").select(
        "event_id", S.classify(compound).alias("sentiment")
    )


def _processed(spark, sf) -> DataFrame:
    return process_articles(
        A.articles_from_documents(spark, sf, "processed_at"),
        A.marks_from_documents(spark, sf),
        processed_at=F.col("processed_at"),
    )


def process_article(spark, sf):
    return _rounded(_processed(spark, sf), *SCORES)


def category_sentiment_documents(spark, sf):
    return _rounded(R.CATEGORY_SENTIMENT.over(_processed(spark, sf)), "avg_score")


def top_keywords_documents(spark, sf):
    return R.top_keywords(_enriched(spark, sf))


# Feeds, messages and identity


def _registry(spark, sf) -> DataFrame:
    settings = A.table(spark, sf, "pages").select(
        A.category_of((F.col("page_id") % 4).cast("int")).alias("category"),
        (F.col("page_id") % 4).cast("int").alias("category_pos"),
        F.concat(F.lit(" "), "url", F.lit(" , "), "url", F.lit("&feed=2, ,")).alias("feeds"),
    )
    return flatten_registry(settings)


def feed_registry(spark, sf):
    return _registry(spark, sf)


def feed_registry_join(spark, sf):
    pages = A.table(spark, sf, "pages").select("page_id", F.col("url").alias("feed_url"))
    return attach_category(pages, _registry(spark, sf))


def _parsed(documents: DataFrame, schema: str, *keys: str) -> DataFrame:
    parsed = F.from_xml("xml", schema, {"columnNameOfCorruptRecord": "_corrupt_record"})
    return documents.select(*keys, parsed.alias("c")).select(*keys, "c.*")


def feed_extract_pages(spark, sf):
    documents = A.feed_documents_from_pages(spark, sf)
    entries = rss_entries(_parsed(documents, RSS_SCHEMA, "page_id"), "page_id")
    return entries.select("page_id", "entry_pos", "title", "link", "content", "source")


def feed_extract_rss(spark, sf):
    documents = A.feed_documents_from_conversations(spark, sf)
    entries = rss_entries(_parsed(documents, RSS_SCHEMA, "conv_id", "turn"), "conv_id", "turn")
    return entries.select("conv_id", "turn", "entry_pos", "title", "link", "source", "summary")


def feed_extract_atom(spark, sf):
    documents = A.atom_documents_from_conversations(spark, sf)
    entries = atom_entries(_parsed(documents, ATOM_SCHEMA, "conv_id", "turn"), "conv_id", "turn")
    return entries.select("conv_id", "turn", "entry_pos", "title", "link", "source", "content")


def normalize(spark, sf):
    entries = A.table(spark, sf, "events").select(
        F.when(F.col("event_id") % 5 != 0, F.col("event_type")).alias("title"),
        F.col("props").alias("summary"),
        F.lit(None).cast("string").alias("content"),
        F.when(
            F.col("event_id") % 7 != 0, F.concat(F.lit("https://e.example/"), "event_id")
        ).alias("link"),
        F.when(F.col("event_id") % 2 == 0, F.concat(F.lit("user "), "user_id")).alias("author"),
        F.when(F.col("event_id") % 3 == 0, "Mon, 01 Jan 2024").alias("published"),
        F.when(F.col("event_id") % 4 != 0, "wire").alias("source"),
        F.col("event_type").alias("category"),
        F.col("ts").alias("ingested_at"),
        "event_id",
    )
    return normalize_articles(entries, "event_id")


def encode_article_json(spark, sf):
    return encode_articles(A.articles_from_documents(spark, sf))


def decode_article_json(spark, sf):
    return decode_articles(encode_articles(A.articles_from_documents(spark, sf)))


def malformed(spark, sf):
    """Messages of which every seventh is cut short: those that yield no field."""
    messages = A.texts(spark, sf, "documents", "doc_id", "text").select(
        F.when(F.col("doc_id") % 7 == 0, F.concat(F.lit('{"title'), F.col("doc_id")))
        .otherwise(F.to_json(F.struct(F.col("text").alias("content"))))
        .alias("value")
    )
    return malformed_messages(messages)


def article_ids(spark, sf):
    return A.table(spark, sf, "pages").select("url", article_id(F.col("url")).alias("id"))


def dedupe(spark, sf):
    return dedupe_first_wins(A.arrivals_from_events(spark, sf))


# Reports and dashboard views over processed articles


def _over_events(view: Callable[[DataFrame], DataFrame], *rounded: str) -> Query:
    return lambda spark, sf: _rounded(view(A.processed_from_events(spark, sf)), *rounded)


def _chosen(df: DataFrame) -> DataFrame:
    return D.filter_articles(df, category=CATEGORY, sentiment=SENTIMENT)


def _facet(column: str) -> Query:
    return _over_events(lambda df: D.facet_values(df, column))


def all_reports(df: DataFrame) -> DataFrame:
    """All reports of one run as one table: report, key, measure, value."""
    results = R.run_reports(df)
    if not results:
        schema = "report string, key string, measure string, value double"
        return df.sparkSession.createDataFrame([], schema)
    shown = [(name, r.keys, [m for m, _ in r.measures]) for name, r in R.TALLIED.items()]
    shown.append(("top_keywords", ("keyword",), ["count"]))
    parts = []
    for name, keys, measures in shown:
        listed = [
            F.struct(F.lit(m).alias("measure"), F.col(m).cast("double").alias("value"))
            for m in measures
        ]
        key = F.concat_ws("/", *(F.coalesce(F.col(k).cast("string"), F.lit("-")) for k in keys))
        rows = results[name].select(key.alias("key"), F.inline(F.array(*listed)))
        parts.append(rows.select(F.lit(name).alias("report"), "key", "measure", "value"))
    return reduce(DataFrame.unionByName, parts)


def _tallied(kind: str, view: Callable[[DataFrame], DataFrame]) -> Callable[[DataFrame], DataFrame]:
    """A figure from the tallies of four batches of the articles, added up."""

    def rolled_up(df: DataFrame) -> DataFrame:
        batch = F.pmod(F.crc32(F.col("id").cast("binary")), F.lit(4))
        parts = [TL.TALLIES[kind](df.where(batch == k)) for k in range(4)]
        return view(TL.combine(kind, reduce(DataFrame.unionByName, parts)))

    return rolled_up


KPIS = ("avg_sentiment", "positive_pct", "avg_length")

QUERIES: dict[str, Query] = {
    "html_unescape": _on_pages(html_unescape),
    "strip_tags": _on_pages(X.strip_tags),
    "strip_urls": _on_pages(X.strip_urls),
    "collapse_whitespace": _on_pages(X.collapse_whitespace),
    "strip_special_chars": _on_documents(X.strip_special_chars),
    "clean_text_pages": _on_pages(X.clean),
    "clean_text_documents": _on_documents(X.clean),
    "full_text": full_text,
    "text_length": text_length,
    "article_text_pages": article_text_pages,
    "tokenize": tokenize,
    "stopword_filter": stopword_filter,
    "term_frequency": term_frequency,
    "top_terms_per_article": top_terms_per_article,
    "article_keywords": article_keywords,
    "corpus_stop_words": corpus_stop_words,
    "stop_table_tokens": _stop_table_tokens("row"),
    "stop_table_tokens_joined": _stop_table_tokens("join"),
    "stop_table_keywords": _stop_table_keywords("row"),
    "stop_table_keywords_joined": _stop_table_keywords("join"),
    "lexicon_sentiment": lexicon_sentiment,
    "lexicon_sentiment_joined": lexicon_sentiment_joined,
    "context_sentiment": context_sentiment,
    "phrase_sentiment": phrase_sentiment,
    "phrase_sentiment_joined": phrase_sentiment_joined,
    "lexicon_file": lexicon_file,
    "lexicon_file_rejects": lexicon_file_rejects,
    "blank_articles": blank_articles,
    "classify_sentiment": classify_sentiment,
    "process_article": process_article,
    "category_sentiment_documents": category_sentiment_documents,
    "top_keywords_documents": top_keywords_documents,
    "feed_registry": feed_registry,
    "feed_registry_join": feed_registry_join,
    "feed_extract_pages": feed_extract_pages,
    "feed_extract_rss": feed_extract_rss,
    "feed_extract_atom": feed_extract_atom,
    "normalize_articles": normalize,
    "encode_article_json": encode_article_json,
    "decode_article_json": decode_article_json,
    "malformed_messages": malformed,
    "article_id": article_ids,
    "dedupe_first_wins": dedupe,
    "sentiment_distribution": _over_events(R.SENTIMENT_DISTRIBUTION.over),
    "category_sentiment": _over_events(R.CATEGORY_SENTIMENT.over, "avg_score"),
    "top_keywords": _over_events(R.top_keywords),
    "source_analysis": _over_events(R.SOURCE_ANALYSIS.over, "avg_sentiment", "avg_length"),
    "hourly_activity": _over_events(R.HOURLY_ACTIVITY.over),
    "sentiment_by_category_pivot": _over_events(R.SENTIMENT_PIVOT.over),
    "run_reports": _over_events(all_reports, "value"),
    "latest_articles": _over_events(R.latest_articles, "sentiment_compound"),
    "filter_articles": _over_events(_chosen, "sentiment_compound"),
    "facet_category": _facet("category"),
    "facet_source": _facet("source"),
    "facet_sentiment": _facet("sentiment"),
    "time_parts": _over_events(
        lambda df: D.with_time_parts(df).select("id", "processed_at", "date", "hour")
    ),
    "kpis": _over_events(D.kpis, *KPIS),
    "filtered_kpis": _over_events(lambda df: D.kpis(_chosen(df)), *KPIS),
    "filtered_sentiment_counts": _over_events(
        lambda df: D.SENTIMENT_COUNTS.over(D.filter_articles(df, category=CATEGORY))
    ),
    "category_counts": _over_events(D.CATEGORY_COUNTS.over),
    "category_sentiment_counts": _over_events(D.CATEGORY_SENTIMENT_COUNTS.over),
    "articles_over_time": _over_events(D.articles_over_time),
    "dashboard_keywords": _over_events(D.top_keywords),
    "dashboard_source_stats": _over_events(
        D.SOURCE_STATS.over, "sentiment_compound", "text_length"
    ),
    "tallied_kpis": _over_events(_tallied("facets", lambda t: D.tallied_kpis(_chosen(t))), *KPIS),
    "tallied_keywords": _over_events(_tallied("keywords", lambda t: TL.top_keywords(_chosen(t)))),
    "tallied_source_stats": _over_events(
        _tallied("facets", D.SOURCE_STATS.roll_up), "sentiment_compound", "text_length"
    ),
    "filtered_latest": _over_events(
        lambda df: R.latest_articles(_chosen(df)), "sentiment_compound"
    ),
}
