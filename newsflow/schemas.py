"""Schemas of the article entity and of the reference tables around it."""

from __future__ import annotations

from pyspark.sql import types as T

# Field names and order of the article message and the stored article.
RAW_FIELDS = "id title summary content link author published source category crawled_at".split()
CARRIED_FIELDS = "id link author published source category crawled_at".split()

RAW = T.StructType([T.StructField(name, T.StringType()) for name in RAW_FIELDS])

PROCESSED = T.StructType(
    [T.StructField(name, T.StringType()) for name in CARRIED_FIELDS]
    + [
        T.StructField("title_clean", T.StringType()),
        T.StructField("full_text", T.StringType()),
        T.StructField("keywords", T.StringType()),
        T.StructField("text_length", T.IntegerType()),
        T.StructField("sentiment", T.StringType()),
        T.StructField("sentiment_compound", T.FloatType()),
        T.StructField("sentiment_pos", T.FloatType()),
        T.StructField("sentiment_neg", T.FloatType()),
        T.StructField("sentiment_neu", T.FloatType()),
        T.StructField("processed_at", T.TimestampType()),
    ]
)

REGISTRY = T.StructType(
    [
        T.StructField("feed_url", T.StringType()),
        T.StructField("category", T.StringType()),
        T.StructField("category_pos", T.IntegerType()),
        T.StructField("feed_pos", T.IntegerType()),
    ]
)

LEXICON = T.StructType(
    [T.StructField("token", T.StringType()), T.StructField("valence", T.DoubleType())]
)
BOOSTERS = T.StructType(
    [T.StructField("token", T.StringType()), T.StructField("delta", T.DoubleType())]
)
NEGATIONS = T.StructType([T.StructField("token", T.StringType())])
PHRASES = T.StructType(
    [
        T.StructField("phrase", T.StringType()),
        T.StructField("kind", T.StringType()),
        T.StructField("value", T.DoubleType()),
    ]
)
