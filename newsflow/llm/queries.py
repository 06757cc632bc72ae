"""One query per operator, over whole tables, and the same queries as DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsflow.llm import (
    collocations,
    dedup,
    html_extract,
    language,
    licenses,
    mixing,
    pieces,
    quality,
    simhash,
    substrings,
    token_files,
    topk,
    whitening,
)
from newsflow.operators.scratch import scratch_path

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_html_extraction(spark, sf_dir):
    """Main text of every page."""
    return html_extract.extract_pages(_table(spark, sf_dir, "pages"))


def op2_quality_classifier(spark, sf_dir):
    """Weak label, score and decision of every document."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality.score(docs, quality.learn(docs)).drop("whole")


def op3_topk_search(spark, sf_dir):
    """The five highest inner products of every 50th vector with all others."""
    vectors = _table(spark, sf_dir, "embeddings")
    return topk.top_k(vectors, F.col("vec_id") % 50 == 0, k=5)


def op4_simhash_components(spark, sf_dir):
    """Fingerprint and component of every document."""
    return simhash.near_groups(_table(spark, sf_dir, "documents"))


def op5_license_scan(spark, sf_dir):
    """Licences of every document and the sentences that show them, in order."""
    found = licenses.scan(_table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        F.array_join("licenses", ",").alias("licenses"),
        F.array_join("sentence_ids", ",").alias("sentences"),
    )


def op6_sentencepiece(spark, sf_dir):
    """Ids of every document and whether they decode to its text again."""
    found = pieces.encode_documents(
        _table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model")
    )
    return found.select("doc_id", "n_tokens", F.xxhash64("ids").alias("ids_hash"), "round_trip")


def op7_token_files(spark, sf_dir):
    """Place, length and checksum of every document's ids, from the files written."""
    path = scratch_path(spark, "token-files")
    token_files.write_token_files(
        _table(spark, sf_dir, "documents"), path, public_tokenizers.path("byte_bpe_50k.json")
    )
    return token_files.token_digests(spark, path)


def op8_language_id(spark, sf_dir):
    """Predicted language of every document, and whether it was held out of learning."""
    docs = _table(spark, sf_dir, "documents")
    found = language.identify(docs, language.learn(docs))
    return found.select(
        "doc_id", language.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score"
    )


def op9_source_mixing(spark, sf_dir):
    """Rate and copies of every document for equal token shares of the sources."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "source", "lang")
    return mixing.fit_rates(docs)[0]


def op10_exact_dedup(spark, sf_dir):
    """The row that stays and the group size of every document."""
    return dedup.exact_groups(_table(spark, sf_dir, "documents"))


def op11_collocations(spark, sf_dir):
    """The first 2,000 phrases of every language."""
    return collocations.collocations(_table(spark, sf_dir, "documents"))


def op12_whitening(spark, sf_dir):
    """The 16 leading whitened components of every vector."""
    return whitening.whiten(_table(spark, sf_dir, "embeddings"))


def op13_substring_dedup(spark, sf_dir):
    """Words of every document, and those that windows of smaller documents cover."""
    left = substrings.remove_repeats(_table(spark, sf_dir, "documents"))
    kept = F.sha2(F.col("text").cast("binary"), 256)
    return left.select("doc_id", "n_words", "n_removed", kept.alias("kept_sha256"))


QUERIES: dict[str, Query] = {
    "op1_html_extraction": op1_html_extraction,
    "op2_quality_classifier": op2_quality_classifier,
    "op3_topk_search": op3_topk_search,
    "op4_simhash_components": op4_simhash_components,
    "op5_license_scan": op5_license_scan,
    "op6_sentencepiece": op6_sentencepiece,
    "op7_token_files": op7_token_files,
    "op8_language_id": op8_language_id,
    "op9_source_mixing": op9_source_mixing,
    "op10_exact_dedup": op10_exact_dedup,
    "op11_collocations": op11_collocations,
    "op12_whitening": op12_whitening,
    "op13_substring_dedup": op13_substring_dedup,
}



def _license_sql() -> str:
    """The licences of plain notices, stated by hand, in DuckDB: nothing of the operator's own tables,
    breaks or rules is used."""
    stated = {
        "the apache license version 2 0": "Apache-2.0",
        "the mit license": "MIT",
        "the gnu general public license version 3": "GPL-3.0",
        "the gnu general public license version 2": "GPL-2.0",
        "cc by 4 0": "CC-BY-4.0",
        "cc by nc 4 0": "CC-BY-NC-4.0",
        "cc by sa 4 0": "CC-BY-SA-4.0",
        "the mozilla public license version 2 0": "MPL-2.0",
    }
    verbs = ("licensed under", "released under", "this work is licensed under")
    notices = {f"{v} {n}": f"{k}:notice" for v in verbs for n, k in stated.items()}
    table = ", ".join(f"'{s}': '{i}'" for s, i in {**notices, "all rights reserved": "reserved"}.items())
    return f"""
        WITH k AS (SELECT MAP {{{table}}} AS m), p AS (
            SELECT doc_id, regexp_split_to_array(coalesce(text, ''), '[.!?]+([ \\t\\n\\r]|$)|[\\r\\n]+')
                AS pieces FROM documents
        ), s AS (
            SELECT doc_id, list_filter(list_transform(pieces, lambda p:
                k.m[trim(regexp_replace(lower(p), '[^a-z0-9]+', ' ', 'g'))]),
                lambda x: x IS NOT NULL) AS ids FROM p, k
        ), n AS (
            SELECT doc_id, ids, list_sort(list_distinct(list_transform(list_filter(ids,
                lambda x: x <> 'reserved'), lambda x: replace(x, ':notice', '')))) AS named FROM s
        )
        SELECT doc_id, array_to_string(ids, ',') AS sentences,
            CASE WHEN len(named) > 0 THEN array_to_string(named, ',')
                WHEN len(ids) > 0 THEN 'Proprietary' ELSE '' END AS licenses
        FROM n"""


_ASCII = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"

ORACLES: dict[str, str] = {
    "op11_collocations": rf"""
        WITH p AS (
            SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
                translate(coalesce(text, ''), {_ASCII}), '[.,;:!?\x0A-\x0D]')) AS piece
            FROM documents
        ), w AS (
            SELECT lang, row_number() OVER () AS id, list_filter(
                regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS words
            FROM p
        ), t AS (
            SELECT lang, id, unnest(words) AS w1, generate_subscripts(words, 1) AS k FROM w
        ), s AS (
            SELECT lang, w1, lead(w1, 1) OVER o AS w2, lead(w1, 2) OVER o AS w3
            FROM t WINDOW o AS (PARTITION BY id ORDER BY k)
        ), one AS (
            SELECT lang, w1, count(*) AS f FROM s GROUP BY ALL
        ), two AS (
            SELECT lang, w1, w2, count(*) AS f FROM s WHERE w2 IS NOT NULL
            GROUP BY ALL HAVING count(*) >= 10
        ), three AS (
            SELECT lang, w1, w2, w3, count(*) AS f FROM s WHERE w3 IS NOT NULL
            GROUP BY ALL HAVING count(*) >= 10
        ), inside AS (
            SELECT two.lang, two.w1, two.w2 FROM two JOIN three ON two.lang = three.lang
             AND two.w1 = three.w1 AND two.w2 = three.w2 AND 100 * three.f >= 50 * two.f
            UNION
            SELECT two.lang, two.w1, two.w2 FROM two JOIN three ON two.lang = three.lang
             AND two.w1 = three.w2 AND two.w2 = three.w3 AND 100 * three.f >= 50 * two.f
        ), cut AS (
            SELECT two.lang, two.w1 || ' ' || two.w2 AS phrase, 1 AS k, two.f AS a, x.f AS l, y.f AS r
            FROM two JOIN one x ON x.lang = two.lang AND x.w1 = two.w1
            JOIN one y ON y.lang = two.lang AND y.w1 = two.w2
            ANTI JOIN inside i ON i.lang = two.lang AND i.w1 = two.w1 AND i.w2 = two.w2
            UNION ALL
            SELECT t.lang, t.w1 || ' ' || t.w2 || ' ' || t.w3, 1, t.f, x.f, y.f
            FROM three t JOIN one x ON x.lang = t.lang AND x.w1 = t.w1
            JOIN two y ON y.lang = t.lang AND y.w1 = t.w2 AND y.w2 = t.w3
            UNION ALL
            SELECT t.lang, t.w1 || ' ' || t.w2 || ' ' || t.w3, 2, t.f, x.f, y.f
            FROM three t JOIN two x ON x.lang = t.lang AND x.w1 = t.w1 AND x.w2 = t.w2
            JOIN one y ON y.lang = t.lang AND y.w1 = t.w3
        ), scored AS (
            SELECT *, (1000000::HUGEINT * a * a // (l::HUGEINT * r))::BIGINT AS score FROM cut
        ), best AS (
            SELECT * FROM scored
            QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
        ), sizes AS (
            SELECT lang, count(*) AS n FROM t GROUP BY lang
        )
        SELECT lang, row_number() OVER (
                   PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank,
               phrase, a, l, r, n, score
        FROM best JOIN sizes USING (lang) QUALIFY rank <= 2000
    """,
    "op13_substring_dedup": r"""
        WITH d AS (
            SELECT doc_id, list_filter(regexp_split_to_array(
                coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words
            FROM documents
        ), w AS (
            SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS k FROM d
        ), s AS (
            SELECT *, string_agg(word, ' ') OVER o AS win, count(*) OVER o = 13 AS whole
            FROM w WINDOW o AS (PARTITION BY doc_id ORDER BY k
                                ROWS BETWEEN CURRENT ROW AND 12 FOLLOWING)
        ), f AS (
            SELECT doc_id, k, word, whole AND doc_id > min(doc_id) OVER (PARTITION BY win, whole) AS late
            FROM s
        ), c AS (
            SELECT doc_id, k, word, bool_or(late) OVER (PARTITION BY doc_id ORDER BY k
                                    ROWS BETWEEN 12 PRECEDING AND CURRENT ROW) AS gone
            FROM f
        ), g AS (
            SELECT doc_id, count(*) AS n_words, count(*) FILTER (gone) AS n_removed,
                   coalesce(string_agg(word, ' ' ORDER BY k) FILTER (NOT gone), '') AS kept
            FROM c GROUP BY doc_id
        )
        SELECT doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_removed, 0) AS n_removed,
               sha256(coalesce(kept, '')) AS kept_sha256
        FROM d LEFT JOIN g USING (doc_id)
    """,
    "op5_license_scan": _license_sql(),
    "op3_topk_search": """
        WITH v AS (
            SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q
            FROM embeddings
            WHERE embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), s AS (
            SELECT a.vec_id AS query_id, b.vec_id,
                   list_inner_product(a.q, b.q)::BIGINT AS score
            FROM v a JOIN v b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id
        )
        SELECT query_id, rank, vec_id, score FROM (
            SELECT *, (row_number() OVER (
                PARTITION BY query_id ORDER BY score DESC, vec_id))::INTEGER AS rank FROM s
        ) WHERE rank <= 5
    """,
    "op10_exact_dedup": r"""
        WITH d AS (
            SELECT doc_id, sha256(regexp_replace(
                coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256
            FROM documents
        ), g AS (
            SELECT *, min(doc_id) OVER (PARTITION BY text_sha256) AS keep_id,
                   count(*) OVER (PARTITION BY text_sha256) AS group_size
            FROM d
        )
        SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM g
    """,
}
