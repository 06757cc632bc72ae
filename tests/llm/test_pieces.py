import random

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor

from newsflow.llm import pieces as P

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def model():
    return SentencePieceProcessor(model_file=PATH)


@pytest.fixture(scope="module")
def known():
    return P.Vocabulary(PATH, "bpe")


def ids_of(known, text):
    return known.encode([text])[0].tolist()


def test_whole_table_equals_the_library(spark, documents, model):
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = {r.doc_id: r for r in P.encode_documents(df, PATH).collect()}
    for row in documents:
        assert found[row["doc_id"]].ids == model.encode(row["text"])
        assert found[row["doc_id"]].decoded == row["text"] and found[row["doc_id"]].round_trip
        assert found[row["doc_id"]].n_tokens == len(found[row["doc_id"]].ids)


@settings(max_examples=400, deadline=None)
@given(st.text(st.characters(codec="utf-8", exclude_characters="\0"), max_size=40))
def test_any_text_equals_the_library(model, known, text):
    ids = ids_of(known, text)
    assert ids == model.encode(text)
    assert known.decode(np.array(ids, dtype=int)) == model.decode(ids) == text.replace(P.MARK, " ")


def test_merging_edges_equal_the_library(model, known):
    rng = random.Random(4)
    for _ in range(5000):
        text = "".join(rng.choice("aaabbcé theinr▁ \n\t.,0019🙂日本²") for _ in range(rng.randrange(30)))
        assert ids_of(known, text) == model.encode(text), text


def test_unigram_paths_are_the_best(known):
    """Scores of all ways to cut short words, compared with the path that was found."""
    unigram = P.Vocabulary(PATH, "unigram")

    def ways(word):
        if not word:
            yield 0.0
        for end in range(1, len(word) + 1):
            score = unigram.score.get(word[:end])
            if score is None and end == 1:
                score = unigram.least - P.UNKNOWN_PENALTY
            if score is not None:
                for rest in ways(word[end:]):
                    yield score + rest

    rng = random.Random(9)
    words = ["▁" + "".join(rng.choice("thearsin☃") for _ in range(rng.randrange(1, 9))) for _ in range(60)]
    table = unigram.learn(words)
    for word in words:
        parts = [unigram.pieces[i] for i in np.frombuffer(table[word], dtype="<i4")]
        score = 0.0
        for part in parts:
            if not part.startswith("<0x"):
                score += unigram.score[part]
        score += sum(unigram.least - P.UNKNOWN_PENALTY for c in word if c not in unigram.score)
        assert score == pytest.approx(max(ways(word)))


def test_odd_rows_and_clashing_columns(frame, spark, model):
    long = "long" * 50_000
    rows = [(1, None), (2, ""), (3, " "), (4, "a  b\n"), (5, long), (5, long), (None, "x")]
    df = frame([(*r, [1], "d") for r in rows], "doc_id long, text string, ids array<int>, decoded string")
    found = P.encode_documents(df, PATH).collect()
    expected = sorted((repr(i), model.encode(t or ""), t or "") for i, t in rows)
    assert sorted((repr(r.doc_id), r.ids, r.decoded) for r in found) == expected
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert P.encode_documents(empty, PATH).collect() == []


def test_unknown_and_control_ids_decode_as_in_the_library(spark, model):
    lists = [[0], [1, 15043, 2], [0, 15043, 0], [200, 15043], [3 + 0xE6, 15043], None, []]
    df = spark.createDataFrame([(x,) for x in lists], "ids array<int>").coalesce(1)
    found = [r[0] for r in df.select(P.decode(F.col("ids"), PATH)).collect()]
    assert found == [model.decode(x or []) for x in lists]


def test_forgetting_changes_nothing(monkeypatch, model):
    monkeypatch.setattr(P, "REMEMBERED", 10)
    known = P.Vocabulary(PATH, "bpe")
    for text in ("the quick brown fox jumps over it", "another text with the quick words in it"):
        assert ids_of(known, text) == model.encode(text)
