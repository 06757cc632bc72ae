import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from newsflow.llm import language as L

PATH = "/root/testdata/sf0.01/documents.parquet"
SCHEMA = "doc_id long, text string, lang string, spans int, score string"


@pytest.fixture(scope="module")
def model(spark):
    return L.learn(spark.read.parquet(PATH))


def test_held_out_documents_are_recognised(spark, documents, model):
    found = {r.doc_id: r for r in L.identify(spark.read.parquet(PATH), model).collect()}
    assert model.languages == ("de", "en", "es", "fr")
    kept = [r for r in documents if zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2]
    right = sum(found[r["doc_id"]].lang_pred == r["lang"] for r in kept)
    assert len(found) == len(documents) and right >= 0.985 * len(kept)
    for row in documents:
        spans = found[row["doc_id"]].spans
        assert spans[0].start == 0 and spans[-1].end == len(row["text"])
        assert all(a.end == b.start and a.lang != b.lang for a, b in zip(spans, spans[1:]))


def test_held_out_is_the_checksum_of_the_id(spark):
    rows = spark.range(500).select("id", L.held_out(F.col("id")).alias("h")).collect()
    assert all(r.h == (zlib.crc32(str(r.id).encode()) % 4 == 2) for r in rows)
    assert spark.range(1).select(L.held_out(F.lit(None).cast("long"))).first()[0] is True


def test_held_out_rows_teach_nothing(spark, documents):
    rows = [(r["doc_id"], r["text"], r["lang"]) for r in documents[:200]]
    changed = [(i, "zzz qqq", "xx") if zlib.crc32(str(i).encode()) % 4 == 2 else (i, t, l)
               for i, t, l in rows]
    one, two = (
        L.learn(spark.createDataFrame(x, "doc_id long, text string, lang string"))
        for x in (rows, changed)
    )
    assert one.languages == two.languages and np.array_equal(one.grams, two.grams)


def brute(scores, switch):
    """Best total and the labels, one word after the other."""
    n, k = scores.shape
    value, back = np.zeros(k), []
    for t in range(n):
        top = int(value.argmax())
        stay = value >= value[top] - switch if t else np.ones(k, dtype=bool)
        back.append(np.where(stay, np.arange(k), top))
        value = np.where(stay, value, value[top] - switch) + scores[t]
    path = [int(value.argmax())]
    for t in range(n - 1, 0, -1):
        path.append(int(back[t][path[-1]]))
    return path[::-1]


def total(scores, path, switch):
    changes = sum(a != b for a, b in zip(path, path[1:]))
    return sum(scores[t, k] for t, k in enumerate(path)) - switch * changes


@pytest.mark.parametrize("block", [1, 3, 64])
def test_viterbi_equals_one_word_after_the_other(monkeypatch, block):
    monkeypatch.setattr(L, "BLOCK", block)
    rng = np.random.default_rng(block)
    lengths = np.array([5, 0, 1, 200, 64, 65, 0, 31])
    scores = rng.normal(size=(lengths.sum(), 4)) * 5
    labels = L.viterbi(scores, lengths, 6.0)
    at = 0
    for n in lengths:
        own, path = scores[at : at + n], labels[at : at + n].tolist()
        if n:
            assert total(own, path, 6.0) == pytest.approx(total(own, brute(own, 6.0), 6.0))
        at += n


def test_spans_of_mixed_text(documents, model):
    by = {lang: next(r["text"] for r in documents if r["lang"] == lang and 600 < r["n_chars"] < 900)
          for lang in model.languages}
    text = " ".join(by[x] for x in ("de", "en", "fr"))
    found = L.spans_of([text], model)[0]
    assert [s["lang"] for s in found] == ["de", "en", "fr"]
    assert abs(found[0]["end"] - len(by["de"])) < 40 and found[-1]["end"] == len(text)


def test_scripts_narrow_the_candidates(spark):
    rows = [(i, "это русский текст про слова", "ru") for i in range(40)]
    rows += [(i + 40, "these are words of a text", "en") for i in range(40)]
    model = L.learn(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    place = model.languages.index("ru")
    own, none = model.word_scores(["слово", "漢字"])
    assert own[place] == 0 and own[1 - place] == L.FOREIGN
    assert (none == 0).all()  # nobody's script: no evidence
    assert [L.NAMES[i] for i in L.scripts_of(["漢", "é"])] == ["han", "latin"]


def test_grams_are_those_of_each_word_alone():
    words = ["the", "a", "Straße", "ИЗ", "the", "abcdefgh"]
    buckets, starts = L.grams_of(words)
    for k, word in enumerate(words):
        alone, _ = L.grams_of([word])
        end = starts[k + 1] if k + 1 < len(words) else buckets.shape[1]
        assert np.array_equal(buckets[:, starts[k] : end], alone)
        marked = len(word.lower()) + 2
        assert (alone < L.BUCKETS).sum() == sum(max(0, marked - n + 1) for n in L.GRAMS)
    assert len({tuple(L.grams_of([w])[0].ravel()) for w in words}) == 5


def test_odd_rows(frame, model):
    long = "the and of to in that is for " * 20_000
    rows = [(1, None), (2, ""), (3, "12 ?!"), (4, "x"), (5, long), (5, long), (None, "the of and to")]
    df = frame([(*r, "en", 1, "s") for r in rows], SCHEMA)
    found = L.identify(df, model).collect()
    by = {r.doc_id: r for r in found}
    assert len(found) == len(rows)
    for i in (1, 2, 3):
        assert (by[i].spans, by[i].lang_pred, by[i].score) == ([], "und", 0.0)
    assert by[5].lang_pred == "en" and by[5].score == 1.0 and by[None].lang_pred == "en"
    assert by[4].lang_pred in model.languages


def test_nothing_to_learn_from(spark, frame):
    df = frame([(1, "text", None, 1, "s"), (2, None, "en", 1, "s")], SCHEMA)
    model = L.learn(df)
    assert model.languages == ()
    assert {(r.lang_pred, r.score) for r in L.identify(df, model).collect()} == {("und", 0.0)}
    empty = spark.createDataFrame([], SCHEMA)
    assert L.identify(empty, L.learn(empty)).collect() == []
