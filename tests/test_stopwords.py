import random
import re
from collections import Counter

import pytest

from newsflow.functions import keywords as K
from newsflow.operators import stopwords as W
from newsflow.operators.enrich import enrich_text

TEXTS = [
    (1, "Alpha beta alpha the the gamma."), (2, None), (3, ""), (4, "the the the"),
    (5, "beta alpha; alpha BETA"), (5, "beta alpha; alpha BETA"), (6, "x1 ab a-b café zzz"),
    (7, "delta " * 50_000 + "the " * 50_000 + "gamma"),
]
LISTED = ["The", "beta", "beta", None, "", "ab", "a b", "é", "abc\n"]


def expected(text, stop, top_n=K.TOP_N):
    words = [w for w in re.findall(r"\b[a-z]{3,}\b", (text or "").lower()) if w not in stop]
    return ",".join(w for w, _ in Counter(words).most_common(top_n))


def table(spark, words):
    return spark.createDataFrame([(w, 1) for w in words], "word string, _text_key int")


@pytest.fixture(scope="module")
def stop(spark):
    return W.prepare_stop_words(table(spark, LISTED))


def test_words_no_text_can_hold_are_left_out(spark, stop):
    assert stop.listed == ("beta", "the")
    assert W.prepare_stop_words(table(spark, [])).listed == ()


@pytest.mark.parametrize("lookup", ["auto", "row", "join"])
def test_keywords_of_odd_texts(spark, stop, lookup):
    df = spark.createDataFrame([(i, t, "w") for i, t in TEXTS], "i int, full_text string, word string")
    found = W.add_keywords(df, stop, top_n=2, lookup=lookup)
    assert found.columns == ["i", "full_text", "word", "keywords"]
    rows = sorted((r.i, r.keywords) for r in found.collect())
    assert rows == sorted((i, expected(t, {"the", "beta"}, 2)) for i, t in TEXTS)
    assert W.add_keywords(df.limit(0), stop, lookup=lookup).collect() == []


@pytest.mark.parametrize("lookup", ["row", "join"])
def test_remaining_rows_all_stay(spark, stop, lookup):
    tokens = [(1, "the"), (1, "alpha"), (1, "alpha"), (2, None), (2, "beta"), (3, "gamma")]
    df = spark.createDataFrame(tokens, "i int, word string")
    kept = [tuple(r) for r in W.drop_stop_rows(df, stop, "i", lookup).collect()]
    assert sorted(kept, key=repr) == sorted(
        (t for t in tokens if t[1] not in ("the", "beta")), key=repr
    )
    none = W.prepare_stop_words(table(spark, [None]))
    assert W.drop_stop_rows(df, none, "i", lookup).count() == len(tokens)


def test_beyond_the_bound_words_are_joined(spark):
    rng = random.Random(5)
    words = ["".join(rng.choices("abcdefghij", k=5)) for _ in range(W.MAX_LISTED * 2)]
    stop = W.prepare_stop_words(table(spark, words))
    assert stop.listed is None
    texts = [(i, " ".join(rng.choices(words, k=3) + rng.choices("uvw xyz uvw".split(), k=5)))
             for i in range(300)]
    found = W.add_keywords(spark.createDataFrame(texts, "i int, full_text string"), stop)
    listed = set(words)
    assert {r.i: r.keywords for r in found.collect()} == {i: expected(t, listed) for i, t in texts}
    plan = found._jdf.queryExecution().executedPlan().toString()
    joins = [line for line in plan.splitlines() if "LeftAnti" in line]
    assert joins and all("SortMergeJoin" in line for line in joins)
    with pytest.raises(ValueError, match="too many"):
        W.add_keywords(found, stop, lookup="row")


def test_few_words_need_no_shuffle(spark, stop):
    df = spark.createDataFrame(TEXTS, "i int, full_text string")
    plan = W.add_keywords(df, stop)._jdf.queryExecution().toString()
    assert "Exchange" not in plan and "Join" not in plan
    with pytest.raises(ValueError, match="lookup"):
        W.add_keywords(df, stop, lookup="index")


def test_frequent_words(spark):
    rows = [("the cat",), ("the the dog",), ("cat",), (None,), ("",)]
    df = spark.createDataFrame(rows, "text string")
    found = {r.word: r.n for r in W.frequent_words(df, 40).collect()}
    assert found == {"the": 2, "cat": 2}
    assert W.frequent_words(df.limit(0), 40).collect() == []
    with pytest.raises(ValueError, match="percent"):
        W.frequent_words(df, 0)


def test_articles_by_a_table_of_stop_words(spark, stop):
    df = spark.createDataFrame(
        [("The alpha", "beta alpha", None), (None, None, None)],
        "title string, summary string, content string",
    )
    rows = enrich_text(df, stop_words=stop).select("keywords", "text_length").collect()
    assert sorted(map(tuple, rows)) == [("", 2), ("alpha", 21)]
    fixed = enrich_text(df).select("keywords").collect()
    assert sorted(r.keywords for r in fixed) == ["", "alpha,beta"]


def test_joined_words_are_those_of_blocks(spark, stop):
    df = spark.createDataFrame([(k, "alpha the beta " * 99 + "gamma") for k in range(9)], "i int, full_text string")
    found = W.add_keywords(df, stop, lookup="join")
    assert {r.keywords for r in found.collect()} == {"alpha,gamma"}
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "explode(array_distinct(flatten(" in plan and "_salt" not in plan
