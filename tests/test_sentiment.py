import math
import random
import string

import pytest
from pyspark.sql import functions as F

from newsflow.functions import sentiment as S
from newsflow.operators import blocks as B
from newsflow.operators import sentiment as N
from newsflow.operators.enrich import process_articles
from newsflow.plans import adapters as A
from newsflow.operators.sizing import is_small
from newsflow.schemas import LEXICON


@pytest.fixture(scope="module")
def marks(spark):
    return N.token_marks(
        N.sample_lexicon(spark), N.default_boosters(spark), N.default_negations(spark)
    )


def scores(spark, marks, texts, **options):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, full_text string")
    return N.score_with_marks(df, marks, **options).orderBy("i").collect()


# Worked out by hand from the rules and the sample lexicon.
def compound(s):
    return round(s / math.sqrt(s * s + 15), 4)


CASES = {
    "good": compound(1.9),
    "not good": compound(1.9 * -0.74),
    "not very good": compound((1.9 + 0.293) * -0.74),
    "never a good": compound(1.9 * -0.74),
    "not one two good": compound(1.9 * -0.74),
    "not one two three good": compound(1.9),
    "very good": compound(1.9 + 0.293),
    "very one good": compound(1.9 + 0.293 * 0.95),
    "very one two good": compound(1.9 + 0.293 * 0.9),
    "slightly bad": compound(-2.5 + 0.293),
    "very bad": compound(-2.5 - 0.293),
    "GOOD day": compound(1.9 + 0.733),
    "GOOD DAY": compound(1.9),
    "VERY good": compound(1.9 + 0.293 + 0.733),
    "good but bad": compound(1.9 * 0.5 - 2.5 * 1.5),
    "good!": compound(1.9 + 0.292),
    "good!!!!!!": compound(1.9 + 4 * 0.292),
    "good??": compound(1.9 + 2 * 0.18),
    "good?????": compound(1.9 + 0.96),
    "bad!": compound(-2.5 - 0.292),
    "day": 0.0,
    "  ": 0.0,
    "": 0.0,
    None: 0.0,
}


@pytest.mark.parametrize("lookup", ["auto", "index", "join"])
def test_rules(spark, marks, lookup):
    rows = scores(spark, marks, list(CASES), lookup=lookup)
    for row, expected in zip(rows, CASES.values(), strict=True):
        assert row["sentiment_compound"] == pytest.approx(expected, abs=1e-6), row["full_text"]


def test_blank_text_is_neutral(spark, marks):
    for row in scores(spark, marks, ["  ", "", None, " \n"]):
        assert row["sentiment"] == "neutral"
        assert (row["sentiment_pos"], row["sentiment_neg"], row["sentiment_neu"]) == (0, 0, 1)


def test_shares(spark, marks):
    row = scores(spark, marks, ["good bad day"], rules=S.Rules(context=False))[0]
    whole = 2.9 + 3.5 + 1
    assert row["sentiment_pos"] == pytest.approx(round(2.9 / whole, 3))
    assert row["sentiment_neg"] == pytest.approx(round(3.5 / whole, 3))
    assert row["sentiment_neu"] == pytest.approx(round(1 / whole, 3))


def test_label_bounds_are_inclusive(spark):
    df = spark.createDataFrame([(v,) for v in (0.05, 0.0499, -0.05, -0.0499, 0.0)], "c double")
    labels = [r[0] for r in df.select(S.classify(F.col("c"))).collect()]
    assert labels == ["positive", "neutral", "negative", "neutral", "neutral"]


def test_tokens_drop_edge_punctuation(spark):
    def expected(text):
        bare = [(w, w.strip(string.punctuation)) for w in text.split()]
        return [b if len(b) > 2 else w for w, b in bare]

    chance = random.Random(5)
    texts = ["..ab", "a.b,", "-- x ...yes!! (no)", "a, ab. abc. .abc x..y..z", " lead  trail ", ""]
    texts += ["".join(chance.choices("ab.,!_- é\n", k=chance.randint(0, 14))) for _ in range(3000)]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = df.select("t", S.split_tokens(F.col("t")).alias("w")).collect()
    assert all(r["w"] == expected(r["t"]) for r in got)


def test_size_check_picks_the_other_way(spark):
    rows = [(f"w{i}", 1.0) for i in range(50)]
    lexicon = spark.createDataFrame(rows, LEXICON)
    assert is_small(lexicon, max_rows=50)
    assert not is_small(lexicon, max_rows=49)
    assert not is_small(lexicon, max_bytes=100)


ODD = [("good", 2.0), ("Good", 3.0), (None, 9.0), ("BAD", -2.0), ("bad", -2.0), ("good", 1.0)]


def test_both_ways_treat_odd_lexicons_alike(spark):
    """NULL, upper-case and repeated tokens: one validated table, whatever the look-up."""
    marks = spark.createDataFrame(
        [(t, v, None, None) for t, v in ODD],
        "token string, valence double, delta double, negates boolean",
    )
    texts = ["Good day", "a BAD day", "good bad good", "null", ""]
    by = [scores(spark, marks, texts, lookup=way) for way in ("auto", "index", "join")]
    assert by[0] == by[1] == by[2]
    assert by[0][0]["sentiment"] == "positive" and by[0][1]["sentiment"] == "negative"
    one = N.one_mark_per_token(marks).collect()
    assert {(r["token"], r["mark"]["valence"]) for r in one} == {("good", 3.0), ("bad", -2.0)}


def test_index_refuses_marks_beyond_the_bound(spark, marks, monkeypatch):
    monkeypatch.setattr(N, "is_small", lambda df: False)
    with pytest.raises(ValueError):
        scores(spark, marks, ["x"], lookup="index")
    assert scores(spark, marks, ["good day"])[0]["sentiment"] == "positive"


def test_the_join_shuffles_the_lexicon(spark, marks):
    df = spark.createDataFrame([("good day",)], "full_text string")
    plan = N.score_with_marks(df, marks, lookup="join")._jdf.queryExecution().toString()
    physical = plan[plan.index("== Physical Plan ==") :]
    assert "SortMergeJoin [token" in physical
    assert not [x for x in physical.splitlines() if "BroadcastHashJoin [token" in x]


def test_prepared_marks_are_derived_once(spark, marks):
    ready = N.prepare_marks(marks)
    assert ready.small and "FileScan parquet" in ready.table._jdf.queryExecution().toString()
    assert scores(spark, ready, ["good day"])[0]["sentiment"] == "positive"


def test_copies_of_a_text_all_get_their_score(spark, marks):
    texts = ["good day"] * 40 + ["bad day"]
    rows = scores(spark, marks, texts, lookup="join")
    assert len(rows) == 41
    assert [r["sentiment"] for r in rows] == ["positive"] * 40 + ["negative"]


def test_unknown_lookup_is_refused(spark, marks):
    with pytest.raises(ValueError):
        scores(spark, marks, ["x"], lookup="guess")


def test_blocks_of_texts_give_the_same_as_the_index(spark, monkeypatch):
    monkeypatch.setattr(B, "BLOCK_BYTES", 40)
    texts = ["good " * 50, "not GOOD, very bad!", "", None, " 　 ", "a b c", "war? but Good", "not GOOD, very bad!"]
    rows = [(k, text) for k, text in enumerate(texts * 5)]
    df = spark.createDataFrame(rows, "k int, full_text string").withColumn("nothing", F.lit(None))
    parts = (N.sample_lexicon(spark), N.default_boosters(spark), N.default_negations(spark))
    direct, joined = (N.score_sentiment(df, *parts, lookup=lookup) for lookup in ("index", "join"))
    assert joined.columns == direct.columns and joined.dtypes == direct.dtypes
    assert joined.orderBy("k").collect() == direct.orderBy("k").collect()


def test_a_word_meets_the_table_once_per_block(spark):
    df = spark.createDataFrame([(k, "good word " * 500 + str(k)) for k in range(40)], "k int, full_text string")
    table = spark.createDataFrame([("good", 1)], "token string, mark int")
    scored = B.look_up_by_blocks(
        df, "full_text", lambda w: w.join(table, "token"), lambda t: F.split(t, " "), lambda t, index: F.size(index)
    )
    plan = scored._jdf.queryExecution().optimizedPlan().toString()
    assert scored.count() == 40
    assert "explode(array_distinct(flatten(" in plan and "posexplode" not in plan


def test_blank_texts_take_no_part_in_the_look_up(spark):
    df = spark.createDataFrame([(" \t",), ("",), (None,)], "full_text string")
    fails = F.raise_error(F.lit("worked on"))
    looked = B.look_up_by_blocks(
        df, "full_text", lambda w: w.withColumn("mark", F.lit(1)), lambda t: F.array(t), lambda t, index: fails.cast("int")
    )
    assert [(r["_blank"], r["_result"]) for r in looked.collect()] == [(True, None)] * 3


def test_the_values_of_a_block_are_those_of_the_row(spark, marks):
    """Every rule without phrases, and runs with odd edges, in texts that share a block."""
    random.seed(5)
    words = ["good", "GOOD", "Bad", "very", "VERY", "not", "but", "BUT", "don't", "hardly", "war", "x", "İş",
             "ΣΑΣ", "(good)", "'not'", ":)", "--", "a.", "(a.b)", "«good»", "ﬀ", "1"]
    gaps = [" ", "  ", "\t", "\u00a0", "\u3000", "\x1c", "\n"]
    texts = ["".join(random.choice(words) + random.choice(gaps) + random.choice(["", "!", "? "])
                     for _ in range(random.randrange(30))) for _ in range(150)]
    for rules in (S.Rules(), S.Rules(context=False)):
        in_row, joined = (scores(spark, marks, texts, rules=rules, lookup=way) for way in ("index", "join"))
        assert in_row == joined
    tokens = spark.createDataFrame([(t,) for t in texts], "t string").select("t", S.split_tokens(F.col("t")).alias("w"))
    assert all([*map(S.token_of(), r["t"].split())] == r["w"] for r in tokens.collect())


def test_the_join_scores_texts_without_a_step_per_token(spark, marks):
    df = spark.createDataFrame([("good day",)], "full_text string")
    plan = N.score_with_marks(df, marks, lookup="join")._jdf.queryExecution().optimizedPlan().toString()
    assert "regexp_extract_all" not in plan and "map_from_entries" not in plan


def test_keywords_are_not_made_before_the_look_up(spark, marks, monkeypatch):
    """What nobody reads of them is then left out by Spark, also where the look-up stores its rows."""
    stored = []
    monkeypatch.setattr(B, "written", lambda df, label: stored.append(df.columns) or df)
    raw = spark.createDataFrame([(1, "t", "s", "good day")], "id int, title string, summary string, content string")
    raw = raw.withColumns({c: F.lit("x") for c in ("link", "author", "published", "source", "category", "crawled_at")})
    done = process_articles(raw, marks, lookup="join")
    assert stored and not any("keywords" in columns for columns in stored)
    assert done.first()["keywords"] == "good,day"


def test_the_words_of_a_corpus_come_from_its_distinct_runs(spark, tmp_path):
    texts = ["The cat, the CAT", "cat\x1fsat don't", None, "", "x_cat naïve dog\u00a0dog", "dog2 (dog)"]
    spark.createDataFrame([(t,) for t in texts], "text string").write.parquet(f"{tmp_path}/documents.parquet")
    assert {r["token"] for r in A._corpus_words(spark, str(tmp_path)).collect()} == {"the", "cat", "sat", "don", "dog"}
    twice = spark.createDataFrame([("one two one",)] * 9, "text string").coalesce(1)
    assert sorted(r["run"] for r in A.distinct_runs(twice).collect()) == ["one", "two"]
    assert len(A.distinct_runs(twice, held=20).collect()) > 2
