import pytest

from newsflow.functions import sentiment as S
from newsflow.operators import sentiment as N
from newsflow.sources import lexicons as L

LINES = [
    ("good\t1.9\t0.9434\t[2, 1, 1, 3, 2, 4, 2, 2, 1, 1]", None),
    ("Fine \t0.8\t0.9798\t[1, 0, 2, 1]", "unequal"),
    ("no mean\t\t0.1\t[1]", "mean"),
    ("short", "fields"),
    ("a\t1.0\t0.5\t[1]\tmore", "fields"),
    ("\t1.0\t0.5\t[1]", "token"),
    ("nan\tNaN\t0.5\t[1]", "mean"),
    ("inf\tInfinity\t0.5\t[1]", "mean"),
    ("neg\t1.0\t-0.5\t[1]", "deviation"),
    ("dev\t1.0\tx\t[1]", "deviation"),
    ("list\t1.0\t0.5\t1, 1", "ratings"),
    ("none\t1.0\t0.5\t[]", "ratings"),
    ("hole\t1.0\t0.5\t[1, null]", "ratings"),
    ("two\t-1.5", None),
    (":-)\t1.3\t0.4", None),
    ("three\t2.5\t\t", None),
    ("round\t0.3\t0.1\t[0, 0, 1]", None),
    ("", "blank"),
    ("  ", "blank"),
    (None, "blank"),
]


def test_lines_are_entries_or_set_aside(spark):
    df = spark.createDataFrame([(line, k) for k, (line, _) in enumerate(LINES)], "line string, reason_no int")
    good, bad = L.parse_lexicon(df)
    assert sorted((r.line or "", r.reason) for r in bad.collect()) == sorted(
        (line or "", reason) for line, reason in LINES if reason
    )
    assert bad.columns == ["line", "reason_no", "reason"]
    found = {r.token: (r.valence, r.deviation, r.ratings) for r in good.collect()}
    assert found == {
        "good": (1.9, 0.9434, [2, 1, 1, 3, 2, 4, 2, 2, 1, 1]), "two": (-1.5, None, None),
        ":-)": (1.3, 0.4, None), "three": (2.5, None, None), "round": (0.3, 0.1, [0, 0, 1]),
    }


def test_round_trip_and_scores_from_a_file(spark, tmp_path):
    rows = [(t, v, 0.5, None) for t, v in S.SAMPLE_LEXICON.items()] + [("naïve", -1.0, None, [-1, -1, -1])]
    L.write_lexicon(spark.createDataFrame(rows, L.GOOD), path := str(tmp_path / "lexicon"))
    (tmp_path / "lexicon" / "more.txt").write_text("broken line\ngreat\tx\n", encoding="utf-8")
    good, bad = L.read_lexicon(spark, path)
    assert sorted(map(tuple, good.collect()), key=repr) == sorted(rows, key=repr)
    assert [(r.line, r.file, r.reason) for r in bad.orderBy("line").collect()] == [
        ("broken line", "more.txt", "fields"), ("great\tx", "more.txt", "mean"),
    ]
    df = spark.createDataFrame([("a great success!",), ("naïve war",), ("",)], "full_text string")
    from_file = N.score_sentiment(df, good, N.default_boosters(spark), N.default_negations(spark)).collect()
    direct = N.score_sentiment(df, N.sample_lexicon(spark).union(spark.createDataFrame([("naïve", -1.0)])),
                               N.default_boosters(spark), N.default_negations(spark)).collect()
    assert from_file == direct and [r.sentiment for r in direct] == ["positive", "negative", "neutral"]


def test_empty_file_and_tolerance(spark, tmp_path):
    (tmp_path / "empty.txt").write_text("")
    good, bad = L.read_lexicon(spark, str(tmp_path / "empty.txt"))
    assert not good.collect() and not bad.collect()
    df = spark.createDataFrame([("word\t1.0\t0.5\t[1, 2]",)], "line string")
    assert L.parse_lexicon(df)[0].count() == 0 and L.parse_lexicon(df, tolerance=0.5)[0].count() == 1


def test_phrase_files(spark, tmp_path):
    file = tmp_path / "phrases.tsv"
    file.write_text('kiss of death\tidiom\t-1.5\n\n"so" what\tflip\t0.5\n')
    rows = {tuple(r) for r in L.read_phrases(spark, str(file)).collect()}
    assert rows == {("kiss of death", "idiom", -1.5), ('"so" what', "flip", 0.5)}
    file.write_text("kiss of death\tidiom\tx\n")
    with pytest.raises(Exception):
        L.read_phrases(spark, str(file)).collect()


def test_lines_over_distinct_words_are_taken_apart_once(spark):
    words = spark.createDataFrame([("good\t1.9",), ("good\t1.9",), ("short",)], "line string").distinct()
    for part, rows in zip(L.parse_lexicon(words), (1, 1)):
        assert part.count() == rows
        plan = part._jdf.queryExecution().optimizedPlan().toString()
        # The distinct is below all the parsing, and the line is split in one place.
        assert plan.count("split(") == 1 and plan.index("split(") < plan.index("Aggregate")
