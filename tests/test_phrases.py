import itertools
import math
import random
from collections import Counter

import pytest

from newsflow.functions import phrases as P
from newsflow.operators import sentiment as N
from newsflow.plans import adapters as A
from newsflow.schemas import LEXICON, PHRASES

LEX = {"good": 1.9, "bad": -2.5, "kind": 2.4, "no": -1.2, "great": 3.1, "death": -2.9, "kiss": 1.8,
       "heart": 3.2, "doubt": -1.5, "ass": -2.5}


def compound(s):
    return round(s / math.sqrt(s * s + 15), 4)


# Worked out by hand: the rule, then its bounds.
CASES = {
    "never so good": (1.9 + 0.293) * 1.25,
    "never this bad": -2.5 * 1.25,
    "never has so good": (1.9 + 0.293) * 1.25,
    "never one two good": 1.9 * -0.74,
    "so good": 1.9 + 0.293,
    "without doubt good": -1.5 * -0.74 + 1.9,  # the doubt itself is negated, the good word is not
    "without any doubt good": -1.5 * -0.74 + 1.9,
    "without good": 1.9 * -0.74,
    "least good": 1.9 * -0.74,
    "at least good": 1.9,
    "very least good": 1.9 + 0.293 * 0.95,
    "the least good": 1.9 * -0.74,
    "kind of good": 1.9 - 0.293,
    "kind of bad": -2.5 + 0.293,
    "sort of very good": 1.9 + 0.293 - 0.293,
    "kind heart": 2.4 + 3.2,
    "a kind of day": 0.0,
    "broken heart": -2.9,
    "a beating heart": 3.1,
    "kiss of death": -1.5 * 2,
    "bad ass day": 1.5 * 2,
    "yeah right good": -2.0,
    "yeah right one good": -2.0,
    "yeah right one two good": 1.9,
    "no good": 0.0 + 1.9 * -0.74,
    "no really good": -1.2 + (1.9 * -0.74 - 0.293),
    "no day or good": -1.2 + 1.9 * -0.74,
    "no": -1.2,
    "day no": -1.2,
}


def scored(spark, texts, phrases, lookup="auto", lexicon=LEX):
    marks = N.token_marks(
        spark.createDataFrame(list(lexicon.items()), LEXICON), N.default_boosters(spark), N.default_negations(spark)
    )
    df = spark.createDataFrame(list(enumerate(texts)), "i int, full_text string")
    return N.score_with_marks(df, marks, lookup=lookup, phrases=phrases).orderBy("i").collect()


@pytest.mark.parametrize("lookup", ["index", "join"])
def test_rules_worked_out_by_hand(spark, lookup):
    rows = scored(spark, list(CASES), N.default_phrases(spark), lookup)
    for row, value in zip(rows, CASES.values(), strict=True):
        assert row["sentiment_compound"] == pytest.approx(compound(value), abs=1e-6), row["full_text"]


def test_without_phrases_nothing_changes(spark):
    texts = ["never so good", "least good", "kind of good", "no good"]
    rows = scored(spark, texts, None)
    values = [(1.9 + 0.293) * -0.74, 1.9, 2.4 + 1.9, -1.2 + 1.9]
    for row, value in zip(rows, values):
        assert row["sentiment_compound"] == pytest.approx(compound(value), abs=1e-6)


def matches(automaton, words):
    """Kinds, lengths and values that end at each word, by walking from the root all along."""
    state, out = 0, []
    for w in words:
        state = automaton.steps[state][automaton.classes.get(w, 0)]
        out.append({(k, n): v[state] for (k, n), v in automaton.ends.items() if v[state] is not None})
    return out


def test_automaton_finds_what_looking_at_every_place_finds():
    rng = random.Random(1)
    for _ in range(200):
        table = {}
        for _ in range(rng.randrange(1, 8)):
            words = [rng.choice("abc") for _ in range(rng.randrange(2, 5))]
            if len(words) > 2 and rng.random() < 0.4:
                words[rng.randrange(1, len(words) - 1)] = "*"
            table[(" ".join(words), rng.choice(["idiom", "scale"]))] = float(rng.randrange(9))
        automaton = P.build([(p, k, v) for (p, k), v in table.items()])
        text = [rng.choice("abcd") for _ in range(30)]
        expected = [{} for _ in text]
        for ((phrase, kind), value), at in itertools.product(table.items(), range(len(text))):
            words = phrase.split()
            part = text[at : at + len(words)]
            if len(part) == len(words) and all(w in ("*", x) for w, x in zip(words, part)):
                end = expected[at + len(words) - 1]
                end[kind, len(words)] = max(value, end.get((kind, len(words)), value))
        assert matches(automaton, text) == expected
        # The last words alone lead to the same state.
        for at in range(len(text)):
            near = text[max(0, at + 1 - automaton.reach) : at + 1]
            assert matches(automaton, near)[-1] == expected[at]


def test_both_look_ups_agree_on_random_texts(spark):
    rng = random.Random(2)
    words = ["good", "BAD", "kind", "of", "never", "so", "this", "at", "least", "very", "no", "or", "but", "heart",
             "broken", "without", "doubt", "day", "yeah", "right", "not", "Sort", "to", "die", "for", "great"]
    texts = [" ".join(rng.choices(words, k=rng.randrange(25))) + rng.choice(["", "!", "??"]) for _ in range(400)]
    phrases = N.default_phrases(spark)
    assert scored(spark, texts, phrases, "index") == scored(spark, texts, phrases, "join")


@pytest.mark.parametrize("row", [
    ("a b", "other", 1.0), ("", "idiom", 1.0), ("* a", "flip", 1.0), ("a *", "flip", 1.0), ("a", "idiom", 1.0),
    ("a", "degree", 1.0), ("a b", "scale", None), (None, "flip", 1.0),
])
def test_odd_phrases_are_refused(row):
    with pytest.raises(ValueError):
        P.build([row])


def test_tables_of_any_case_repeated_and_empty(spark, monkeypatch):
    rows = [("Broken  HEART", "idiom", -1.0), ("broken heart", "idiom", -2.0)]
    found = scored(spark, ["broken heart"], spark.createDataFrame(rows, PHRASES))
    assert found[0]["sentiment_compound"] == pytest.approx(compound(-1.0), abs=1e-6)
    none = scored(spark, ["broken heart"], spark.createDataFrame([], PHRASES))
    assert none[0]["sentiment_compound"] == pytest.approx(compound(3.2), abs=1e-6)
    monkeypatch.setattr(P, "MAX_PHRASES", 1)
    with pytest.raises(ValueError):
        scored(spark, ["x"], spark.createDataFrame(rows, PHRASES))
    monkeypatch.setattr(P, "MAX_CELLS", 3)
    with pytest.raises(ValueError):
        P.build(rows)


def _runs_one_by_one(rows, n):
    return Counter(" ".join(r[k : k + n]) for r in rows for k in range(len(r) - n + 1))


@pytest.mark.parametrize("bound, most", [(300, 20_000), (4, 20_000), (4, 5)])
def test_common_runs_are_counted_exactly(spark, monkeypatch, bound, most):
    monkeypatch.setattr(A, "BOUND_WORDS", bound)
    monkeypatch.setattr(A, "MAX_WORDS", most)
    rng = random.Random(3)
    words = ["it's", "back\\slash", *"abcdefghijklmnop"]
    rows = [rng.choices(words, weights=range(18, 0, -1), k=rng.randrange(40)) for _ in range(60)]
    rows += [["p", "o", "n"]] * 30 + [[], ["q"]]
    listed = spark.createDataFrame([(r,) for r in rows], "words array<string>")
    one = spark.createDataFrame(list(_runs_one_by_one(rows, 1).items()), "phrase string, count long")
    for n in (2, 3):
        found = {r.phrase: r["count"] for r in A._common_runs(listed, one, n, 10).collect()}
        expected = _runs_one_by_one(rows, n)
        last = sorted(expected.values())[-10]
        assert {p: c for p, c in found.items() if c >= last} == {p: c for p, c in expected.items() if c >= last}
    assert not A._common_runs(listed.limit(0), one.limit(0), 2, 10).collect()


def test_rare_words_make_no_runs(spark):
    rows = [(["a", "b", "a", "b", f"rare{k}"],) for k in range(400)]
    listed = spark.createDataFrame(rows, "words array<string>")
    one = spark.createDataFrame([("a", 800), ("b", 800)] + [(f"rare{k}", 1) for k in range(400)], "phrase string, count long")
    assert {r.phrase: r["count"] for r in A._common_runs(listed, one, 2, 1).collect() if r["count"] > 1} == {
        "a b": 800, "b a": 400,
    }
    assert A._run_counts(listed, 2, ["a", "b"]).count() == 2
