"""Lexicon-and-rules sentiment scoring of one text, as a row-local expression.

The score follows the published rule set of Hutto and Gilbert (ICWSM 2014). The lexicon is the
caller's table; every constant is a parameter.
"""

from __future__ import annotations

import string
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from newsflow.functions import phrases as P
from newsflow.functions.bind import apply_sql, sql_let, sql_lookup, sql_raw
from newsflow.functions.text import SPACE, or_empty

BUCKETS = 16384
# Compound scores at or beyond these bounds count as positive or negative.
POSITIVE_FROM = 0.05
NEGATIVE_UP_TO = -0.05

MARK_TYPE = "struct<valence:double,delta:double,negates:boolean>"

# Degree words that strengthen or weaken the word after them, and the step.
STEP = 0.293
INTENSIFIERS = """
absolutely amazingly awfully completely considerable considerably decidedly deeply effing enormous
enormously entirely especially exceptional exceptionally extreme extremely fabulously flipping
fully greatly hella highly hugely incredible incredibly intensely major majorly more most
particularly purely quite really remarkably so substantially thoroughly total totally tremendous
tremendously uber unbelievably unusually utter utterly very
""".split()
DAMPENERS = """
almost barely hardly kinda kindof less little marginal marginally occasional occasionally partly
scarce scarcely slight slightly somewhat sorta sortof
""".split()
# Negations, without apostrophes because cleaning removes those.
NEGATIONS = """
aint arent cannot cant couldnt darent didnt doesnt dont hadnt hasnt havent isnt mightnt mustnt
neither neednt never none nope nor not nothing nowhere oughtnt shant shouldnt uhuh wasnt werent
without wont wouldnt rarely seldom despite
""".split()
# A few words to try things out with; a real run supplies its own lexicon table.
SAMPLE_LEXICON = {
    "amazing": 2.8, "awful": -2.0, "bad": -2.5, "breach": -1.2, "breakthrough": 1.5,
    "crisis": -3.1, "criticism": -1.9, "disaster": -3.1, "excellent": 2.7, "fail": -2.5,
    "failure": -2.3, "fear": -2.2, "good": 1.9, "great": 3.1, "growth": 1.6, "happy": 2.7,
    "hate": -2.7, "improve": 1.9, "loss": -1.3, "love": 3.2, "progress": 1.8, "sad": -2.1,
    "severe": -1.6, "success": 2.7, "terrible": -2.1, "threat": -2.4, "war": -2.9, "win": 2.8,
}


@dataclass(frozen=True)
class Rules:
    """Constants of the context rules; ``context=False`` leaves the plain lexicon sum."""

    context: bool = True
    alpha: float = 15.0
    capitals: float = 0.733
    negation: float = -0.74
    distance_weights: tuple[float, ...] = (1.0, 0.95, 0.9)
    exclamation: float = 0.292
    exclamation_max: int = 4
    question: float = 0.18
    question_max_count: int = 3
    question_beyond: float = 0.96
    before_but: float = 0.5
    after_but: float = 1.5
    # With phrases: a word that negates the lexicon word after it, and the words it reaches over.
    denial: str = "no"
    denial_over: tuple[str, ...] = ("or", "nor")


_PUNCTUATION = "".join("\\" + mark for mark in string.punctuation)
_INNER = f"[^{SPACE}{_PUNCTUATION}]"
_SOLID = f"[^{SPACE}]"
# A token is its core from the first to the last character that is no punctuation mark; a core of
# one or two characters keeps the punctuation around it.
_TOKEN = (
    f"(?:^|[{SPACE}])(?:[{_PUNCTUATION}]*(?={_INNER}{_SOLID}+{_INNER}))?+"
    f"({_INNER}{_SOLID}+{_INNER}(?=[{_PUNCTUATION}]*+(?:[{SPACE}]|$))|{_SOLID}+)"
)


def split_tokens(text: Column) -> Column:
    """Blank-separated tokens without edge punctuation, unless that leaves two characters or less."""
    return F.regexp_extract_all(or_empty(text), F.lit(_TOKEN), F.lit(1))


def token_of() -> Callable[[str], str]:
    """The token of a run without white space, as :func:`split_tokens` gives it, in Python."""
    edge = string.punctuation

    def token(word: str) -> str:
        core = word.strip(edge)
        return core if len(core) > 2 else word

    return token


def _denied(rules: Rules) -> str:
    """SQL for the valence of a lexicon word with the word that denies the next one looked at."""

    def is_denial(at: str) -> str:
        return f"coalesce(get(low, {at}) = '{rules.denial}', false)"

    over = ", ".join(f"'{word}'" for word in rules.denial_over)
    before = f"""{is_denial('i - 1')} or {is_denial('i - 2')}
        or ({is_denial('i - 3')} and coalesce(get(low, i - 1) in ({over}), false))"""
    own = f"{is_denial('i')} and get(marks, i + 1).valence is not null"
    valence = "get(marks, i).valence"
    return f"case when {before} then {valence} * {rules.negation}D when {own} then 0D else {valence} end"


def _phrased(automaton: P.Automaton) -> str:
    """SQL for ``v`` after the phrases around its word."""
    pushed = f"v + if(v < 0, -1, 1) * {P.sql_degree(automaton)}"
    flipped = f"v * {P.sql_flip(automaton)}"
    return sql_let("v", f"coalesce({P.sql_idiom(automaton)}, v)", sql_let("v", pushed, flipped))


def _rule_values(rules: Rules, automaton: P.Automaton | None = None) -> str:
    """SQL for the adjusted valences of the lexicon words among ``row.tokens``."""

    def shouted(at: str) -> str:
        word = f"get(row.tokens, {at})"
        return f"(emphatic and {word} <> get(low, {at}) and {word} = upper({word}))"

    adjusted = _phrased(automaton) if automaton else "v"
    # The nearest word is applied first, so it becomes the innermost step.
    for distance, weight in reversed(list(enumerate(rules.distance_weights, start=1))):
        mark, at = f"get(marks, i - {distance})", f"i - {distance}"
        push = f"""if({mark}.delta is null, 0D, {weight}D * (if(v < 0, -1, 1) * {mark}.delta
            + if({shouted(at)}, if(v > 0, 1, -1) * {rules.capitals}D, 0D)))"""
        flips = f"""coalesce({mark}.negates, false)
            or coalesce(contains(get(low, {at}), 'n\\'t'), false)"""
        factor = f"if({flips}, {rules.negation}D, 1D)"
        if automaton:
            factor = f"coalesce({P.sql_scale(automaton, distance)}, {factor})"
        step = f"if({mark}.valence is not null, v, (v + {push}) * {factor})"
        adjusted = sql_let("v", step, adjusted)
    own = _denied(rules) if automaton else "get(marks, i).valence"
    start = sql_let("v", own, f"v + if({shouted('i')}, if(v > 0, 1, -1) * {rules.capitals}D, 0D)")
    around_but = f"""case when but = 0 or i = but - 1 then 1D
        when i < but - 1 then {rules.before_but}D else {rules.after_but}D end"""
    value = f"{sql_let('v', start, adjusted)} * {around_but}"
    if automaton:
        value = f"if({P.sql_mute(automaton)}, 0D, {value})"
    scored = f"""transform(filter(transform(row.tokens, (word, i) -> i),
        i -> get(marks, i).valence is not null and get(marks, i).delta is null), i -> {value})"""
    capitals = "size(filter(row.tokens, (word, i) -> word <> get(low, i) and word = upper(word)))"
    with_but = sql_let("but", "array_position(low, 'but')", scored)
    values = sql_let(
        "emphatic", f"{capitals} between 1 and size(row.tokens) - 1", with_but
    )
    return sql_let("states", P.sql_states(automaton, "row.steps"), values) if automaton else values


def _emphasis(rules: Rules) -> str:
    """SQL for the weight of the exclamation and question marks counted in ``row``."""
    exclamations, questions = "row.exclamations", "row.questions"
    return f"""(least({exclamations}, {rules.exclamation_max}) * {rules.exclamation}D
        + case when {questions} <= 1 then 0D
          when {questions} <= {rules.question_max_count} then {questions} * {rules.question}D
          else {rules.question_beyond}D end)"""


def _summary(rules: Rules, size: str = "size(row.tokens)") -> str:
    """SQL for the score struct from ``vals``, ``emphasis`` and the number of tokens."""

    def total(term: str) -> str:
        return f"aggregate(vals, 0D, (a, v) -> a + {term})"

    compound = f"bround(greatest(-1D, least(1D, s / sqrt(s * s + {rules.alpha}D))), 4)"
    pushed = "raw + sign(raw) * emphasis"
    neutral = f"({size} - size(filter(vals, v -> v <> 0)))"
    shares = sql_let(
        "share",
        "named_struct("
        "'up', if(raw.up > abs(raw.down), raw.up + emphasis, raw.up),"
        "'down', abs(if(raw.up < abs(raw.down), raw.down - emphasis, raw.down)),"
        f"'flat', {neutral})",
        sql_let(
            "whole",
            "share.up + share.down + share.flat",
            "named_struct('pos', bround(try_divide(share.up, whole), 3),"
            "'neg', bround(try_divide(share.down, whole), 3), 'neu', bround(try_divide(share.flat, whole), 3))",
        ),
    )
    sums = sql_let(
        "raw",
        f"named_struct('up', {total('if(v > 0, v + 1, 0D)')},"
        f"'down', {total('if(v < 0, v - 1, 0D)')})",
        shares,
    )
    overall = sql_let("raw", total("v"), sql_let("s", pushed, compound))
    return f"named_struct('compound', {overall}, 'shares', {sums})"


def _scorer_sql(rules: Rules, marks: str, automaton: P.Automaton | None = None) -> str:
    if rules.context:
        values, emphasis = _rule_values(rules, automaton), _emphasis(rules)
    else:
        values = "transform(filter(marks, m -> m.valence is not null), m -> m.valence)"
        emphasis = "0D"
    body = sql_let("vals", values, sql_let("emphasis", emphasis, _summary(rules)))
    body = sql_let("marks", marks, body)
    return "row -> " + sql_let("low", "transform(row.tokens, word -> lower(word))", body)


def mark_counts(text: Column) -> dict[str, Column]:
    """How many exclamation and question marks a text holds."""
    whole = or_empty(text)

    def count(mark: str) -> Column:
        return F.length(whole) - F.length(F.replace(whole, F.lit(mark), F.lit("")))

    return {"exclamations": count("!"), "questions": count("?")}


@dataclass(frozen=True)
class Phrases:
    """The automaton of a phrase table and a column with its steps (an array per state)."""

    automaton: P.Automaton
    steps: Column


def _score(rules: Rules, found: str, phrases: Phrases | None, **fields: Column) -> Column:
    if phrases and rules.context:
        fields["steps"] = phrases.steps
    row = F.struct(*(column.alias(name) for name, column in fields.items()))
    return apply_sql(row, _scorer_sql(rules, found, phrases.automaton if phrases else None))


def score_by_index(
    text: Column,
    index: Column,
    rules: Rules,
    phrases: Phrases | None = None,
    buckets: int = BUCKETS,
) -> Column:
    """``struct<compound, shares<pos, neg, neu>>`` of a text, in doubles.

    ``index`` is an ``array<map<token, mark>>`` spread over ``buckets``, searched per token.
    """
    found = f"transform(low, word -> {sql_lookup('row.index', 'word', buckets)})"
    return _score(
        rules, found, phrases, tokens=split_tokens(text), index=index, **mark_counts(text)
    )


def score_by_marks(
    text: Column, tokens: Column, marks: Column, rules: Rules, phrases: Phrases | None = None
) -> Column:
    """The same from the marks of a text's tokens, in their order (NULL where there is none)."""
    return _score(rules, "row.marks", phrases, tokens=tokens, marks=marks, **mark_counts(text))


def score_by_values(text: Column, size: Column, values: Column, rules: Rules) -> Column:
    """The same from the number of tokens and the values of :func:`value_finder`."""
    counts = {name: column.alias(name) for name, column in mark_counts(text).items()}
    row = F.struct(size.alias("size"), values.alias("vals"), *(counts.values() if rules.context else ()))
    emphasis = _emphasis(rules) if rules.context else "0D"
    body = sql_let("emphasis", emphasis, _summary(rules, "row.size"))
    return apply_sql(row, "row -> " + sql_let("vals", "row.vals", body))


def value_finder(rules: Rules) -> Callable:
    """The values of ``_rule_values`` (without phrases) for many texts at once, in the same steps.

    The function takes the marks of ``marks_said`` (operators), the number of each word's mark (-1: none) and
    where the words of each text end; it gives the values and where those of each text end.
    """
    context, capitals, negation = rules.context, rules.capitals, rules.negation
    weights, before_but, after_but = rules.distance_weights, rules.before_but, rules.after_but

    def values(marks: pa.StructArray, at: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        def of_words(name: str, none: float | bool) -> tuple[np.ndarray, np.ndarray]:
            given = marks.field(name)
            filled = given.fill_null(none).to_numpy(zero_copy_only=False)
            there = given.is_valid().to_numpy(zero_copy_only=False)
            # The last entry is that of words without a mark, whose number is -1.
            return np.append(filled, none)[at], np.append(there, False)[at]

        valence, known = of_words("valence", 0.0)
        if not context:
            return valence[known], np.append(0, np.cumsum(known))[ends]
        delta, degree = of_words("delta", 0.0)
        flips, shouts, turns = (of_words(c, False)[0].astype(bool) for c in ("flips", "shouts", "turns"))
        scored, sizes = np.flatnonzero(known & ~degree), np.diff(ends)
        text_of = np.repeat(np.arange(len(sizes)), sizes)
        loud = np.diff(np.append(0, np.cumsum(shouts))[ends])
        shouts &= ((loud >= 1) & (loud <= sizes - 1))[text_of]
        start = ends[text_of[scored]]

        def raised(v: np.ndarray, at: np.ndarray) -> np.ndarray:
            return np.where(shouts[at], np.where(v > 0, 1, -1) * capitals, 0.0)

        v = valence[scored]
        v = v + raised(v, scored)
        for distance, weight in enumerate(weights, start=1):
            inside = scored - distance >= start
            near = np.where(inside, scored - distance, 0)
            push = weight * (np.where(v < 0, -1, 1) * delta[near] + raised(v, near))
            moved = (v + np.where(degree[near], push, 0.0)) * np.where(flips[near], negation, 1.0)
            v = np.where(inside & ~known[near], moved, v)
        turn, places = np.full(len(sizes), -1), np.flatnonzero(turns)[::-1]
        # The first of a text is written last.
        turn[text_of[places]] = places
        turn = turn[text_of[scored]]
        around = np.where(scored < turn, before_but, after_but)
        v = v * np.where((turn < 0) | (scored == turn), 1.0, around)
        return v, np.searchsorted(scored, ends)

    return values


def classify(compound: Column) -> Column:
    """Three-way label of a compound score (taken before the score is narrowed to 32 bits)."""
    return (
        F.when(compound >= POSITIVE_FROM, "positive")
        .when(compound <= NEGATIVE_UP_TO, "negative")
        .otherwise("neutral")
    )


def sentiment_columns(blank: Column, score: Column) -> dict[str, Column]:
    """Label and 32-bit scores; a blank text is neutral with all its weight on ``neu``."""
    compound = F.when(blank, 0.0).otherwise(score["compound"])
    return {
        "sentiment": classify(compound),
        "sentiment_compound": compound.cast("float"),
        "sentiment_pos": F.when(blank, 0.0).otherwise(score["shares"]["pos"]).cast("float"),
        "sentiment_neg": F.when(blank, 0.0).otherwise(score["shares"]["neg"]).cast("float"),
        "sentiment_neu": F.when(blank, 1.0).otherwise(score["shares"]["neu"]).cast("float"),
    }
