"""Phrases of several words in the scoring rules, found by an automaton over tokens.

The phrase table is the caller's. Its patterns become one automaton: the trie of all patterns, each
state also standing for every shorter pattern that ends in it, so that a step never looks back. A
state depends on the last tokens alone, no more than the longest pattern has, so a row walks the
automaton from the root over a short slice at each token, in parallel with nothing carried along.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

# What a phrase does to a lexicon word.
#   idiom   gives its own score to the words in it and to those right after it
#   degree  strengthens or weakens the words after it, as single degree words do
#   scale   stands in for the negation it begins with, and multiplies by its own factor
#   flip    multiplies the word right after it, unless a longer flip phrase says otherwise
#   mute    takes the word it begins with out of the sum
KINDS = ("idiom", "degree", "scale", "flip", "mute")
ANY = "*"
# Phrases of a table, and cells (states times different words) of its automaton.
MAX_PHRASES, MAX_CELLS = 2000, 1 << 21

# Phrases of the published rule set, with their values; * stands for any one word.
DEFAULT_PHRASES = [
    ("kind of", "degree", -0.293), ("sort of", "degree", -0.293), ("just enough", "degree", -0.293),
    ("kind of", "mute", 0.0),
    ("never so", "scale", 1.25), ("never this", "scale", 1.25),
    ("never * so", "scale", 1.25), ("never * this", "scale", 1.25),
    ("without doubt", "scale", 1.0), ("without * doubt", "scale", 1.0),
    ("least", "flip", -0.74), ("at least", "flip", 1.0), ("very least", "flip", 1.0),
    ("bad ass", "idiom", 1.5), ("yeah right", "idiom", -2.0), ("kiss of death", "idiom", -1.5),
    ("to die for", "idiom", 3.0), ("the bomb", "idiom", 3.0), ("bus stop", "idiom", 0.0),
    ("beating heart", "idiom", 3.1), ("broken heart", "idiom", -2.9),
]


@dataclass(frozen=True)
class Automaton:
    """``classes`` numbers the words of the patterns from 1; 0 is every other word. ``steps`` has
    the next state by state and class; ``ends`` has, per kind and length, the value of the pattern
    that ends in each state, or None."""

    classes: dict[str, int]
    steps: list[list[int]]
    ends: dict[tuple[str, int], list[float | None]]
    reach: int

    def lengths(self, kind: str) -> list[int]:
        """Lengths of the patterns of a kind, longest first."""
        return sorted((n for k, n in self.ends if k == kind), reverse=True)


def _checked(rows: Iterable[tuple[str, str, float]]) -> dict[tuple[str, tuple[str, ...]], float]:
    found: dict[tuple[str, tuple[str, ...]], float] = {}
    for phrase, kind, value in rows:
        words = tuple((phrase or "").lower().split())
        if kind not in KINDS:
            raise ValueError(f"{phrase!r}: kind must be one of {', '.join(KINDS)}, not {kind!r}")
        if not words or ANY in (words[0], words[-1]):
            raise ValueError(f"{phrase!r}: a phrase begins and ends with a word")
        if len(words) < 2 and kind in ("idiom", "degree"):
            raise ValueError(f"{phrase!r}: one word belongs into the lexicon or the degree words")
        if value is None:
            raise ValueError(f"{phrase!r}: a phrase needs a value")
        key = (kind, words)
        found[key] = max(found.get(key, float(value)), float(value))
    return found


def build(rows: Iterable[tuple[str, str, float]]) -> Automaton | None:
    """The automaton of a table of (phrase, kind, value); None without phrases.

    Words are compared in lower case. Of a phrase given twice for one kind the larger value counts.
    """
    patterns = _checked(rows)
    if not patterns:
        return None
    listed = sorted(patterns)
    words = sorted({w for _, phrase in listed for w in phrase if w != ANY})
    classes = {w: k + 1 for k, w in enumerate(words)}
    coded = [tuple(None if w == ANY else classes[w] for w in phrase) for _, phrase in listed]
    by_first: dict[int, list[int]] = {}
    for p, pattern in enumerate(coded):
        by_first.setdefault(pattern[0], []).append(p)

    def after(state: frozenset, c: int) -> frozenset:
        going = {(p, k + 1) for p, k in state if k < len(coded[p]) and coded[p][k] in (c, None)}
        return frozenset(going | {(p, 1) for p in by_first.get(c, ())})

    states, steps = {frozenset(): 0}, []
    waiting = [frozenset()]
    for state in waiting:
        row = []
        for c in range(len(words) + 1):
            following = after(state, c)
            if following not in states:
                states[following] = len(states)
                waiting.append(following)
                if len(states) * (len(words) + 1) > MAX_CELLS:
                    raise ValueError("the phrase table needs too large an automaton")
            row.append(states[following])
        steps.append(row)
    ends: dict[tuple[str, int], list[float | None]] = {}
    for state, number in states.items():
        for p, k in state:
            if k == len(coded[p]):
                kind = listed[p][0]
                column = ends.setdefault((kind, k), [None] * len(states))
                value = patterns[listed[p]]
                column[number] = value if column[number] is None else max(value, column[number])
    return Automaton(classes, steps, ends, max(map(len, coded)))


# The same in SQL, over ``low`` (words), ``marks`` (with ``part``, the class of a word), ``states``


def sql_states(automaton: Automaton, steps: str) -> str:
    """State after every token; an empty array for a text without any word of a phrase."""
    reach = automaton.reach
    walked = f"""transform(parts, (c, i) -> aggregate(
        slice(parts, greatest(i - {reach - 2}, 1), least({reach}, i + 1)), 0,
        (s, c) -> get(get({steps}, s), c)))"""
    known = f"if(exists(parts, c -> c > 0), {walked}, cast(array() as array<int>))"
    parts = "transform(marks, m -> coalesce(m.part, 0))"
    return f"get(transform(array({parts}), parts -> {known}), 0)"


def sql_ended(automaton: Automaton, kind: str, length: int, at: str) -> str:
    """Value of the pattern of a kind and length that ends at a place; NULL if none does."""
    values = automaton.ends.get((kind, length))
    if values is None:
        return "cast(null as double)"
    listed = ", ".join("null" if v is None else f"{v!r}D" for v in values)
    return f"get(array({listed}), get(states, {at}))"


def sql_first(options: list[str]) -> str:
    return f"coalesce({', '.join(options)})" if options else "cast(null as double)"


def sql_mute(automaton: Automaton) -> str:
    begins = [sql_ended(automaton, "mute", n, f"i + {n - 1}") for n in automaton.lengths("mute")]
    return f"{sql_first(begins)} is not null"


def sql_scale(automaton: Automaton, distance: int) -> str:
    """Factor of the scale phrase that begins ``distance`` words before and ends before the word."""
    lengths = [n for n in automaton.lengths("scale") if n <= distance]
    return sql_first([sql_ended(automaton, "scale", n, f"i - {distance - n + 1}") for n in lengths])


def sql_idiom(automaton: Automaton) -> str:
    """Score of the idiom around the word, the one that ends last and longest first, or else of one
    that ends one or two words before and begins within three."""
    lengths, options = automaton.lengths("idiom"), []
    for on in range(max(lengths, default=1) - 1, -1, -1):
        options += [sql_ended(automaton, "idiom", n, f"i + {on}") for n in lengths if n > on]
    for back in (1, 2):
        options += [sql_ended(automaton, "idiom", n, f"i - {back}") for n in lengths if n + back <= 4]
    return sql_first(options)


def sql_degree(automaton: Automaton) -> str:
    """Sum of the degree phrases that end one and two words before and begin within three."""
    sums = []
    for back in (1, 2):
        ended = [sql_ended(automaton, "degree", n, f"i - {back}") for n in automaton.lengths("degree")
                 if n + back <= 4]
        sums.append(f"coalesce({sql_first(ended)}, 0D)")
    return f"({' + '.join(sums)})"


def sql_flip(automaton: Automaton) -> str:
    """Factor of the longest flip phrase right before the word, whose last word is in no lexicon."""
    ended = [sql_ended(automaton, "flip", n, "i - 1") for n in automaton.lengths("flip")]
    factor = f"coalesce({sql_first(ended)}, 1D)"
    return f"if(get(marks, i - 1).valence is null, {factor}, 1D)"
