import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from newsflow.llm import collocations as C

SCHEMA = "lang string, text string, phrase string, n long, w1 string"


def brute(rows, least=10, top=2000):
    counts, n = {}, Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for size in (1, 2, 3):
                for k in range(len(words) - size + 1):
                    counts.setdefault(lang, Counter())[tuple(words[k : k + size])] += 1
    out = []
    for lang, found in counts.items():
        candidates = {p: a for p, a in found.items() if len(p) > 1 and a >= least}
        scored = []
        for p, a in candidates.items():
            if any(100 * b >= 50 * a and p in (q[:2], q[1:]) for q, b in candidates.items() if len(q) > len(p)):
                continue
            cuts = [(10**6 * a * a // (found[p[:k]] * found[p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            scored.append((-score, -a, " ".join(p).encode(), found[p[:k]], found[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(scored)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n[lang], -score))
    return sorted(out)


def result(df, **settings):
    found = C.collocations(df, **settings)
    assert found.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    return sorted(map(tuple, found.collect()))


def sample(rng, n, alphabet="abcdefgh"):
    rows = [("en", None), ("en", ""), (None, None), ("fr", " \t.,;\n"), ("en", "A b C " * 3000), ("x", "é ö. " * 20),
            ("x", "日本\xa0x y " * 15), ("de", "one")]
    for _ in range(n):
        words = [rng.choice(alphabet) * rng.choice([1, 1, 2]) for _ in range(rng.randrange(60))]
        text = "".join(w + rng.choice([" ", " ", " ", "  ", "\t", ", ", ".\n", "\r"]) for w in words)
        rows.append((rng.choice(["en", "en", "en", "fr", None]), text))
    return rows + [rows[-1]] * 4


@pytest.mark.parametrize("budget", [C.BUDGET, 50])
def test_equals_brute_force(frame, budget):
    rows = sample(random.Random(3), 300)
    df = frame([(*r, "p", 1, "w") for r in rows], SCHEMA)
    expected = brute(rows)
    assert result(df, budget=budget) == expected and len(expected) > 150
    assert result(df, top=5) == brute(rows, top=5)


def test_whole_table(spark, documents):
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    assert result(df) == brute([(r["lang"], r["text"]) for r in documents])


def test_scores_are_exact_beyond_64_bits(spark):
    from pyspark.sql import functions as F

    cases = [(10**13 + 7, 10**13 + 9, 10**13 + 7), (3, 7, 5), (10, 10, 10), (10**12 - 1, 10**13, 10**12)]
    df = spark.createDataFrame(cases, "a long, l long, r long")
    found = df.select("a", "l", "r", C._score(F.col("a"), F.col("l"), F.col("r")).alias("s")).collect()
    assert all(r.s == 10**6 * r.a * r.a // (r.l * r.r) for r in found)


def test_prefixes_are_extended_where_they_are_frequent(spark):
    block = C.Block([{"lang": "en", "text": b"the a. the b, the a the"}, {"lang": "fr", "text": b"the a"}])
    words = pa.table({"lang": ["en", "zz"], "w1": ["the", "a"]})
    assert C._flags(block, words, 1).tolist() == [True, False, True, False, True, False, True, False, False]
    pairs = pa.table({"lang": ["en"], "w1": ["the"], "w2": ["a"]})
    assert np.flatnonzero(C._flags(block, pairs, 2)).tolist() == [0, 4]


def test_many_distinct_words_are_numbered_in_steps(monkeypatch):
    block = C.Block([{"lang": "l", "text": b"a b c d. a b c, b c"}])
    expected = [x.tolist() for x in block.distinct_suffixes(3)]

    class Many(list):
        def __len__(self):
            return 1 << 40

    block.distinct = Many()
    found = block.distinct_suffixes(3)
    assert sorted(found[1].tolist()) == sorted(expected[1]) and len(found[0]) == len(expected[0])


def test_empty_table(spark):
    assert C.collocations(spark.createDataFrame([], SCHEMA)).collect() == []
