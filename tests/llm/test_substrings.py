import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from newsflow.llm import substrings as S
from newsflow.llm import word_blocks as B

SCHEMA = "doc_id long, text string, rank string, tie int, spans string"


def brute(rows, window=13):
    """doc_id, n_words, n_removed and the kept text of every row."""
    last = 1 << 63
    words = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t in rows]
    least = {}
    for (i, _), w in zip(rows, words):
        for k in range(len(w) - window + 1):
            key = tuple(w[k : k + window])
            least[key] = min(least.get(key, last), last if i is None else i)
    out = []
    for (i, _), w in zip(rows, words):
        gone = set()
        for k in range(len(w) - window + 1):
            if least[tuple(w[k : k + window])] < (last if i is None else i):
                gone.update(range(k, k + window))
        out.append((i, len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone)))
    return sorted(out, key=repr)


def result(df, **settings):
    found = S.remove_repeats(df, **settings)
    assert found.columns == ["doc_id", "n_words", "n_removed", "text"]
    return sorted(map(tuple, found.collect()), key=repr)


def sample(rng, n):
    vocabulary = [f"w{k}" for k in range(300)] + ["é", "日本", "X", "x,"]
    passages = [[rng.choice(vocabulary) for _ in range(rng.choice([12, 13, 14, 60]))] for _ in range(6)]
    rows = [(1, None), (2, ""), (3, " \n\t"), (4, "a " * 5000), (4, "a " * 40), (5, "a\x0bb " * 30), (6, "b a " * 30)]
    for k in range(n):
        words = [rng.choice(vocabulary) for _ in range(rng.randrange(40))]
        if rng.random() < 0.6:  # one passage in over half of all rows
            words += passages[0 if rng.random() < 0.6 else rng.randrange(6)]
            words += [rng.choice(vocabulary) for _ in range(rng.randrange(40))]
        rows.append((10 + rng.randrange(n), rng.choice([" ", "\n", "  "]).join(words)))
    rows += [rows[-1]] * 5 + [(None, rows[-1][1]), (None, rows[-1][1]), (None, "only here " * 9)]
    return rows


def as_frame(frame, rows):
    return frame([(*r, "x", 1, "y") for r in rows], SCHEMA)


@pytest.mark.parametrize("heavy", [0, 1 << 16])
def test_equals_brute_force(frame, monkeypatch, heavy):
    monkeypatch.setattr(S, "HEAVY", heavy)  # 0: whatever has twice its share is dealt out singly
    rows = sample(random.Random(5), 400)
    assert result(as_frame(frame, rows)) == brute(rows)


def test_small_blocks_and_other_windows(frame, monkeypatch):
    rows = sample(random.Random(6), 150)
    expected = brute(rows, 5)
    assert result(as_frame(frame, rows), window=5, gram=2) == expected
    assert result(as_frame(frame, rows), window=5, gram=5) == expected


def test_whole_table(spark, documents):
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    assert result(df) == brute([(r["doc_id"], r["text"]) for r in documents])


def test_words_decide_where_hashes_collide(monkeypatch):
    rng = np.random.default_rng(1)
    strings = [" ".join(f"v{x}" for x in rng.integers(0, 2, 8)) + " " for _ in range(200)]
    sizes, ranks = np.full(200, 6), rng.integers(0, 50, 200)
    expected = [x.tolist() for x in S.repeats([s.encode() for s in strings], ranks, sizes, 3)]
    monkeypatch.setattr(B, "mixed", lambda v: v % np.uint64(3))
    found = [x.tolist() for x in S.repeats([s.encode() for s in strings], ranks, sizes, 3)]
    assert found == expected and len(found[0])


def test_blocks_cover_all_rows(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(B, "BLOCK", 10)
    batch = pa.RecordBatch.from_pydict({"text": [b"aaaa", b"bbbb", b"c" * 30, b"", b"dddd", b"eeee", b"f"]})
    runs = list(B.blocks([batch, batch.slice(0, 0), batch]))
    assert [r["text"] for run in runs for r in run] == batch["text"].to_pylist() * 2
    assert all(len(run) == 1 or sum(len(r["text"]) for r in run) <= 10 for run in runs)


def test_empty_table(spark):
    assert S.remove_repeats(spark.createDataFrame([], SCHEMA)).collect() == []


def test_strings_of_a_block_go_off_once(spark, frame):
    passage = " ".join(f"p{k}" for k in range(200))
    rows = spark.range(3000).select(F.col("id").alias("doc_id"), F.lit(passage).alias("text")).coalesce(1)
    keyed = S._keyed(rows, "doc_id", "text").drop("doc_id")
    packed = keyed.mapInArrow(S._packer(13, 3, 8, np.zeros(256, dtype=bool)), S.PACKED)
    sent = packed.where("words IS NOT NULL").select(F.sum(F.size("sizes")), F.max(F.size("ranks"))).first()
    assert sent[0] < 100 and sent[1] == 1
    assert hashlib.sha256(S.remove_repeats(rows).where("doc_id = 0").first().text.encode()).hexdigest() == (
        hashlib.sha256(passage.encode()).hexdigest()
    )
    assert S.remove_repeats(rows).where("doc_id > 0 AND n_removed < 200").count() == 0
