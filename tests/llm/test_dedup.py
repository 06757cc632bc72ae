import hashlib
import re
from collections import defaultdict

from newsflow.llm import dedup

SCHEMA = "doc_id long, text string, digest string, row long, kept string"


def brute(rows):
    groups = defaultdict(list)
    for doc_id, text in rows:
        plain = re.sub(r"[\x20\x09-\x0D]+", " ", text or "")
        groups[hashlib.sha256(plain.encode()).hexdigest()].append(doc_id)
    out = []
    for digest, ids in groups.items():
        known = sorted(i for i in ids if i is not None)
        keep = known[0] if known else None
        left = True
        for i in sorted(ids, key=lambda i: (i is None, i or 0)):
            out.append((i, keep, len(ids), left and i == keep, digest))
            left = left and i != keep
    return sorted(out, key=repr)


def result(df):
    return sorted(map(tuple, df.collect()), key=repr)


ROWS = [
    (5, "a  b"), (3, "a\tb"), (9, "a b"), (4, " a b"), (7, None), (6, ""), (8, "A b"),
    (2, "\x0b"), (1, " "), (10, "a\xa0b"), (11, "a b"), (11, "a b"), (None, "a b"), (None, "zz"),
    (3, "a b"), (12, "x" * 300_000), (13, "x" * 300_000),
]


def test_groups_equal_brute_force_and_ignore_clashing_columns(frame):
    df = frame([(*r, "d", 1, "k") for r in ROWS], SCHEMA)
    assert result(dedup.exact_groups(df)) == brute(ROWS)


def test_a_hot_text_is_settled_by_the_broadcast_winners(frame):
    rows = [(i, "hot" if i % 3 == 0 else f"text {i}") for i in range(3000, 0, -1)]
    df = frame(rows, "doc_id long, text string", 8)
    assert result(dedup.exact_groups(df)) == brute(rows)
    prints = df.select(dedup.digest(df["text"]).alias("digest"))
    named = [r.digest for r in dedup.frequent_digests(prints, 64, 4).collect()]
    assert hashlib.sha256(b"hot").hexdigest() in named and len(named) <= 4


def test_kept_rows_carry_all_columns_once(frame):
    df = frame([(*r, "d", 1, "k") for r in ROWS], SCHEMA)
    kept = dedup.drop_exact_copies(df)
    assert kept.schema == df.schema
    expected = sorted((r[0], r[4]) for r in brute(ROWS) if r[3] and r[0] is not None)
    found = [(r.doc_id, r.text) for r in kept.collect()]
    digests = sorted((i, hashlib.sha256(re.sub(r"[\x20\x09-\x0D]+", " ", t or "").encode())
                      .hexdigest()) for i, t in found if i is not None)
    assert digests == expected
    assert [t for i, t in found if i is None] == ["zz"]


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert dedup.exact_groups(df).collect() == []
    assert dedup.drop_exact_copies(df).collect() == []
