import numpy as np
import pytest

from newsflow.llm import mixing as M

PATH = "/root/testdata/sf0.01/documents.parquet"
SCHEMA = "doc_id long, text string, source string, lang string, rate string, posterior int"


def test_equal_shares_over_the_whole_table(spark, documents):
    rated, mixture = M.fit_rates(spark.read.parquet(PATH))
    rows = {r.doc_id: r for r in rated.collect()}
    assert len(rows) == len(documents)
    assert {r["doc_id"]: len(r["text"].split()) for r in documents} == {
        i: r.tokens for i, r in rows.items()
    }
    assert mixture.reached == pytest.approx(mixture.targets, rel=1e-3)
    assert mixture.tokens.sum() == pytest.approx(sum(r.tokens for r in rows.values()))
    assert all(r.rate >= 0 and r.copies in (int(r.rate), int(r.rate) + 1) for r in rows.values())
    drawn = {s: sum(rows[r["doc_id"]].copies * rows[r["doc_id"]].tokens for r in documents
                    if r["source"] == s) for s in mixture.classifier.domains}
    share = np.array(list(drawn.values())) / sum(drawn.values())
    assert share == pytest.approx(np.full(len(share), 1 / len(share)), abs=0.02)


def sample(n=300):
    """Two sources of different words, three quarters of one; some rows name no source."""
    rows = []
    for i in range(n):
        a = i % 4 > 0
        words = "alpha beta gamma delta" if a else "one two three four"
        rows.append((i, f"{words} " * (1 + i % 5), None if i % 7 == 0 else "a" if a else "b", "x"))
    return rows


def fitted(frame, rows, **options):
    df = frame([(*r, "r", 1) for r in rows], SCHEMA)
    at = M.Columns(metadata=())
    return df, *M.fit_rates(df, at=at, **options)


def test_rows_without_a_domain_belong_where_their_words_do(frame):
    rows = sample()
    _, rated, mixture = fitted(frame, rows, weights={"a": 1.0, "b": 3.0})
    rate = {r.doc_id: r.rate for r in rated.collect()}
    assert mixture.classifier.domains == ["a", "b"]
    assert mixture.reached[1] == pytest.approx(3 * mixture.reached[0], rel=1e-3)
    assert rate[7] == pytest.approx(rate[3], rel=0.05) and rate[28] == pytest.approx(rate[4], rel=0.05)
    assert rate[4] > 2 > 1 > rate[3]


def test_a_domain_without_weight_gets_rate_zero(frame):
    _, rated, mixture = fitted(frame, sample(), weights={"b": 1.0})
    assert min(r.rate for r in rated.collect()) == pytest.approx(0.0, abs=1e-2)
    assert mixture.reached[0] < 0.02 * mixture.reached[1]


def test_least_squares_by_another_way(spark):
    """The same fit for given memberships by plain projected gradients with small steps."""
    rng = np.random.default_rng(2)
    posterior, tokens = rng.dirichlet([0.4] * 3, 200), rng.integers(1, 60, 200).astype(float)
    targets = np.array([0.7, 0.2, 0.1]) * tokens.sum()
    rates = np.ones(200)
    scale = np.linalg.norm(posterior.T @ (posterior * tokens[:, None]), 2)
    for _ in range(5000):
        rates = np.clip(rates - posterior @ (posterior.T @ (tokens * rates) - targets) / scale, 0, None)
    cross = posterior.T @ (posterior * tokens[:, None])
    moves, ahead = [], posterior.T @ tokens
    for _ in range(M.STEPS):
        moves.append(np.linalg.pinv(cross) @ (ahead - targets))
        reached, ahead = (
            posterior.T @ (tokens * r) for r in M._rates(posterior, moves, 1.0, 0.0, np.inf)
        )
    assert posterior.T @ (tokens * rates) == pytest.approx(targets, rel=1e-2)
    assert reached == pytest.approx(targets, rel=1e-2)


def test_mix_repeats_rows_and_loses_none(frame):
    rows = sample()
    df = frame([(*r, "r", 1) for r in rows], SCHEMA)
    mixed = M.mix(df, temper=0.0, low=1.0, raise_only=True)
    assert mixed.schema == df.schema
    found = [r.doc_id for r in mixed.collect()]
    assert set(found) == {r[0] for r in rows} and len(found) > len(rows)


def test_odd_rows(frame, spark):
    long = "alpha " * 100_000
    rows = [*sample(40), (100, None, "a", None), (101, "", None, "x"), (102, long, "a", "x"),
            (102, long, "a", "x"), (None, "one two", "b", "x")]
    _, rated, _ = fitted(frame, rows)
    found = rated.collect()
    assert len(found) == len(rows) and {r.tokens for r in found if r.doc_id in (100, 101)} == {0}
    one = [(i, "word " * i, "a", "x") for i in range(5)]
    _, rated, mixture = fitted(frame, one)
    assert {r.rate for r in rated.collect()} == {1.0} and mixture.classifier.domains == ["a"]
    _, rated, mixture = fitted(frame, [(1, "x", None, None)])
    assert [(r.rate, r.copies) for r in rated.collect()] == [(1.0, 1)]
    empty = spark.createDataFrame([], SCHEMA)
    assert M.fit_rates(empty)[0].collect() == [] and M.mix(empty).collect() == []


def test_a_rare_source_reaches_its_target_from_a_small_sample(frame):
    rng = np.random.default_rng(4)
    rows = []
    for i in range(8000):
        source = "rare" if i % 400 == 0 else "b" if i % 3 == 0 else "a"
        first = {"a": 0, "b": 100, "rare": 200}[source]
        words = rng.integers(first, first + 200, rng.integers(5, 40))
        rows.append((i, " ".join(f"w{k}" for k in words), source, "x"))
    df = frame([(*r, "r", 1) for r in rows], SCHEMA)
    rated, mixture = M.fit_rates(df, sample=300)
    assert mixture.classifier.domains == ["a", "b", "rare"]
    assert mixture.reached == pytest.approx(mixture.targets, rel=1e-2)
    drawn = dict.fromkeys(mixture.classifier.domains, 0.0)
    for r in rated.collect():
        drawn[rows[r.doc_id][2]] += r.rate * r.tokens
    assert np.array(list(drawn.values())) == pytest.approx(mixture.targets, rel=0.1)


def test_shares_of_the_sample():
    assert M._shares([5000, 5000], 10_000) == [1.0, 1.0]
    assert M._shares([10**7, 1000, 10], 10_000) == [8990 / 10**7, 1.0, 1.0]
    assert M._shares([10**6] * 200, 10_000) == [M.FLOOR / 10**6] * 200
