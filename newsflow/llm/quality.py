"""Quality of documents without labels: weak labellers, a label model and a hashed linear scorer.

Heuristic labellers vote good or bad on every text or abstain. Expectation-maximisation over the
counts of their vote patterns, of which there are at most ``3 ** 8``, estimates how often each
labeller votes what on good and on bad texts; that gives each pattern a posterior. A logistic
regression on hashed word shapes is fitted to the posteriors of a sample and scores all texts.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF, Normalizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsflow.operators.scratch import written

# Texts the scorer is fitted to (expected number), hash buckets, rounds of fitting.
SAMPLE, SAMPLE_PARTS, BUCKETS, ROUNDS = 20_000, 8, 4096, 60
KEEP_FROM = 0.5
ABSTAIN, GOOD, BAD = 0, 1, 2


def shapes(text: Column) -> Column:
    """The words of a text as shapes, joined by single spaces: a word that its successor repeats is
    ``=``, runs of capitals are ``A``, of other letters ``a``, of digits ``9``."""
    plain = F.trim(F.regexp_replace(F.coalesce(text.cast("string"), F.lit("")), r"\s+", " "))
    once = F.regexp_replace(plain, r"(?<!\S)(\S++)(?= \1(?!\S))", "=")
    for run, sign in ((r"\p{Lu}+", "A"), (r"[\p{L}&&[^A]]+", "a"), (r"\p{N}+", "9")):
        once = F.regexp_replace(once, run, sign)
    return once


def _share(shape: Column, pattern: str) -> Column:
    return F.regexp_count(shape, F.lit(pattern)) / F.greatest(_words(shape), F.lit(1))


def _words(shape: Column) -> Column:
    return F.regexp_count(shape, F.lit(r"\S+"))


def _vote(bad: Column, good: Column | None = None) -> Column:
    vote = F.when(bad, BAD)
    return (vote if good is None else vote.when(good, GOOD)).otherwise(ABSTAIN)


def labellers(shape: Column) -> dict[str, Column]:
    """Votes on a text by its shapes."""
    plain = _share(shape, r"(?<!\S)[(\"'¿¡«]?A?a?(?:['’-]a+)?[)\"'»]?[.,;:!?]?[)\"'»]?(?!\S)")
    ends = _share(shape, r"[^.!?\s][.!?][)\"'»]?(?!\S)")
    words = _words(shape)
    return {
        "symbols": _vote(_share(shape, r"[#$%&*@^~+]{2,}") > 0.15),
        "shouting": _vote(_share(shape, r"(?<!\S)A(?![a9])") > 0.3),
        "exclaiming": _vote(_share(shape, r"!{2,}") > 0.15),
        "table": _vote(_share(shape, r"(?<!\S)[|;\t](?!\S)") > 0.15),
        "repeating": _vote(_share(shape, r"(?<!\S)=(?!\S)") > 0.2),
        "plain": _vote(plain < 0.65, plain > 0.9),
        "sentences": _vote((words > 50) & ((ends < 0.01) | (ends > 0.5)),
                           (ends >= 0.02) & (ends <= 0.35)),
        "length": _vote(words == 0, words >= 40),
    }


def vote_pattern(shape: Column) -> Column:
    """The votes as one number, a base-three digit per labeller."""
    votes = labellers(shape).values()
    return sum((v * 3**k for k, v in enumerate(votes)), F.lit(0)).cast("int")


@dataclass(frozen=True)
class LabelModel:
    """Share of good texts, vote probabilities (class, labeller, vote) and pattern posteriors."""

    prior: float
    votes: np.ndarray
    posterior: dict[int, float]


def label_model(counts: dict[int, int], labels: int, rounds: int = 200) -> LabelModel:
    """Expectation-maximisation over pattern counts; the first guess is a vote among labellers."""
    patterns = np.array(sorted(counts), dtype=np.int64)
    weight = np.array([counts[p] for p in patterns.tolist()], dtype=float)
    digits = patterns[:, None] // 3 ** np.arange(labels) % 3
    votes = np.eye(3)[digits]
    good, bad = (digits == GOOD).sum(axis=1), (digits == BAD).sum(axis=1)
    belief = (good + 1) / (good + 2 * bad + 2)
    prior, chances = 0.5, np.full((2, labels, 3), 1 / 3)
    for _ in range(rounds):
        mass = np.stack([weight * belief, weight * (1 - belief)])
        prior = (mass[0].sum() + 1) / (mass.sum() + 2)
        chances = np.einsum("cp,plv->clv", mass, votes) + 0.1
        chances /= chances.sum(axis=2, keepdims=True)
        logs = np.einsum("plv,clv->cp", votes, np.log(chances))
        odds = np.log(prior / (1 - prior)) + logs[0] - logs[1]
        after = 1 / (1 + np.exp(-np.clip(odds, -50, 50)))
        if np.abs(after - belief).max(initial=0.0) < 1e-6:
            break
        belief = after
    return LabelModel(float(prior), chances, dict(zip(patterns.tolist(), belief.tolist())))


@dataclass(frozen=True)
class QualityModel:
    labels: LabelModel
    scorer: PipelineModel | None


def _features(docs: DataFrame, text_col: str) -> DataFrame:
    shape = shapes(F.col(text_col))
    return docs.withColumn("shape", shape).withColumn("tokens", F.split("shape", " "))


def learn(
    docs: DataFrame, sample: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text"
) -> QualityModel:
    """Fit label model and scorer to unlabelled documents.

    The label model uses the vote patterns of all rows. The scorer is fitted to about ``sample``
    rows chosen by the hash of their id, each as a good and as a bad example weighted by its
    posterior. Without rows, or where all posteriors agree, there is no scorer.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    voted = rows.select(shapes(F.col("text")).alias("shape")).select(
        vote_pattern(F.col("shape")).alias("pattern")
    )
    counts = {r["pattern"]: r["count"] for r in voted.groupBy("pattern").count().collect()}
    model = label_model(counts, len(labellers(F.lit(""))))
    beliefs = model.posterior.values()
    if not counts or min(beliefs) > 0.5 or max(beliefs) < 0.5:
        return QualityModel(model, None)

    share = min(1.0, sample / sum(counts.values()))
    draw = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) / float(1 << 20)
    chosen = _features(rows.where(draw < share), "text")
    table = F.create_map(*[F.lit(x) for pair in model.posterior.items() for x in pair])
    belief = table[vote_pattern(F.col("shape"))]
    sides = F.array(F.struct(F.lit(1.0).alias("label"), F.col("belief").alias("weight")),
                    F.struct(F.lit(0.0).alias("label"), (1 - F.col("belief")).alias("weight")))
    # A bounded table in few parts: the rounds of fitting must not run over all parts of the corpus.
    believed = chosen.select("tokens", belief.alias("belief")).repartition(SAMPLE_PARTS)
    examples = written(believed, "examples").select("tokens", F.inline(sides))
    examples = examples.where("weight > 0.001")
    scorer = Pipeline(
        stages=[
            HashingTF(numFeatures=BUCKETS, inputCol="tokens", outputCol="counts"),
            Normalizer(p=1.0, inputCol="counts", outputCol="features"),
            LogisticRegression(weightCol="weight", regParam=1e-4, maxIter=ROUNDS),
        ]
    )
    return QualityModel(model, scorer.fit(examples))


def score(
    docs: DataFrame, model: QualityModel, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Struct column ``whole`` (the row), doc_id, weak_label (posterior of the row's votes), score
    (of the scorer, 0 to 1) and keep (score of at least one half).

    NULL and empty texts are one empty word. Without a scorer the posterior stands in. Repeated rows
    are scored alike; no column of ``docs`` can clash, as all are inside ``whole``.
    """
    rows = docs.select(
        F.struct("*").alias("whole"), F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")
    )
    posterior = model.labels.posterior or {0: 1.0}
    table = F.create_map(*[F.lit(x) for pair in posterior.items() for x in pair])
    weak = F.coalesce(table[vote_pattern(F.col("shape"))], F.lit(model.labels.prior))
    rows = _features(rows, "text").withColumn("weak_label", weak)
    if model.scorer is None:
        rows = rows.withColumn("score", F.col("weak_label"))
    else:
        rows = model.scorer.transform(rows)
        rows = rows.withColumn("score", vector_to_array("probability")[1])
    return rows.select(
        "whole", "doc_id", "weak_label", "score", (F.col("score") >= KEEP_FROM).alias("keep")
    )


def drop_low_quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, that a model learnt from them keeps."""
    return score(docs, learn(docs, id_col=id_col, text_col=text_col), id_col, text_col).where(
        "keep"
    ).select("whole.*")
