"""Rates at which documents are drawn so that domains reach target shares of the tokens.

A document belongs to several domains in part: a classifier learnt from labelled documents gives
the posterior of every domain. The rates are the nonnegative least-squares fit of the expected
domain tokens, the sum of rate * tokens * posterior, to the targets, by projected gradients. Only
vectors of one number per domain move between the driver and the tasks; a task computes its rates
anew from the steps so far, so a lost executor costs its share of one pass.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF, Normalizer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsflow.operators.scratch import written

# Labelled documents learnt from (expected number) and their parts, hash buckets of words and of
# metadata, rounds of fitting.
SAMPLE, SAMPLE_PARTS, WORDS, METADATA, ROUNDS = 10_000, 8, 1024, 256, 40
STEPS, CLOSE = 40, 1e-4
# Labelled documents that are learnt from (expected number) of every domain that has as many.
FLOOR = 100


def n_tokens(text: Column) -> Column:
    """Words between white space; none for NULL."""
    return F.coalesce(F.regexp_count(text, F.lit(r"\S+")), F.lit(0)).cast("long")


def _draw(*values) -> Column:
    return F.pmod(F.xxhash64(*values), F.lit(1 << 20)) / float(1 << 20)


@dataclass(frozen=True)
class Columns:
    """Where a table has its ids, texts, domains and the metadata that tell of the domain."""

    doc_id: str = "doc_id"
    text: str = "text"
    domain: str = "source"
    metadata: tuple[str, ...] = ("source", "lang")


@dataclass(frozen=True)
class Classifier:
    """Domains in order of name and, if there are two or more, the model that tells them apart."""

    domains: list[str]
    model: PipelineModel | None

    def members(self, docs: DataFrame, at: Columns) -> DataFrame:
        """Struct ``whole`` (the row), doc_id, tokens and posterior (array) of every row."""
        rows = _worded(docs, at)
        if self.model is None:
            chance = F.array(*[F.lit(1.0)] * len(self.domains)).cast("array<double>")
        else:
            rows = self.model.transform(rows)
            # A last domain that the sample misses has no class of its own.
            chance = F.transform(
                F.sequence(F.lit(0), F.lit(len(self.domains) - 1)),
                lambda i: F.coalesce(F.get(vector_to_array("probability"), i), F.lit(0.0)),
            )
        return rows.select("whole", "doc_id", "tokens", chance.alias("posterior"))


def _worded(docs: DataFrame, at: Columns) -> DataFrame:
    facts = [F.concat(F.lit(f"{c}="), F.coalesce(F.col(c).cast("string"), F.lit("")))
             for c in at.metadata]
    rows = docs.select(
        F.struct("*").alias("whole"),
        F.col(at.doc_id).alias("doc_id"),
        F.col(at.domain).cast("string").alias("domain"),
        F.coalesce(F.col(at.text).cast("string"), F.lit("")).alias("text"),
        F.array(*facts).cast("array<string>").alias("facts"),
    )
    words = F.split(F.lower(F.trim("text")), r"\s+")
    return rows.select(
        "whole", "doc_id", "domain", "facts", n_tokens(F.col("text")).alias("tokens"),
        words.alias("words"),
    )


def _shares(counts: list[int], sample: int) -> list[float]:
    """Shares of the domains' rows to learn from: about ``sample`` rows in all, as many of one domain
    as of another where it has them, and never less than ``FLOOR`` or all it has."""
    left, quota = sample, 0.0
    for k, n in enumerate(sorted(counts)):
        quota = left / (len(counts) - k)
        if n > quota:
            break
        left -= n
    else:
        return [1.0] * len(counts)
    return [min(1.0, max(quota, FLOOR) / n) for n in counts]


def learn_domains(docs: DataFrame, at: Columns = Columns(), sample: int = SAMPLE) -> Classifier:
    """Learn domains from the rows that name one, the labelled table.

    About ``sample`` of them, by the hash of the id, are learnt from, drawn per domain so that rare
    ones are not missed, and weighed by how many rows each stands for. With D domains there are at
    most ``max(sample, FLOOR * D)``; the model and the fit hold D times the features and D * D
    numbers on the driver, which is meant for up to about a thousand domains. Features are shares
    of hashed words of the whole text and hashed metadata, so a row without a domain is placed by
    its text. With a single domain everything belongs to it.
    """
    labelled = docs.where(F.col(at.domain).isNotNull())
    named = labelled.groupBy(F.col(at.domain).cast("string").alias("domain")).count().collect()
    domains = sorted(r["domain"] for r in named)
    if len(domains) < 2:
        return Classifier(domains, None)
    counts = {r["domain"]: r["count"] for r in named}
    shares = F.array(*[F.lit(x) for x in _shares([counts[d] for d in domains], sample)])
    names = F.array(*[F.lit(d) for d in domains])
    place = F.array_position(names, F.col("domain")) - 1
    share = F.get(shares, (F.array_position(names, F.col(at.domain).cast("string")) - 1).cast("int"))
    chosen = _worded(labelled.where(_draw(at.doc_id) < share), at).drop("whole", "doc_id")
    chosen = chosen.withColumn("weight", 1 / F.get(shares, place.cast("int")))
    # A bounded table in few parts: the rounds of fitting must not run over all parts of the corpus.
    chosen = written(chosen.repartition(SAMPLE_PARTS), "labelled")
    stages = [
        HashingTF(numFeatures=WORDS, inputCol="words", outputCol="word_counts"),
        Normalizer(p=2.0, inputCol="word_counts", outputCol="word_shares"),
        HashingTF(numFeatures=METADATA, inputCol="facts", outputCol="fact_counts"),
        VectorAssembler(inputCols=["word_shares", "fact_counts"], outputCol="features"),
        LogisticRegression(
            family="multinomial", regParam=1e-3, maxIter=ROUNDS, weightCol="weight"
        ),
    ]
    model = Pipeline(stages=stages).fit(chosen.withColumn("label", place.cast("double")))
    return Classifier(domains, model)


def _rates(
    posterior: np.ndarray, moves: list, start: float, low: float, high: float
) -> tuple[np.ndarray, np.ndarray]:
    """Rates after the moves, and the point ahead of them from which the next move starts.

    Each move is taken from the rates carried on by a growing part of the last change (Nesterov's
    momentum) and projected onto the bounds.
    """
    rates = ahead = np.full(len(posterior), start)
    for k, move in enumerate(moves):
        before, rates = rates, np.clip(ahead - posterior @ move, low, high)
        ahead = rates + k / (k + 3) * (rates - before)
    return rates, ahead


def _reached(table: DataFrame, domains: int, moves: list, bounds: tuple) -> list[np.ndarray]:
    """Expected tokens at the rates and ahead of them; before any move, also the products of the
    domains' memberships, for the metric of the steps."""
    if not domains:
        return [np.zeros(0), np.zeros(0), np.zeros((0, 0))]
    shape = (domains + 2, domains)

    def sums(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(shape)
        for frame in frames:
            posterior = np.array(frame["posterior"].to_list()).reshape(len(frame), domains)
            tokens = frame["tokens"].to_numpy(dtype=float)
            for k, rates in enumerate(_rates(posterior, moves, *bounds)):
                total[k] += posterior.T @ (tokens * rates)
            if not moves:
                total[2:] += posterior.T @ (posterior * tokens[:, None])
        yield pd.DataFrame({"cell": np.arange(total.size), "n": total.ravel()})

    cells = table.select("tokens", "posterior").mapInPandas(sums, "cell int, n double")
    found = np.zeros(shape).ravel()
    for row in cells.groupBy("cell").agg(F.sum("n").alias("n")).collect():
        found[row["cell"]] = row["n"]
    return [found[:domains], found[domains : 2 * domains], found.reshape(shape)[2:]]


@dataclass(frozen=True)
class Mixture:
    """A fit: the classifier, the steps taken within the bounds, and per domain the expected tokens
    at rate one, the targets and the tokens reached."""

    classifier: Classifier
    moves: list
    low: float
    high: float
    tokens: np.ndarray
    targets: np.ndarray
    reached: np.ndarray

    def rated(self, members: DataFrame) -> DataFrame:
        """``members`` with rate and copies in place of the posterior.

        ``copies`` is the rate rounded up or down by the hash of the id, so that it is met on
        average; rows repeated with one id are rounded alike.
        """
        start = float(np.clip(1.0, self.low, self.high))
        moves, low, high, d = self.moves, self.low, self.high, len(self.classifier.domains)

        @F.pandas_udf("double")
        def rate(lists: pd.Series) -> pd.Series:
            posterior = np.array(lists.to_list()).reshape(len(lists), d)
            return pd.Series(_rates(posterior, moves, start, low, high)[0])

        rows = members.withColumn("rate", rate("posterior") if moves else F.lit(start))
        copies = F.floor(F.col("rate") + _draw(F.lit("mix"), "doc_id")).cast("int")
        return rows.withColumn("copies", copies).drop("posterior")


def fit_rates(
    docs: DataFrame,
    weights: dict[str, float] | None = None,
    temper: float = 0.0,
    low: float = 0.0,
    high: float = float("inf"),
    raise_only: bool = False,
    at: Columns = Columns(),
    sample: int = SAMPLE,
) -> tuple[DataFrame, Mixture]:
    """Rates of all rows (doc_id, tokens, rate, copies) and the mixture they make.

    Targets are shares ``weights`` of the domains (others get none) or, without weights, shares in
    proportion to the expected tokens to the power ``temper`` (0: equal shares). Their sum is the
    sum of all tokens, or with ``raise_only`` the least sum at which no domain loses tokens. Rates
    stay between ``low`` and ``high``.

    NULL and empty texts have no tokens; they get a rate by their posterior like others, as do rows
    without a domain. Of an empty table the result is empty, and where no row names a domain all
    rates are one (within the bounds). Other columns are not looked at.
    """
    classifier = learn_domains(docs, at, sample)
    table = written(classifier.members(docs, at).drop("whole"), "memberships")
    d, start = len(classifier.domains), float(np.clip(1.0, low, high))
    tokens, _, cross = _reached(table, d, [], (1.0, low, high))
    if weights is None:
        shares = np.maximum(tokens, 0.0) ** temper
    else:
        shares = np.array([float(weights.get(x, 0.0)) for x in classifier.domains])
    shares = shares / max(shares.sum(), 1e-300)
    whole = tokens.sum()
    if raise_only:
        whole = max((t / s for t, s in zip(tokens, shares) if s > 0), default=whole)
    targets = shares * whole

    # The inverse products scale the residual: where no bound holds, the first step arrives.
    metric = np.linalg.pinv(cross + np.eye(d) * 1e-9 * max(np.trace(cross), 1e-9))
    moves: list[np.ndarray] = []
    reached = ahead = tokens * start
    gain, close = np.inf, CLOSE * max(whole, 1.0)
    # A gain far below what is still missing means that the bounds leave nothing more to reach.
    while len(moves) < STEPS and np.abs(reached - targets).max(initial=0.0) > close < 10 * gain:
        moves.append(metric @ (ahead - targets))
        before = reached
        reached, ahead, _ = _reached(table, d, moves, (start, low, high))
        gain = np.abs(reached - before).max()
    mixture = Mixture(classifier, moves, low, high, tokens, targets, reached)
    return mixture.rated(table), mixture


def mix(docs: DataFrame, at: Columns = Columns(), **options) -> DataFrame:
    """The rows of ``docs``, all columns, each as often as its copies say."""
    _, mixture = fit_rates(docs, at=at, **options)
    rows = mixture.rated(mixture.classifier.members(docs, at))
    often = F.explode(F.array_repeat(F.lit(0), F.col("copies")))
    return rows.select("whole", often.alias("again")).select("whole.*")
