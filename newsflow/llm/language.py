"""Languages of texts and of the spans of mixed texts.

Every word is scored against the languages whose script it is written in, by hashed character
n-grams counted over labelled texts. A Viterbi search over the words of a text, with a penalty for
every switch, gives each word its language; equal neighbours are a span.
"""

from __future__ import annotations

import itertools
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsflow.llm.word_ids import slices

# Texts learnt from per language (expected number), buckets of n-grams, n-gram lengths.
SAMPLE, BUCKETS, GRAMS = 4000, 1 << 15, (1, 2, 3, 4)
# Cost of a switch; score of a language that does not use a word's script; least share of a
# language's letters for a script to be its own.
SWITCH, FOREIGN, OWN_SCRIPT = 20.0, -50.0, 0.01
# Words of a block.
BLOCK = 64
WORD = re.compile(r"[^\W\d_]+")
SPANS = "array<struct<start:int,end:int,lang:string,letters:int>>"

# First code points of scripts, in order, up to the next entry.
SCRIPTS = [
    (0x0000, "latin"), (0x0370, "greek"), (0x0400, "cyrillic"), (0x0530, "armenian"),
    (0x0590, "hebrew"), (0x0600, "arabic"), (0x0700, "other"), (0x0900, "devanagari"),
    (0x0980, "bengali"), (0x0A00, "indic"), (0x0E00, "thai"), (0x0E80, "lao"), (0x0F00, "tibetan"),
    (0x1000, "myanmar"), (0x10A0, "georgian"), (0x1100, "hangul"), (0x1200, "ethiopic"),
    (0x1400, "other"), (0x1780, "khmer"), (0x1800, "mongolian"), (0x18B0, "other"),
    (0x1E00, "latin"), (0x1F00, "greek"), (0x2000, "other"), (0x2C60, "latin"), (0x2C80, "other"),
    (0x2E80, "han"), (0x3040, "kana"), (0x3100, "han"), (0xA000, "other"), (0xA720, "latin"),
    (0xA800, "other"), (0xAC00, "hangul"), (0xD7B0, "other"), (0xF900, "han"), (0xFB00, "latin"),
    (0xFB13, "other"), (0x20000, "han"), (0x32000, "other"),
]
STARTS = np.array([s for s, _ in SCRIPTS])
NAMES = sorted({n for _, n in SCRIPTS})


SCRIPT_OF = np.array([NAMES.index(n) for _, n in SCRIPTS])


def scripts_of(words: list[str]) -> np.ndarray:
    """Number of the script of each word's first letter."""
    firsts = np.array([ord(w[0]) for w in words], dtype=np.int64)
    return SCRIPT_OF[np.searchsorted(STARTS, firsts, side="right") - 1]


def grams_of(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the n-grams of words in lower case, their ends marked, and each word's start.

    A row per length and a column per character at which an n-gram may begin; ``BUCKETS`` stands
    where it would reach into the next word.
    """
    marked = [f"^{w.lower()}$" for w in words]
    sizes = np.array([len(w) for w in marked])
    points = np.frombuffer("".join(marked).encode("utf-32-le", "replace"), dtype="<u4")
    points = np.concatenate([points, np.zeros(max(GRAMS), dtype="<u4")]).astype(np.uint64)
    word = np.concatenate([np.repeat(np.arange(len(words)), sizes), np.full(max(GRAMS), -1)])
    n, rows = len(word) - max(GRAMS), []
    value = np.zeros(n, dtype=np.uint64)
    for length in range(1, max(GRAMS) + 1):
        # A polynomial of the code points, its high bits mixed down.
        value = value * np.uint64(0x100000001B3) + points[length - 1 : n + length - 1] + np.uint64(1)
        mixed = (value * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - BUCKETS.bit_length() + 1)
        inside = word[length - 1 : n + length - 1] == word[:n]
        rows.append(np.where(inside, mixed.astype(np.int64), BUCKETS))
    return np.stack([rows[length - 1] for length in GRAMS]), np.cumsum(sizes) - sizes


@dataclass(frozen=True)
class Model:
    """Languages in order of name, log-probabilities of n-grams, and whether a script is used."""

    languages: tuple[str, ...]
    grams: np.ndarray
    scripts: np.ndarray

    def word_scores(self, words: list[str]) -> np.ndarray:
        """A row per word: log-odds against the best language, ``FOREIGN`` in languages of other
        scripts; zeros where no language uses the script."""
        if not words:
            return np.zeros((0, len(self.languages)))
        buckets, starts = grams_of(words)
        sums = sum(np.add.reduceat(self.grams[row], starts, axis=0) for row in buckets)
        own = self.scripts[scripts_of(words)]
        scores = np.where(own, sums - sums.max(axis=1, keepdims=True), FOREIGN)
        return np.where(own.any(axis=1, keepdims=True), scores, 0.0)


def held_out(doc_id: Column) -> Column:
    """Whether a document is kept from learning; a NULL id is."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(True))


def _counts(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """N-grams (bucket from 0) and letters by script (bucket below 0) per language."""
    for frame in frames:
        for lang, texts in frame.groupby("lang")["text"]:
            for some in slices(list(texts)):
                found = Counter(w for text in some for w in WORD.findall(text))
                words, times = list(found), np.array(list(found.values()))
                if not words:
                    continue
                buckets, starts = grams_of(words)
                often = np.repeat(times, np.diff([*starts, buckets.shape[1]]))
                total = np.bincount(buckets.ravel(), np.tile(often, len(GRAMS)), BUCKETS + 1)[:-1]
                letters = times * np.array([len(w) for w in words])
                total = np.concatenate([total, np.bincount(scripts_of(words), letters, len(NAMES))])
                filled = np.flatnonzero(total)
                yield pd.DataFrame({"lang": lang, "bucket": filled, "n": total[filled].astype(int)})


def learn(docs: DataFrame, sample: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text",
          lang_col: str = "lang") -> Model:
    """Count n-grams over labelled texts that are not held out.

    About ``sample`` whole texts of every language are taken, by the hash of their id; the model has
    a bounded size per language and is all that reaches the driver. Rows without text, language or
    id teach nothing; without any there are no languages.
    """
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        F.col(text_col).alias("text"),
        F.col(lang_col).cast("string").alias("lang"),
    ).where(~held_out(F.col("doc_id")) & F.col("lang").isNotNull() & F.col("text").isNotNull())
    sizes = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    languages = tuple(sorted(sizes))
    total = np.zeros((BUCKETS + len(NAMES), len(languages)))
    if languages:
        shares = F.create_map(
            *[F.lit(x) for l, n in sizes.items() for x in (l, min(1.0, sample / n))]
        )
        draw = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) / float(1 << 20)
        chosen = rows.where(draw < shares[F.col("lang")]).select("lang", "text")
        counted = chosen.mapInPandas(_counts, "lang string, bucket int, n long")
        place = {lang: k for k, lang in enumerate(languages)}
        for row in counted.groupBy("lang", "bucket").agg(F.sum("n").alias("n")).collect():
            total[row["bucket"], place[row["lang"]]] = row["n"]
    grams, letters = total[:BUCKETS], total[BUCKETS:]
    smooth = np.log((grams + 0.5) / (grams.sum(axis=0) + 0.5 * BUCKETS))
    smooth = np.concatenate([smooth, np.zeros((1, len(languages)))])  # for the bucket of no n-gram
    used = letters > OWN_SCRIPT * letters.sum(axis=0)
    return Model(languages, smooth, used)


def viterbi(scores: np.ndarray, lengths: np.ndarray, switch: float = SWITCH) -> np.ndarray:
    """Best labels of the words of several texts: ``scores`` (words, labels), words per text.

    Texts are cut into blocks and all blocks go forward together: first for the best score between
    any label before and any label at the end of a block, then along the blocks of every text, then
    within each block for the labels. Staying is preferred where a switch is as good.
    """
    k = scores.shape[1]
    blocks = -(-lengths // BLOCK)
    first = np.cumsum(blocks) - blocks
    padded = np.zeros((int(blocks.sum()), BLOCK, k), dtype=np.float32)
    text = np.repeat(np.arange(len(lengths)), lengths)
    inside = np.arange(len(scores)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    where = first[text] + inside // BLOCK, inside % BLOCK
    padded[where] = scores

    apart = np.where(np.eye(k, dtype=bool), 0.0, -1e12).astype(np.float32)
    across = apart[None].repeat(len(padded), axis=0)
    for t in range(BLOCK):
        across = np.maximum(across, across.max(axis=2, keepdims=True) - switch)
        across += padded[:, t, None, :]

    order = np.argsort(-blocks, kind="stable")
    sizes, starts = blocks[order], first[order]
    value, entry = np.zeros((len(order), k)), np.zeros((len(padded), k))
    for j in range(int(sizes.max(initial=0))):
        on = int(np.searchsorted(-sizes, -j, side="left"))
        entry[starts[:on] + j] = value[:on]
        value[:on] = (value[:on, :, None] + across[starts[:on] + j]).max(axis=1)
    begin, finish = np.zeros(len(padded), dtype=int), np.zeros(len(padded), dtype=int)
    label = value.argmax(axis=1)
    for j in range(int(sizes.max(initial=0)) - 1, -1, -1):
        on = int(np.searchsorted(-sizes, -j, side="left"))
        at = starts[:on] + j
        finish[at] = label[:on]
        reached = entry[at] + across[at, :, label[:on]]
        label[:on] = begin[at] = reached.argmax(axis=1)

    rows = np.arange(len(padded))
    state = apart[begin].copy()
    back = np.empty((BLOCK, len(padded), k), dtype=np.int16)
    for t in range(BLOCK):
        top = state.argmax(axis=1)
        jump = state[rows, top][:, None] - switch
        stays = state >= jump
        back[t] = np.where(stays, np.arange(k), top[:, None])
        state = np.where(stays, state, jump) + padded[:, t]
    path = np.empty((len(padded), BLOCK), dtype=np.int16)
    label = finish
    for t in range(BLOCK - 1, -1, -1):
        path[:, t] = label
        label = back[t][rows, label].astype(int)
    return path[where]


def spans_of(texts: list[str], model: Model) -> list[list[dict]]:
    """Spans of texts. The distinct words are scored together, then gathered in order."""
    words = [WORD.findall(t) for t in texts]
    lengths = np.array([len(w) for w in words], dtype=np.int64)
    if not lengths.sum() or not model.languages:
        return [[] for _ in texts]
    flat = pa.array(list(itertools.chain.from_iterable(words)), pa.string()).dictionary_encode()
    scores = model.word_scores(flat.dictionary.to_numpy(zero_copy_only=False).tolist())
    labels = viterbi(scores[flat.indices.to_numpy()], lengths)
    letters = np.concatenate(([0], np.cumsum([len(w) for some in words for w in some])))
    out, at = [], 0
    for text, n in zip(texts, lengths.tolist()):
        own = labels[at : at + n]
        cuts = [0, *(np.flatnonzero(own[1:] != own[:-1]) + 1).tolist(), n]
        begins = [0, len(text)]
        if len(cuts) > 2:
            places = [m.start() for m in WORD.finditer(text)]
            begins = [0, *(places[c] for c in cuts[1:-1]), len(text)]
        out.append([
            {"start": begins[i], "end": begins[i + 1], "lang": model.languages[own[cuts[i]]],
             "letters": int(letters[at + cuts[i + 1]] - letters[at + cuts[i]])}
            for i in range(len(cuts) - 1) if n
        ])
        at += n
    return out


def spans(text: Column, model: Model) -> Column:
    """Spans of whole texts: start and end in code points, language, letters; they cover the text.

    NULL texts and texts without a letter have no spans.
    """

    @F.pandas_udf(SPANS)
    def found(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            texts = [t or "" for t in batch]
            found = [spans_of(some, model) for some in slices(texts)]
            yield pd.Series(list(itertools.chain.from_iterable(found)), dtype=object)

    return found(text.cast("string"))


def identify(
    docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per row of ``docs``: doc_id, spans, lang_pred and score.

    The language of most letters is predicted (of equal ones the first by name); the score is its
    share of the letters. Texts that are NULL or have no letter are ``und`` with score 0, and so is
    every text where nothing was learnt. Repeated rows give repeated rows; other columns are not
    looked at. Nothing is shuffled.
    """
    rows = docs.select(
        F.col(id_col).alias("doc_id"), spans(F.col(text_col), model).alias("spans")
    )
    if not model.languages:
        return rows.select("doc_id", "spans", F.lit("und").alias("lang_pred"),
                           F.lit(0.0).alias("score"))
    names = F.array(*[F.lit(x) for x in model.languages])

    def letters(lang: Column) -> Column:
        own = F.filter("spans", lambda s: s["lang"] == lang)
        return F.aggregate(own, F.lit(0).cast("long"), lambda n, s: n + s["letters"])

    totals = F.transform(names, lambda x, i: F.struct(letters(x).alias("n"), (-i).alias("place")))
    every = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["letters"])
    rows = rows.select("*", F.array_max(totals).alias("most"), every.alias("every"))
    some = F.col("every") > 0
    return rows.select(
        "doc_id",
        "spans",
        F.when(some, F.get(names, -F.col("most.place"))).otherwise("und").alias("lang_pred"),
        F.when(some, F.col("most.n") / F.col("every")).otherwise(0.0).alias("score"),
    )
