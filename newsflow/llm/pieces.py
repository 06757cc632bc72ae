"""SentencePiece encoding and decoding over a trie of marked words.

A text becomes one string in which every space is a mark; it is cut before every run of marks, into
marked words, which no piece of the vocabulary crosses (where no piece mixes letters with other
characters, words are cut between these as well). The distinct words of a batch are sorted,
which is the depth-first order of their trie, and encoded by dynamic programming over their
characters. The states of a common prefix are kept from the word before and used again. Words met
before in the worker are looked up.

The state of a prefix depends on the kind of vocabulary:

* unigram: the best score of a path and its last piece, as in Viterbi's algorithm;
* byte-pair merges: the scores are merge ranks, and the sum of ranks does not order paths as the
  merges do. There the one path that the merges produce is kept: a prefix ends in the one piece that
  stays apart from the last piece of the prefix before it.
"""

from __future__ import annotations

import functools
import re
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsflow.llm.word_ids import WordMemory, as_lists, joined, slices

MARK = "▁"
WORD = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")
# Superscript digits and other numerals count as other characters than letters.
NUMERALS = "\u00b2\u00b3\u00b9\u00bc-\u00be\u2070-\u218b\u2460-\u24ff"
LETTERS = re.compile(
    rf"{MARK}*(?:[^\W\d_{NUMERALS}]+|(?:(?!{MARK})[\W\d_{NUMERALS}])+)|{MARK}+"
)
# Words (and pairs of pieces) that a worker keeps before it forgets those not met again.
REMEMBERED = 1 << 17
UNKNOWN_PENALTY = 10.0


def _mixed(piece: str) -> bool:
    """Whether a letter stands beside another character than a mark before it."""
    return len(LETTERS.findall(piece)) > 1


class Vocabulary:
    """Pieces of a model file, with the two tests that the dynamic programme asks for."""

    def __init__(self, path: str, kind: str) -> None:
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)
        self.kind = kind
        self.pieces = [model.id_to_piece(i) for i in range(model.get_piece_size())]
        self.bytes = {int(self.pieces[i][3:5], 16): i for i in range(len(self.pieces))
                      if model.is_byte(i)}
        self.byte_of = {i: b for b, i in self.bytes.items()}
        self.control = {i for i in range(len(self.pieces)) if model.is_control(i)}
        self.unknown = model.unk_id()
        plain = [
            i for i in range(len(self.pieces))
            if i != self.unknown
            and not (i in self.byte_of or i in self.control or model.is_unused(i))
        ]
        self.score = {self.pieces[i]: model.get_score(i) for i in plain}
        self.id = {self.pieces[i]: i for i in plain}
        self.word = WORD if any(map(_mixed, self.score)) else LETTERS
        # Lengths, longest first, of the pieces that end in three (shorter ones: their) characters.
        self.lengths: dict[str, tuple[int, ...]] = {}
        ends: dict[str, set[int]] = {}
        for piece in self.score:
            if len(piece) > 1:
                ends.setdefault(piece[-3:], set()).add(len(piece))
        for end, found in ends.items():
            shorter = ends.get(end[1:], set()) if len(end) == 3 else set()
            self.lengths[end] = tuple(sorted(found | shorter, reverse=True))
        self.least = min(self.score.values(), default=0.0)
        self.memory = WordMemory(REMEMBERED)
        # By piece: the pieces before it that were tested, and whether they stay apart.
        self.pairs: dict[str, dict[str, bool]] = {piece: {} for piece in self.score}
        self.tested = 0
        self.parts: dict[str, tuple[str, str] | None] = {}
        # Texts of ids; a byte of more than 127 is a part of a character and not among them.
        self.texts = [
            "" if i in self.control else " ⁇ " if i == self.unknown
            else chr(self.byte_of[i]) if i in self.byte_of else piece.replace(MARK, " ")
            for i, piece in enumerate(self.pieces)
        ]
        self.partial = np.array([self.byte_of.get(i, 0) > 127 for i in range(len(self.pieces))])

    def split(self, piece: str) -> tuple[str, str] | None:
        """The two pieces of a piece's last merge; None for a character."""
        if piece not in self.parts:
            self.parts[piece] = None if len(piece) == 1 else self._last_merge(piece)
        return self.parts[piece]

    def _last_merge(self, piece: str) -> tuple[str, str] | None:
        symbols = list(piece)
        while len(symbols) > 2:
            scores = [self.score.get(a + b) for a, b in zip(symbols, symbols[1:])]
            known = [s for s in scores if s is not None]
            if not known:
                return None
            at = scores.index(max(known))
            symbols[at : at + 2] = [symbols[at] + symbols[at + 1]]
        return symbols[0], symbols[1]

    def apart(self, left: str, right: str) -> bool:
        """Whether merging leaves ``left`` and ``right`` as two pieces where they meet."""
        if self.tested >= REMEMBERED:
            self.tested = 0
            for known in self.pairs.values():
                known.clear()
        self.tested += 1
        known = self.pairs[right][left] = self._apart(left, right)
        return known

    def _apart(self, left: str, right: str) -> bool:
        """Undo the merges of both sides from the last on and look for a better one across.

        An empty ``left`` is the start of the word: the piece need only come about by merging.
        ``taken`` is the score at which a symbol at the border was used up by its own side's merge;
        a merge across comes before it if it scores higher, or as high and further left.
        """
        if self.split(right) is None and len(right) > 1:
            return False
        if not left:
            return True
        taken, by_right = -float("inf"), False
        while True:
            across = self.score.get(left + right)
            if across is not None and (across > taken or across == taken and by_right):
                return False
            a, b = self.split(left), self.split(right)
            if a is None and b is None:
                return True
            score_a = float("inf") if a is None else self.score[left]
            score_b = float("inf") if b is None else self.score[right]
            # The later merge is undone first; of equal merges the one further right is later.
            if score_b <= score_a:
                taken, by_right, right = score_b, True, b[0]
            else:
                taken, by_right, left = score_a, False, a[1]

    def _lengths(self, word: str, end: int) -> tuple[int, ...]:
        """Lengths above one that the last piece of ``word[:end]`` may have, longest first."""
        found = self.lengths.get(word[max(0, end - 3) : end])
        return found if found is not None else self.lengths.get(word[max(0, end - 2) : end], ())

    def _best_steps(self, word: str, done: int, states: list[tuple[str, float]]) -> None:
        """Extend the best paths to the prefixes of a word: the last piece and the score of each."""
        for end in range(done + 1, len(word) + 1):
            score = self.score.get(word[end - 1], self.least - UNKNOWN_PENALTY)
            best = (word[end - 1], states[end - 1][1] + score)
            for length in self._lengths(word, end):
                piece = word[end - length : end] if length <= end else ""
                score = self.score.get(piece)
                if score is not None and states[end - length][1] + score > best[1]:
                    best = (piece, states[end - length][1] + score)
            states.append(best)

    def _merged_steps(self, word: str, done: int, states: list[str]) -> None:
        """Extend what merging makes of the prefixes of a word: the last piece of each."""
        pairs, lengths = self.pairs.get, self.lengths.get
        for end in range(done + 1, len(word) + 1):
            last = word[end - 1]
            found = lengths(word[end - 3 : end]) if end > 2 else None
            if found is None:
                found = lengths(word[end - 2 : end], ()) if end > 1 else ()
            for length in found:
                if length <= end:
                    piece = word[end - length : end]
                    known = pairs(piece)
                    if known is not None:
                        before = states[end - length]
                        apart = known.get(before)
                        if apart or apart is None and self.apart(before, piece):
                            last = piece
                            break
            states.append(last)

    def _ids(self, word: str, lasts: list[str]) -> bytes:
        pieces, end = [], len(word)
        while end:
            pieces.append(lasts[end])
            end -= len(pieces[-1])
        out: list[int] = []
        for piece in reversed(pieces):
            known = self.id.get(piece)
            if known is not None:
                out.append(known)
            elif self.bytes:
                out.extend(self.bytes[b] for b in piece.encode())
            else:
                out.append(self.unknown)
        return struct.pack(f"<{len(out)}i", *out)

    def learn(self, words: list[str]) -> dict[str, bytes]:
        """Ids of words, as little-endian integers, by one walk of their trie."""
        out: dict[str, bytes] = {}
        unigram = self.kind == "unigram"
        states: list = [("", 0.0)] if unigram else [""]
        before = ""
        for word in sorted(words):
            shared = 0
            for a, b in zip(before, word):
                if a != b:
                    break
                shared += 1
            del states[shared + 1 :]
            (self._best_steps if unigram else self._merged_steps)(word, shared, states)
            out[word] = self._ids(word, [piece for piece, _ in states] if unigram else states)
            before = word
        return out

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of whole texts, and their number per text."""
        words = [marked(t, self.word) for t in texts]
        return joined(words, lambda some: self.memory.ids(some, self.learn))

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids: bytes join up to characters, marks are spaces, and the mark that
        encoding put before the text goes."""
        first = next((self.pieces[i] for i in ids.tolist() if i not in self.control), "")
        skip = first.startswith(MARK)
        if not self.partial[ids].any():
            return "".join(map(self.texts.__getitem__, ids.tolist()))[skip:]
        out, held = [], bytearray()
        for i in ids.tolist():
            if i in self.byte_of:
                held.append(self.byte_of[i])
                continue
            out += [held.decode(errors="replace"), self.texts[i]]
            held.clear()
        return "".join([*out, held.decode(errors="replace")])[skip:]


@functools.lru_cache(maxsize=2)
def vocabulary(path: str, kind: str) -> Vocabulary:
    return Vocabulary(path, kind)


def marked(text: str | None, word: re.Pattern = WORD) -> list[str]:
    return word.findall(MARK + text.replace(" ", MARK)) if text else []


def encode(text: Column, model_path: str, kind: str = "bpe") -> Column:
    """Ids of whole texts, an array; NULL and empty texts have none.

    ``kind`` is the vocabulary's: ``bpe`` or ``unigram``. The model file must be readable on every
    executor. It must neither normalise nor remove white space, add a leading mark, and have no
    piece with a mark after another character.
    """

    @F.arrow_udf("array<int>")
    def ids(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        known = vocabulary(model_path, kind)
        for batch in batches:
            texts = [t or "" for t in batch.to_pylist()]
            yield as_lists([known.encode(some) for some in slices(texts)])

    return ids(text.cast("string"))


def decode(ids: Column, model_path: str, kind: str = "bpe") -> Column:
    """Texts of arrays of ids; NULL has the empty text."""

    @F.arrow_udf("string")
    def texts(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        known = vocabulary(model_path, kind)
        for lists in batches:
            full = lists.fill_null([]) if lists.null_count else lists
            values, ends = full.values.to_numpy(), full.offsets.to_numpy()
            yield pa.array([known.decode(values[a:b]) for a, b in zip(ends, ends[1:])], pa.string())

    return texts(ids)


def encode_documents(
    docs: DataFrame,
    model_path: str,
    kind: str = "bpe",
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per row of ``docs``: doc_id, ids, n_tokens, decoded (the text of the ids) and
    round_trip (whether that is the text).

    NULL and empty texts have no ids and an empty decoded text; a text that holds the mark itself
    decodes it to a space, as the vocabulary cannot tell them apart. Repeated rows give repeated
    rows, an empty table an empty table; other columns are not looked at. Nothing is shuffled. A
    task encodes and decodes in one worker, a bounded run of texts at a time.
    """
    rows = docs.select(
        F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text")
    )

    def encoded(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabulary(model_path, kind)
        for frame in frames:
            at = 0
            for some in slices([t or "" for t in frame.column("text").to_pylist()]):
                ids, counts = known.encode(some)
                ends = np.cumsum(counts)
                decoded = [known.decode(ids[b - n : b]) for b, n in zip(ends, counts)]
                columns = {
                    "doc_id": frame.column("doc_id").slice(at, len(some)),
                    "ids": as_lists([(ids, counts)]),
                    "n_tokens": pa.array(counts, pa.int64()),
                    "decoded": pa.array(decoded, pa.string()),
                    "round_trip": pa.array([a == b for a, b in zip(decoded, some)], pa.bool_()),
                }
                yield pa.RecordBatch.from_pydict(columns)
                at += len(some)

    kept = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(
        encoded,
        f"doc_id {kept}, ids array<int>, n_tokens long, decoded string, round_trip boolean",
    )
