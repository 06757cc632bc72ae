"""Text cleaning: tags, links, whitespace and special characters, with Unicode-exact classes."""

from __future__ import annotations

import html
import re
import string
import sys
import unicodedata
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from newsflow.functions.entities import html_unescape

# A class lists its ASCII members one by one (the JVM keeps those in a bit table) and looks at the
# rest of Unicode only for characters beyond ASCII, so ordinary text costs one table look-up each.
TAG = "<[^>]+>"
PYTHON_URL = r"(?:http|www)\S+"
ASCII_WORD = string.ascii_letters + string.digits + "_"
# Texts that one step of the Python side holds as strings.
SLICE = 64
# White space (ASCII, then the rest) and the punctuation that survives cleaning.
ASCII_SPACE = r"\t\n\x0b\f\r\x1c\x1d\x1e\x1f\x20"
WIDE_SPACE = "".join(
    f"\\x{{{code}}}"
    for code in (
        "85 a0 1680 2000 2001 2002 2003 2004 2005 2006 2007 2008 2009 200a "
        "2028 2029 202f 205f 3000"
    ).split()
)
KEPT_PUNCTUATION = r".,!?\-"
# Letters, numbers and underscore. Characters the JVM's Unicode tables do not know yet count as
# letters: cleaned text holds no others of them.
WORD = rf"{ASCII_WORD}[[^\x00-\x7f]&&[\p{{L}}\p{{N}}\p{{Cn}}]]"
SPACE = rf"{ASCII_SPACE}[[^\x00-\x7f]&&[{WIDE_SPACE}]]"


@lru_cache(maxsize=1)
def recent_word_ranges() -> str:
    """Letters and numbers newer than Unicode 3.2, as the inside of a character class.

    The JVM's Unicode tables may be older than the text. Characters the JVM does not know yet as
    letters are kept through this class; those it does know are in it without effect.
    """
    old = unicodedata.ucd_3_2_0.category
    ranges: list[list[int]] = []
    for code in range(0x80, sys.maxunicode + 1):
        char = chr(code)
        if char.isalnum() and old(char) == "Cn":
            if ranges and ranges[-1][1] == code - 1:
                ranges[-1][1] = code
            else:
                ranges.append([code, code])
    return "".join(f"\\x{{{a:x}}}-\\x{{{b:x}}}" for a, b in ranges)


@lru_cache(maxsize=1)
def kept_class() -> str:
    """Everything that survives cleaning, as the inside of a character class."""
    wide = rf"\p{{L}}\p{{N}}{WIDE_SPACE}{recent_word_ranges()}"
    return rf"{ASCII_WORD}{ASCII_SPACE}{KEPT_PUNCTUATION}[[^\x00-\x7f]&&[{wide}]]"


def or_empty(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))


def strip_tags(text: Column) -> Column:
    """Delete ``<...>`` runs; element bodies stay and nothing is put in place of a tag."""
    return F.regexp_replace(text, TAG, "")


def strip_urls(text: Column) -> Column:
    """Delete ``http`` or ``www`` with the non-blank characters that follow, also inside a word."""
    return F.regexp_replace(text, f"(?:http|www)[^{SPACE}]+", "")


def collapse_whitespace(text: Column) -> Column:
    """Turn every run of white space into one space and trim both ends."""
    return F.trim(F.regexp_replace(text, f"[{SPACE}]+", " "))


def strip_special_chars(text: Column) -> Column:
    """Keep word characters, white space and ``. , ! ? -`` only."""
    return F.regexp_replace(text, f"[^{kept_class()}]", "")


def clean_html(text: Column) -> Column:
    """Decode entities once, then drop tags (so an escaped tag goes as well)."""
    return strip_tags(html_unescape(or_empty(text)))


def clean_text(text: Column) -> Column:
    """Drop links, collapse white space, drop special characters, in this order."""
    return strip_special_chars(collapse_whitespace(strip_urls(or_empty(text))))


def clean(text: Column) -> Column:
    """All steps of :func:`clean_html` and :func:`clean_text` in one pass of Python per batch.

    The steps one by one, as built-in regular expressions, take over twice as long together: each
    copies the text, and their Unicode classes are slow in the JVM. The batches come through Arrow.
    """

    def cleaned(texts: pa.Array) -> pa.Array:
        tag, link = re.compile(TAG), re.compile(PYTHON_URL)
        special = re.compile(r"[^\w\s.,!?\-]")

        def one(text: str | None) -> str:
            text = tag.sub("", html.unescape(text or ""))
            if "http" in text or "www" in text:
                text = link.sub("", text)
            # White space is what separates here, as for \s+, at a quarter of its time.
            return special.sub("", " ".join(text.split()))

        # A few texts at a time are Python strings; the rest of the batch stays in its buffers.
        parts = [
            pa.array([one(t) for t in texts.slice(k, SLICE).to_pylist()], pa.string())
            for k in range(0, len(texts), SLICE)
        ]
        return pa.concat_arrays(parts) if parts else pa.array([], pa.string())

    return F.arrow_udf(cleaned, StringType())(text)


def blanked(text: Column) -> Column:
    r"""A space for every character that is not ASCII white space, as replacing ``\S`` gives.

    Done on the bytes: replaced one by one, every character would be a match of its own.
    """
    kept = {*b"\t\n\x0b\f\r"}
    spaces = bytes(byte if byte in kept else 0x20 for byte in range(256))
    # All bytes of a character but its first.
    others = bytes(range(0x80, 0xC0))

    def blank(texts: pa.Array) -> pa.Array:
        parts = []
        for k in range(0, len(texts), SLICE):
            whole = texts.slice(k, SLICE).cast(pa.binary()).to_pylist()
            parts.append(pa.array([t and t.translate(spaces, others) for t in whole], pa.binary()))
        return pa.concat_arrays(parts).cast(pa.string()) if parts else pa.array([], pa.string())

    return F.arrow_udf(blank, StringType())(text)


def join_text(title: Column, summary: Column, content: Column) -> Column:
    """The analysed text: the three parts with single spaces between, also around empty parts."""
    return F.concat(
        or_empty(title), F.lit(" "), or_empty(summary), F.lit(" "), or_empty(content)
    )


def is_blank(text: Column) -> Column:
    return ~or_empty(text).rlike(f"[^{SPACE}]")
