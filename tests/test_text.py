import html
import html.entities
import random
import re
import tracemalloc

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from newsflow.functions import keywords as K
from newsflow.functions import text as X
from newsflow.functions.entities import html_unescape


def apply(spark, values, fn, kind="string"):
    rows = [(i, v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "i int, s string").repartition(8)
    got = df.select("i", fn(F.col("s")).alias("r")).collect()
    return [r["r"] for r in sorted(got, key=lambda r: r["i"])]


def expected_clean(text):
    text = re.sub(r"<[^>]+>", "", html.unescape(text or ""))
    text = re.sub(r"\s+", " ", re.sub(r"http\S+|www\S+", "", text)).strip()
    return re.sub(r"[^\w\s.,!?-]", "", text)


def expected_words(text):
    return re.findall(r"\b[a-z]{3,}\b", text.lower())


EDGES = [
    "&lt;b&gt;x&lt;/b&gt;", "&amp;lt;", "<p>a</p><p>b</p>", "<>", "a < b and c > d", "awwwsome",
    "http", "http alone", "HTTP://X", "see http://a.b/c?d=e now", "a & b", "& b", "a b",
    "a\u001cb", "é", "½", "x\U0001f600y", None, "", "   ", "  a 　",
    "<script>var t='</p>';</script>z", "it's", "a\nb\tc\r\nd", "x_y-z", "İstanbul", "ΣΑΣ",
]


def test_clean_edges(spark):
    assert apply(spark, EDGES, X.clean) == [expected_clean(e) for e in EDGES]


def test_clean_leaves_no_markup(spark):
    for text in apply(spark, EDGES, X.clean):
        assert not set("<>&") & set(text)


def test_character_classes_over_all_of_unicode(spark):
    codes = [c for c in range(0x110000) if not 0xD800 <= c <= 0xDFFF]
    texts = [f"a{chr(c)}b" for c in codes]
    special = apply(spark, texts, X.strip_special_chars)
    spaces = apply(spark, texts, X.collapse_whitespace)
    assert special == [re.sub(r"[^\w\s.,!?-]", "", t) for t in texts]
    assert spaces == [re.sub(r"\s+", " ", t).strip() for t in texts]
    cleaned = [f"abc{s[1:-1]}defg" for s in special]
    assert apply(spark, cleaned, K.tokenize) == [expected_words(t) for t in cleaned]


def test_references_decode_as_the_standard_library_does(spark):
    names = list(html.entities.html5)
    texts = [f"x &{n}y" for n in names] + [f"&{n.rstrip(';')}=1" for n in names]
    numbers = [*range(300), 0xFEFF, 0xD7FF, 0xD800, 0xDFFF, 0xFDD0, 0xFDEF, 0xFFFE, 0x10000]
    numbers += [0x1F600, 0x1FFFE, 0x10FFFF, 0x110000, 10**9, 10**30]
    texts += [f"a&#{n};b&#x{n:x}c&#X{n:X};" for n in numbers]
    texts += ["&", "&&", "&;", "&#;", "&#x;", "&#xg", "&amp;amp;", "&notit;", "&am", "&a b;"]
    chance = random.Random(7)
    parts = ["&", "#", "x", "1", "9", "f", ";", "amp", "lt", "not", "in", " ", "<", "é", "copy"]
    texts += ["".join(chance.choices(parts, k=chance.randint(1, 12))) for _ in range(3000)]
    assert apply(spark, texts, html_unescape) == [html.unescape(t) for t in texts]


KEYWORD_TEXTS = [
    "beta alpha beta gamma alpha delta",
    "covid19 covid naïve éclair e-mail mail don't cat cat_dog",
    "the and for with this that",
    "one two three four five six seven eight nine ten eleven twelve twelve",
    "Alpha ALPHA alpha, beta! beta? gamma.",
    "", None, "a an of", "were not his",
]


def expected_keywords(text, top=10):
    seen = {}
    for word in expected_words(text or ""):
        if word not in K.STOP_WORDS:
            seen[word] = seen.get(word, 0) + 1
    return ",".join(sorted(seen, key=lambda w: -seen[w])[:top])


def test_keywords(spark):
    chance = random.Random(11)
    vocabulary = ["alpha", "beta", "gamma", "delta", "the", "b2b", "éa", "zz", "omega", "pi-pi"]
    texts = KEYWORD_TEXTS + [
        " ".join(chance.choices(vocabulary, k=chance.randint(0, 60))) for _ in range(300)
    ]
    assert apply(spark, texts, K.extract_keywords) == [expected_keywords(t) for t in texts]
    short = apply(spark, texts, lambda c: K.extract_keywords(c, top_n=3))
    assert short == [expected_keywords(t, 3) for t in texts]


def test_stop_words_can_be_replaced(spark):
    words = apply(spark, ["the cat sat"], lambda c: K.drop_stop_words(K.tokenize(c), ["cat"]))
    assert words == [["the", "sat"]]


def test_term_frequency(spark):
    got = apply(spark, ["dog cat dog bird"], lambda c: K.term_frequency(K.tokenize(c)))
    assert {tuple(t) for t in got[0]} == {("dog", 2, 0), ("cat", 1, 1), ("bird", 1, 3)}


@pytest.mark.parametrize("parts,expected", [(("", "", ""), "  "), (("a", None, "c"), "a  c")])
def test_full_text_keeps_its_separators(spark, parts, expected):
    df = spark.createDataFrame([parts], "t string, s string, c string")
    assert df.select(X.join_text(F.col("t"), F.col("s"), F.col("c"))).first()[0] == expected


def test_cleaning_holds_few_texts_as_strings(monkeypatch):
    taken = []
    monkeypatch.setattr(X.F, "arrow_udf", lambda f, _: taken.append(f) or (lambda column: column))
    X.clean(None)
    texts = pa.array([f"<b>{k}</b> é" + "x" * 2000 for k in range(5000)] + [None])
    tracemalloc.start()
    out = taken[0](texts)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(out) == 5001 and out[7].as_py() == "7 é" + "x" * 2000 and out[5000].as_py() == ""
    assert peak < texts.nbytes / 10
    assert len(taken[0](texts.slice(0, 0))) == 0


def test_blanked_texts_are_those_of_the_regular_expression(spark):
    texts = [*EDGES, "a\u00a0b\u3000", "\x0b\x0c\r\n\t x\x1c", "日本\U0001f600e\u0301"]
    assert apply(spark, texts, X.blanked) == apply(spark, texts, lambda c: F.regexp_replace(c, r"\S", " "))
