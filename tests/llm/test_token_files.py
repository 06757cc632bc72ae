import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.dataset as ds
import pyarrow.orc as orc
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from newsflow.llm import token_files as T

PATH = public_tokenizers.path("byte_bpe_50k.json")
ROWS = [
    (3, "Hello there"), (1, None), (2, ""), (9, "é" * 50_000), (7, "<|endoftext|> x"), (5, "a\nb"),
    (5, "a\nb"), (5, "other"), (None, "no id"),
]


TOKENIZER = Tokenizer.from_file(PATH)


def ids_of(text):
    return [*TOKENIZER.encode(text or "", add_special_tokens=False).ids, 0]


def expected(rows):
    out, start = [], 0
    for doc_id, text in rows:
        ids = ids_of(text)
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes())))
        start += len(ids)
    return out


def files(frame, tmp_path, rows, n=4):
    df = frame([(*r, 1, "p") for r in rows], "doc_id long, text string, part int, ids string")
    T.write_token_files(df, path := str(tmp_path / "ids"), PATH, files=n)
    return path


def test_whole_table(spark, documents, tmp_path, frame):
    rows = [(r["doc_id"], r["text"]) for r in documents]
    path = files(frame, tmp_path, rows, 7)
    found = sorted(map(tuple, T.token_digests(spark, path).collect()))
    assert found == expected(sorted(rows))
    parts = sorted(ds.dataset(path, format="orc").files)
    read = [i for p in parts for i in orc.read_table(p, columns=["doc_id"])["doc_id"].to_pylist()]
    assert read == sorted(read) and len(parts) > 1


def test_odd_rows_round_trip(spark, frame, tmp_path):
    path = files(frame, tmp_path, ROWS)
    stored = [(r.doc_id, list(r.ids)) for r in
              T.read_token_files(spark, path).orderBy("place").collect()]
    assert [i for i, _ in stored] == [None, 1, 2, 3, 5, 5, 5, 7, 9]
    assert sorted(map(repr, stored)) == sorted(repr((i, ids_of(t))) for i, t in ROWS)
    found = T.token_digests(spark, path).orderBy("start").collect()
    assert [r.n_tokens for r in found] == [len(ids) for _, ids in stored]
    assert [r.start for r in found] == list(np.cumsum([0] + [len(x) for _, x in stored])[:-1])
    assert TOKENIZER.decode(stored[-1][1][:-1], skip_special_tokens=False) == "é" * 50_000


def test_files_have_bloom_filters_and_stripes(spark, frame, tmp_path):
    path = files(frame, tmp_path, ROWS, 1)
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    [part] = [f for f in ds.dataset(path, format="orc").files]
    reader = jvm.org.apache.orc.OrcFile.createReader(
        jvm.org.apache.hadoop.fs.Path(part), jvm.org.apache.orc.OrcFile.readerOptions(conf)
    )
    assert reader.getStripes().size() == 1 and reader.getRowIndexStride() == T.STRIDE
    streams = [s.getKind().toString() for s in
               reader.rows().readStripeFooter(reader.getStripes().get(0)).getStreamsList()]
    assert "BLOOM_FILTER_UTF8" in streams and "ROW_INDEX" in streams
    look_up = T.read_token_files(spark, path).where("doc_id = 7")
    assert "PushedFilters: [IsNotNull(doc_id), EqualTo(doc_id,7)]" in (
        look_up._jdf.queryExecution().toString()
    )
    assert [r.doc_id for r in look_up.collect()] == [7]


# White space of one kind or another, separators that only some call so, and apostrophes.
ODD = [*"  \n\t\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2003\u2028\u3000''sta.,-é日", "<|endoftext|>"]


def test_separators_before_apostrophes():
    for text in ("x\x1c's", "a\x1f'll b", "caf\x1d'tis", "ok\x1e're", "x\xa0 y \u3000z \x85 's"):
        assert T._encoder(PATH).encode(pa.array([text]))[0].tolist() == ids_of(text)


@settings(max_examples=2000, deadline=None)
@given(st.lists(st.one_of(st.characters(codec="utf-8"), st.sampled_from(ODD)), max_size=40).map("".join))
def test_words_are_encoded_as_in_whole_texts(text):
    encoder = T._encoder(PATH)
    assert encoder.separable
    ids, sizes = encoder.encode(pa.array([text]))
    assert ids.tolist() == ids_of(text) and sizes.tolist() == [len(ids)]


def test_spaces_marks_and_apostrophes_and_forgetting(monkeypatch):
    monkeypatch.setattr(T, "REMEMBERED", 30)
    encoder, rng = T.Encoder(PATH), random.Random(2)
    texts = ["".join(rng.choice("ab'sd1²½ \n\t\xa0\0\x1c\x1f\x85 .,-日é🙂_") for _ in range(rng.randrange(40)))
             for _ in range(5000)]
    for some in (texts[i : i + 7] for i in range(0, len(texts), 7)):
        ids, sizes = encoder.encode(pa.array(some))
        assert ids.tolist() == [i for t in some for i in ids_of(t)]
        assert sizes.tolist() == [len(ids_of(t)) for t in some]


def test_rules_that_do_not_separate_words_encode_whole_texts():
    path = public_tokenizers.path("word_bpe_49k.json")
    encoder, plain = T.Encoder(path), Tokenizer.from_file(path)
    assert not encoder.separable
    ids, sizes = encoder.encode(pa.array(["Hello there, World", ""]))
    expected = [*plain.encode("Hello there, World", add_special_tokens=False).ids, 0, 0]
    assert ids.tolist() == expected and sizes.tolist() == [len(expected) - 1, 1]


def test_empty_table(spark, tmp_path):
    df = spark.createDataFrame([], "doc_id long, text string")
    T.write_token_files(df, path := str(tmp_path / "ids"), PATH, files=2)
    assert T.token_digests(spark, path).collect() == []


def test_added_tokens_in_a_text_as_the_library_encodes_them():
    texts = ["a <|endoftext|> b", "<|endoftext|>", "x<|endoftext|><|endoftext|>'s  y\n", "<|endoftext|", "a b",
             "<|endoftext|> " * 3 + "long " * 50]
    plain, encoder = Tokenizer.from_file(PATH), T.Encoder(PATH)
    expected = [[*plain.encode(t, add_special_tokens=False).ids, 0] for t in texts]
    assert expected[0] == [64, 220, 50256, 275, 0]
    for _ in range(2):
        ids, sizes = encoder.encode(pa.array(texts))
        assert ids.tolist() == [i for x in expected for i in x]
        assert sizes.tolist() == [len(x) for x in expected]
