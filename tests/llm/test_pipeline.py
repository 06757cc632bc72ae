import pytest
from sentencepiece import SentencePieceProcessor

import corpus_pipeline
import public_tokenizers
from newsflow.llm import dedup, simhash
from newsflow.operators.scratch import written
from tests.llm.conftest import SF_DIR
from tests.llm.test_dedup import brute as copies
from tests.llm.test_simhash import brute as near


@pytest.fixture(scope="module")
def steps(spark):
    """What every stage got and gave."""
    docs, out = spark.read.parquet(f"{SF_DIR}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        after = written(stage(spark, docs, SF_DIR), name)
        out.append((name, docs, after))
        docs = after
    return {name: (before, after) for name, before, after in out}


def ids(df):
    return sorted(r.doc_id for r in df.select("doc_id").collect())


def texts(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def test_stages_keep_the_columns_of_the_documents(spark, steps):
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["quality_classifier", "exact_dedup", "simhash_near_dedup", "source_mixing",
                     "sentencepiece_encoding"]
    for name in names[:-1]:
        assert steps[name][1].columns == steps["quality_classifier"][0].columns


def test_quality_stage_drops_what_the_labels_call_bad(spark, steps):
    before, after = map(ids, steps["quality_classifier"])
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet").collect()
    gone = set(before) - set(after)
    bad, good = ({r.doc_id for r in labels if r.quality == q} for q in (0, 1))
    assert gone and len(gone & bad) >= 0.95 * len(bad) and len(gone & good) <= 0.01 * len(good)


def test_exact_stage_equals_brute_force(steps):
    before, after = steps["exact_dedup"]
    assert ids(after) == sorted(r[0] for r in copies(texts(before)) if r[3])
    assert set(texts(after)) <= set(texts(before))


def test_near_stage_equals_brute_force(steps):
    before, after = steps["simhash_near_dedup"]
    assert ids(after) == sorted(i for i, _, c in near(texts(before)) if i == c)


def test_mixing_stage_loses_no_document_and_brings_shares_nearer(steps):
    before, after = steps["source_mixing"]
    assert set(ids(before)) == set(ids(after)) and len(ids(after)) >= len(ids(before))


def test_last_stage_encodes_every_row(steps):
    before, after = steps["sentencepiece_encoding"]
    model = SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    found = sorted((r.doc_id, r.ids, r.decoded) for r in after.collect())
    assert found == sorted((i, model.encode(t), t) for i, t in texts(before))


def test_run_gives_the_rows_of_the_last_stage(spark, steps):
    found = corpus_pipeline.run(spark, SF_DIR)
    last = steps["sentencepiece_encoding"][1]
    assert found.columns == last.columns and found.count() == last.count()


def test_stages_take_an_empty_table(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        docs = written(stage(spark, docs, SF_DIR), name)
    assert docs.count() == 0


def test_operators_of_the_stages_are_native_where_asked(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    plan = dedup.drop_exact_copies(docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
    assert simhash.block_choices(4, 1) == simhash.block_choices(4, 1 << 20)
