import json
import threading

import pytest
from pyspark.sql import functions as F

from newsflow.sources.stored import LOG, StoredTable

SCHEMA = "id long, text string"


def batch(spark, first, n=10, days=1):
    rows = spark.range(first, first + n).withColumn("text", F.lit("x"))
    return rows.withColumn("date", F.expr(f"date_add(date'2024-01-01', cast(id % {days} as int))"))


def ids(table, **bounds):
    return sorted(r.id for r in table.read(SCHEMA, table.folders(**bounds)).collect())


@pytest.fixture
def table(spark, tmp_path):
    return StoredTable(spark, str(tmp_path / "table"))


def test_a_batch_is_read_once_it_is_whole(spark, table):
    assert not table.is_logged() and table.folders() == []
    assert table.append(batch(spark, 0, days=3), "r", 0)
    # Half a batch: its files are there, its entry is not.
    batch(spark, 100).write.partitionBy("date").parquet(f"{table.path}/run=r/batch_id=1/try=half")
    before = table.read(SCHEMA, table.folders())
    assert ids(table) == list(range(10))
    assert table.append(batch(spark, 10), "r", 1)
    assert ids(table) == list(range(20)) and before.count() == 10
    assert ids(table, since="2024-01-02", until="2024-01-02") == [1, 4, 7]
    assert StoredTable(spark, table.path).vacuum(older_than=-60) == 1 and ids(table) == list(range(20))


def test_a_crash_before_the_entry_and_a_replay(spark, table, monkeypatch):
    def crash(*_):
        raise OSError("lost")

    with monkeypatch.context() as m:
        m.setattr(type(table.files), "write", crash)
        with pytest.raises(OSError):
            table.append(batch(spark, 0), "r", 0)
    assert table.folders() == []
    assert table.append(batch(spark, 0), "r", 0) and not table.append(batch(spark, 500), "r", 0)
    assert table.append(batch(spark, 10), "other", 0)
    assert ids(table) == list(range(20))


def test_200_batches_stay_few_files(spark, table):
    counts = []
    for k in range(200):
        table.append(batch(spark, 2 * k, 2).coalesce(1), "r", k)
        if k % 25 == 24:
            table.compact()
            table.vacuum(older_than=-60)
            counts.append(table.files.count())
    assert ids(table) == list(range(400))
    assert max(counts) < 25 and len(table.state().live) < 5
    # All batches are still known after their entries have gone.
    assert not any(table.append(batch(spark, 0), "r", k) for k in (0, 57, 199))
    assert table.state().upto == {"r": 199}


def test_merging_while_a_stream_writes(spark, table):
    for k in range(6):
        table.append(batch(spark, 10 * k, days=2), "r", k)
    errors = []

    def write():
        try:
            for k in range(6, 18):
                StoredTable(spark, table.path).append(batch(spark, 10 * k, days=2), "r", k)
        except Exception as error:  # pragma: no cover
            errors.append(error)

    writer = threading.Thread(target=write)
    writer.start()
    while writer.is_alive():
        table.compact()
        found = ids(table)
        assert len(found) == len(set(found)) and len(found) % 10 == 0 and len(found) >= 60
    writer.join()
    table.compact(least=2)
    assert not errors and ids(table) == list(range(180)) and len(table.state().live) == 2


def test_of_two_merges_of_one_folder_the_first_counts(spark, table):
    for k in range(4):
        table.append(batch(spark, 10 * k), "r", k)
    live = list(table.state().live)
    table.compact()
    batch(spark, 0, 40).drop("date").write.parquet(f"{table.path}/run=merged/batch_id=0/try=late/date=2024-01-01")
    late = {"adds": ["run=merged/batch_id=0/try=late/date=2024-01-01"], "removes": live}
    table.files.write(f"{LOG}/merge-99999999999999999999-x.json", json.dumps(late))
    assert ids(table) == list(range(40))


def test_a_snapshot_that_does_not_end_doubles_nothing(spark, table, monkeypatch):
    for k in range(4):
        table.append(batch(spark, 10 * k), "r", k)
    with monkeypatch.context() as m:
        m.setattr(type(table.files), "delete", lambda *_: None)
        table.compact()  # nothing that it covers goes
    assert ids(table) == list(range(40))
    table.release()
    table.append(batch(spark, 40), "r", 4)
    table.snapshot()
    assert ids(table) == list(range(50))
    assert [n for n, _ in table.files.listed(LOG) if n.startswith(("batch-", "merge-"))] == []
    table.append(batch(spark, 50), "r", 5)
    assert ids(table) == list(range(60)) and not table.append(batch(spark, 0), "r", 1)


def test_one_merge_at_a_time(spark, table):
    table.append(batch(spark, 0), "r", 0)
    table.files.claim(f"{LOG}/merging")
    with pytest.raises(RuntimeError):
        table.compact()
    table.release()
    assert table.compact() == 0  # too few folders to merge


def test_large_folders_are_left_alone_and_files_have_the_target_size(spark, table):
    for k in range(5):
        table.append(batch(spark, 1000 * k, 1000), "r", k)
    sizes = [table.files.bytes_of(f) for f in table.folders()]
    assert table.compact(target_bytes=max(sizes)) == 0
    assert table.compact(target_bytes=3 * max(sizes)) == 5
    assert ids(table) == list(range(5000)) and len(table.read(SCHEMA, table.folders()).inputFiles()) == 2


def test_an_empty_batch_and_one_without_date(spark, table):
    assert table.append(batch(spark, 0, 0), "r", 0) and table.folders() == []
    dateless = batch(spark, 0, 3).withColumn("date", F.lit(None).cast("date"))
    assert table.append(dateless, "r", 1) and ids(table) == [0, 1, 2]
    assert not table.append(batch(spark, 0), "r", 0)
