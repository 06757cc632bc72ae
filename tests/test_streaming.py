import datetime as dt
import json
import time

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from newsflow.operators import sentiment as N
from newsflow.operators.enrich import process_articles
from newsflow.operators.identity import dedupe_first_wins, dedupe_stream
from newsflow.schemas import PROCESSED, RAW_FIELDS
from newsflow.sources.articles import decode_articles, read_processed
from newsflow.sources.feeds import registry_from_settings
from newsflow.streaming import jobs
from tests.test_sources import RSS, URLS, land

ONCE = {"availableNow": True}


@pytest.fixture(scope="module")
def process(spark):
    marks = N.prepare_marks(N.token_marks(N.sample_lexicon(spark)))
    return lambda df: process_articles(df, marks)


def write_messages(folder, name, articles):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(articles) + "\n")


def message(i, content="<p>good day</p>"):
    return json.dumps({name: f"{name} {i}" for name in RAW_FIELDS} | {"content": content})


def run(spark, source, **options):
    stream = spark.readStream.format("text").load(str(source))
    query = jobs.start_processing(stream, trigger=ONCE, **options)
    query.awaitTermination(120)
    assert query.exception() is None


def stored(spark, path):
    keep = [c for c in PROCESSED.fieldNames() if c != "processed_at"]
    return sorted((tuple(r) for r in read_processed(spark, path).select(*keep).collect()), key=repr)


def test_stream_equals_batch_and_resumes(spark, process, tmp_path):
    source, out = tmp_path / "in", str(tmp_path / "out")
    options = {"process": process, "path": out, "checkpoint": str(tmp_path / "state")}
    write_messages(source, "1.json", [message(1), message(2, "bad &amp; worse"), '{"cut'])
    run(spark, source, **options)
    assert read_processed(spark, out).schema == PROCESSED
    assert len(stored(spark, out)) == 3
    write_messages(source, "2.json", [message(3), message(1)])
    run(spark, source, **options)
    batch = process(decode_articles(spark.read.text(str(source)))).drop("processed_at")
    assert stored(spark, out) == sorted((tuple(r) for r in batch.collect()), key=repr)
    blank = [r for r in stored(spark, out) if r[0] is None]
    assert [(r[8], r[9], r[10], r[11]) for r in blank] == [("  ", "", 2, "neutral")]


def test_a_replayed_batch_replaces_itself(spark, process, tmp_path):
    out = str(tmp_path / "out")
    rows = spark.createDataFrame([(message(1),), (message(2),)], "value string")
    for _ in range(2):
        jobs.write_batch(process(decode_articles(rows)), 7, out, "r1")
    assert read_processed(spark, out).count() == 2
    jobs.write_batch(process(decode_articles(rows)), 7, out, "r2")
    assert read_processed(spark, out).count() == 4


def ids(spark, path):
    return sorted(r["id"] for r in read_processed(spark, path).select("id").collect())


def test_a_change_of_sink_goes_on_with_the_table(spark, process, tmp_path):
    source, out = tmp_path / "in", str(tmp_path / "out")
    options = {"process": process, "path": out, "checkpoint": str(tmp_path / "state")}
    for i, sink in enumerate(("parquet", "both", "parquet")):
        write_messages(source, f"{i}.json", [message(i)])
        run(spark, source, sink=sink, **options)
        assert ids(spark, out) == [f"id {k}" for k in range(i + 1)]


def test_a_new_checkpoint_or_a_second_query_destroys_nothing(spark, process, tmp_path):
    out = str(tmp_path / "out")
    for i in range(2):
        source = tmp_path / f"in{i}"
        write_messages(source, "1.json", [message(i)])
        run(spark, source, process=process, path=out, checkpoint=str(tmp_path / f"state{i}"))
    assert ids(spark, out) == ["id 0", "id 1"]


def test_dates_prune_the_stored_table(spark, process, tmp_path):
    out = str(tmp_path / "out")
    rows = spark.createDataFrame([(message(1),)], "value string")
    for day in ("2024-01-01", "2024-01-02", "2024-01-03"):
        stamped = process(decode_articles(rows)).withColumn(
            "processed_at", F.lit(f"{day} 12:00:00").cast("timestamp")
        )
        jobs.write_batch(stamped, 0, out, day)
    one = read_processed(spark, out, since="2024-01-02", until="2024-01-02")
    assert [str(r[0].date()) for r in one.select("processed_at").collect()] == ["2024-01-02"]
    assert len(one.inputFiles()) == 1 and "date=2024-01-02" in one.inputFiles()[0]


def test_malformed_messages_are_kept_aside(spark, process, tmp_path):
    source, out, aside = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "aside")
    write_messages(source, "1.json", [message(1), '{"cut', "[]"])
    run(spark, source, process=process, path=out, checkpoint=str(tmp_path / "state"),
        malformed="drop", quarantine=aside)
    assert ids(spark, out) == ["id 1"]
    assert sorted(r["value"] for r in spark.read.parquet(aside).collect()) == ["[]", '{"cut']


def test_console_alone_prints_its_rows(spark, process, tmp_path, capfd):
    source = tmp_path / "in"
    write_messages(source, "1.json", [message(i) for i in range(3)])
    run(spark, source, process=process, sink="console", checkpoint=str(tmp_path / "state"),
        console_rows=2)
    printed = capfd.readouterr().out
    assert "batch 0" in printed and "only showing top 2 rows" in printed


def test_both_sinks_share_one_run(spark, process, tmp_path, capfd):
    source, out = tmp_path / "in", str(tmp_path / "out")
    write_messages(source, "1.json", [message(1)])
    run(spark, source, process=process, sink="both", path=out, checkpoint=str(tmp_path / "state"))
    assert read_processed(spark, out).count() == 1
    assert "title 1" in capfd.readouterr().out


def test_bad_settings_are_refused(spark, process, tmp_path):
    (tmp_path / "in").mkdir()
    stream = spark.readStream.format("text").load(str(tmp_path / "in"))
    with pytest.raises(ValueError):
        jobs.start_processing(stream, process, sink="printer")
    with pytest.raises(ValueError):
        jobs.start_processing(stream, process, sink="parquet")


def test_checkpoint_root_comes_from_the_session(spark):
    assert jobs.checkpoint_root(spark) == spark.conf.get("spark.checkpoint.dir")
    assert jobs.checkpoint_root(spark, "/shared/") == "/shared"


def test_feed_stream_passes_an_id_once_across_runs(spark, tmp_path):
    landing, state, out = tmp_path / "feeds", str(tmp_path / "state"), str(tmp_path / "out")
    registry = registry_from_settings(spark, {"RSS_FEEDS_WORLD": ",".join(URLS)})

    def poll():
        articles = jobs.feed_articles_stream(spark, str(landing), registry)
        query = (
            articles.writeStream.format("parquet")
            .option("path", out)
            .option("checkpointLocation", state)
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination(120)
        return sorted(r["link"] for r in spark.read.parquet(out).collect())

    land(landing, URLS[0], RSS.format(name="First", link="2"))
    land(landing, URLS[1], RSS.format(name="Second", link="3"))
    assert poll() == ["", "http://n/1", "http://n/2", "http://n/3"]
    land(landing, URLS[0], RSS.format(name="First", link="5"), "2.xml")
    assert poll() == ["", "http://n/1", "http://n/2", "http://n/3", "http://n/5"]


ARRIVALS = (
    "id string, link string, ingested_at timestamp, "
    "category_pos int, feed_pos int, entry_pos int"
)


def passed(spark, tmp_path, *batches, **options):
    """Rows that pass when every batch lands before a run of its own."""
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    for rows in batches:
        spark.createDataFrame(rows, ARRIVALS).write.mode("append").parquet(source)
        stream = dedupe_stream(spark.readStream.schema(ARRIVALS).parquet(source), **options)
        query = (
            stream.writeStream.format("parquet")
            .option("path", out)
            .option("checkpointLocation", str(tmp_path / "state"))
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination(120)
        assert query.exception() is None
    return sorted(map(tuple, spark.read.parquet(out).collect()))


def test_hot_id_in_a_stream(spark, tmp_path):
    at = dt.datetime(2024, 1, 1)
    rows = [("hot" if i % 2 else f"id{i}", "x", at, 0, 0, i) for i in range(200)]
    ids = [r[0] for r in passed(spark, tmp_path, rows)]
    assert len(ids) == len(set(ids)) == 101


def test_the_stream_keeps_the_row_that_the_batch_keeps(spark, tmp_path):
    at = dt.datetime(2024, 3, 1)
    rows = [(f"id{i % 5}", f"l{i}", at, 3 - i // 5 % 4, i % 2, i) for i in range(40)]
    expected = dedupe_first_wins(spark.createDataFrame(rows, ARRIVALS)).collect()
    assert passed(spark, tmp_path, rows) == sorted(map(tuple, expected))


def test_a_late_article_passes_and_a_known_one_does_not(spark, tmp_path):
    new, late = dt.datetime(2024, 3, 1), dt.datetime(2024, 1, 1)
    found = passed(
        spark, tmp_path, [("a", "l", new, 1, 0, 0)], [("b", "l", late, 1, 0, 0)],
        [("a", "again", late, 0, 0, 0), ("c", "l", new, 0, 0, 0)],
    )
    assert [(r[0], r[1]) for r in found] == [("a", "l"), ("b", "l"), ("c", "l")]


def test_a_lost_checkpoint_begins_with_the_stored_ids(spark, tmp_path):
    at = dt.datetime(2024, 1, 1)
    rows = [(f"id{i}", f"l{i}", at, 0, 0, i) for i in range(20)]
    stored = spark.createDataFrame([(f"id{i}",) for i in range(15)] * 2 + [(None,)], "id string")
    found = passed(spark, tmp_path, rows, rows + [("new", "l", at, 0, 0, 0)], known=stored)
    assert [r[0] for r in found] == ["id15", "id16", "id17", "id18", "id19", "new"]


@pytest.mark.parametrize("horizon, expected", [("1 hour", 1), ("1 second", 2)])
def test_an_id_passes_again_after_the_horizon(spark, tmp_path, horizon, expected):
    source, out, at = str(tmp_path / "in"), str(tmp_path / "out"), dt.datetime(2024, 1, 1)
    spark.createDataFrame([], ARRIVALS).write.parquet(source)
    stream = dedupe_stream(spark.readStream.schema(ARRIVALS).parquet(source), horizon)
    writer = stream.writeStream.format("parquet").option("path", out)
    writer = writer.option("checkpointLocation", str(tmp_path / "state"))
    query = writer.trigger(processingTime="200 milliseconds").start()
    try:
        for marker in ("first", "second"):
            rows = [("a", "l", at, 0, 0, 0), (marker, "l", at, 0, 0, 0)]
            spark.createDataFrame(rows, ARRIVALS).coalesce(1).write.mode("append").parquet(source)
            deadline = time.monotonic() + 60
            while time.monotonic() < deadline:
                time.sleep(2)
                try:
                    found = [r.id for r in spark.read.schema(ARRIVALS).parquet(out).collect()]
                except AnalysisException:  # nothing is written yet
                    continue
                if marker in found:
                    break
    finally:
        query.stop()
    assert found.count("a") == expected and {"first", "second"} <= set(found)


def test_feeds_after_a_lost_checkpoint(spark, process, tmp_path):
    landing, out = tmp_path / "feeds", str(tmp_path / "out")
    registry = registry_from_settings(spark, {"RSS_FEEDS_WORLD": ",".join(URLS)})

    def poll(state):
        articles = jobs.feed_articles_stream(spark, str(landing), registry, stored=out)
        store = (lambda df, n: jobs.write_batch(process(df), n, out, state))
        query = articles.writeStream.foreachBatch(store).option("checkpointLocation", str(tmp_path / state))
        query.trigger(availableNow=True).start().awaitTermination(120)
        return sorted(r["link"] for r in read_processed(spark, out).select("link").collect())

    land(landing, URLS[0], RSS.format(name="First", link="2"))
    assert poll("a") == ["", "http://n/1", "http://n/2"]
    land(landing, URLS[1], RSS.format(name="Second", link="3"))
    assert poll("b") == ["", "http://n/1", "http://n/2", "http://n/3"]
