import pytest
from pyspark.sql import functions as F

from newsflow.operators import dashboard as D
from newsflow.operators import reports as R
from newsflow.operators import tallies as T
from newsflow.schemas import PROCESSED
from newsflow.sources.articles import read_processed
from newsflow.streaming import jobs


def articles(spark, first, n=40, day="2024-01-01"):
    row = spark.range(first, first + n)
    pick = {
        "category": "CASE id % 3 WHEN 0 THEN 'world' WHEN 1 THEN 'science' END",
        "source": "concat('s', id % 4)",
        "sentiment": "CASE id % 4 WHEN 0 THEN 'positive' WHEN 1 THEN 'negative' ELSE 'neutral' END",
        "sentiment_compound": "CAST(id % 7 / 10.0 - 0.3 AS float)",
        "text_length": "CAST(id % 11 AS int)",
        "keywords": "CASE id % 5 WHEN 0 THEN '' WHEN 1 THEN NULL ELSE concat('w', id % 6, ', Word,x') END",
        "processed_at": f"CAST(timestamp'{day} 00:00:00' + make_interval(0, 0, 0, 0, 0, 0, CAST(id % 37 * 600 AS int)) AS timestamp)",
        "id": "CAST(id AS string)", "title_clean": "concat('t', id)",
    }
    kinds = {f.name: f.dataType.simpleString() for f in PROCESSED}
    return row.select(*[F.expr(f"CAST({pick.get(c, 'NULL')} AS {kind})").alias(c) for c, kind in kinds.items()])


def plain(df):
    return sorted(
        (tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in df.collect()), key=repr
    )


def expected(df, **facets):
    chosen = D.filter_articles(df, **facets)
    return {
        "kpis": D.kpis(chosen), "sentiment_counts": D.SENTIMENT_COUNTS.over(chosen),
        "category_counts": D.CATEGORY_COUNTS.over(chosen),
        "category_sentiment_counts": D.CATEGORY_SENTIMENT_COUNTS.over(chosen),
        "articles_over_time": D.articles_over_time(chosen), "top_keywords": D.top_keywords(chosen),
        "source_stats": D.SOURCE_STATS.over(chosen), "latest": R.latest_articles(chosen),
    }


def equal(table, spark, **facets):
    view = table.view(**facets)
    for name, df in expected(read_processed(spark, table.table.path), **facets).items():
        assert plain(view[name]) == plain(df), name


@pytest.fixture
def path(tmp_path):
    return str(tmp_path / "table")


def store(spark, path, first, batch_id, day="2024-01-01", n=40):
    return jobs.write_batch(articles(spark, first, n, day), batch_id, path, "r", T.TalliedTable)


def test_views_equal_single_figures_after_replays_and_merges(spark, path, monkeypatch):
    for k in range(4):
        assert store(spark, path, 40 * k, k, f"2024-01-0{1 + k % 2}")
    assert not store(spark, path, 999, 2)
    table = T.TalliedTable(spark, path)
    assert table.is_complete()
    equal(table, spark)
    equal(table, spark, category="world", sentiment="positive")
    # A crash between the articles and their tallies, then the replay.
    with monkeypatch.context() as m:
        m.setitem(T.TALLIES, "keywords", lambda df: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            store(spark, path, 160, 4)
    assert not table.is_complete()
    with pytest.raises(RuntimeError):
        table.compact()
    assert store(spark, path, 160, 4) and table.is_complete()
    equal(table, spark)
    assert table.compact(least=2) > 0
    assert all(len(stored.folders()) == 2 for stored in table.tallies.values())
    equal(table, spark, source="s1")
    assert store(spark, path, 200, 5)
    equal(table, spark)


def test_views_read_tallies_and_few_articles(spark, path):
    for k in range(3):
        store(spark, path, 40 * k, k, f"2024-01-{10 + k}")
    view = T.TalliedTable(spark, path).view()
    for name, df in view.items():
        if name != "latest":
            assert all("_tallies" in f for f in df.inputFiles()), name
    read = {f.rpartition("/")[0].rpartition("date=")[2] for f in view["latest"].inputFiles()}
    assert read == {"2024-01-12", "2024-01-11"}


def test_latest_stops_early_and_equals_the_whole_table(spark, path):
    for k in range(6):
        store(spark, path, 40 * k, k, f"2024-02-{10 + k}", n=3 if k > 2 else 40)
    whole = read_processed(spark, path)
    for limit, facets in ((3, {}), (10, {}), (50, {}), (1000, {}), (5, {"category": "world"}), (2, {"source": "none"})):
        found = T.latest_stored(spark, path, limit, **facets)
        df = D.filter_articles(whole, **facets)
        assert found.collect() == R.latest_articles(df, limit).collect()
    assert len(T.latest_stored(spark, path, 3).inputFiles()) < len(whole.inputFiles())
    assert len(T.latest_stored(spark, path, 1000).inputFiles()) == len(whole.inputFiles())


def test_latest_without_times_ties_and_no_table(spark, path):
    assert T.latest_stored(spark, path).collect() == []
    same = articles(spark, 0, 12).withColumn("processed_at", F.lit("2024-01-01 10:00:00").cast("timestamp"))
    none = articles(spark, 50, 3).withColumn("processed_at", F.lit(None).cast("timestamp"))
    jobs.write_batch(same, 0, path, "r", T.TalliedTable)
    jobs.write_batch(none, 1, path, "r", T.TalliedTable)
    found = [r.title_clean for r in T.latest_stored(spark, path, 5).collect()]
    assert found == ["t0", "t1", "t10", "t11", "t2"]
    assert len(T.latest_stored(spark, path, 14).collect()) == 14
    equal(T.TalliedTable(spark, path), spark)
