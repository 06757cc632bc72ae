import datetime as dt

import pytest

from newsflow.operators import dashboard as D
from newsflow.operators import reports as R
from newsflow.schemas import PROCESSED
from newsflow.sources.articles import read_processed

NOON = dt.datetime(2024, 1, 1, 12, 30)


def article(i, category, source, sentiment, compound, keywords, length=10, at=NOON):
    return (
        f"id{i}", f"l{i}", "a", None, source, category, None, f"title {i}", "text", keywords,
        length, sentiment, compound, 0.0, 0.0, 1.0, at,
    )


@pytest.fixture(scope="module")
def articles(spark):
    later = NOON + dt.timedelta(hours=2)
    rows = [
        article(1, "world", "a", "positive", 0.5, "sun,sea", 10),
        article(2, "world", "a", "negative", -0.5, "sun,Sea", 20),
        article(3, "world", None, "positive", 0.1, "", 30),
        article(4, None, "b", "neutral", 0.0, None, 40, later),
        article(5, "business", "b", "positive", 0.3, "sea", None, later),
    ]
    return spark.createDataFrame(rows, PROCESSED)


def listed(df):
    return [tuple(r) for r in df.collect()]


def test_grouped_reports_keep_null_keys(articles):
    assert listed(R.SENTIMENT_DISTRIBUTION.over(articles)) == [
        ("positive", 3), ("negative", 1), ("neutral", 1),
    ]
    assert listed(R.SENTIMENT_PIVOT.over(articles)) == [
        (None, 0, 0, 1), ("business", 1, 0, 0), ("world", 2, 1, 0),
    ]
    sources = {r[0]: r[1:] for r in listed(R.SOURCE_ANALYSIS.over(articles))}
    assert sources["b"] == (2, pytest.approx(0.15), 40.0)
    assert sources[None][0] == 1
    assert listed(R.HOURLY_ACTIVITY.over(articles)) == [(12, 3), (14, 2)]


def test_top_keywords(articles):
    assert listed(R.top_keywords(articles)) == [("sea", 3), ("sun", 2)]
    assert listed(R.top_keywords(articles, limit=1)) == [("sea", 3)]
    assert listed(D.top_keywords(articles)) == [("sea", 2), ("sun", 2), ("", 1), ("Sea", 1)]


def test_dashboard_counts_drop_null_keys(articles):
    assert listed(D.CATEGORY_COUNTS.over(articles)) == [("world", 3), ("business", 1)]
    assert [r[0] for r in listed(D.SOURCE_STATS.over(articles))] == ["a", "b"]
    assert ("world", "positive", 2) in listed(D.CATEGORY_SENTIMENT_COUNTS.over(articles))


def test_filters_and_kpis(articles):
    chosen = D.filter_articles(articles, category="world", sentiment="positive")
    assert listed(D.kpis(chosen)) == [(2, pytest.approx(0.3), 100.0, 20.0)]
    assert D.filter_articles(articles).count() == 5
    nothing = D.filter_articles(articles, source="nowhere")
    assert listed(D.kpis(nothing)) == [(0, None, None, None)]
    assert listed(D.facet_values(articles, "category")) == [("business",), ("world",)]
    assert listed(D.facet_values(articles, "source", with_all=True)) == [("All",), ("a",), ("b",)]


def test_latest_breaks_ties_by_id(articles):
    assert [r[0] for r in listed(R.latest_articles(articles, 3))] == [
        "title 4", "title 5", "title 1",
    ]


def test_articles_over_time_sums_to_all(articles):
    assert sum(r[1] for r in listed(D.articles_over_time(articles))) == 5


def test_run_reports_equals_single_reports(spark, articles):
    together = R.run_reports(articles)
    for name, report in R.TALLIED.items():
        assert listed(together[name]) == listed(report.over(articles)), name
    assert listed(together["top_keywords"]) == listed(R.top_keywords(articles))
    together["tally"].unpersist()
    assert R.run_reports(spark.createDataFrame([], PROCESSED)) == {}


def test_grouped_report_aggregates_before_the_shuffle(articles):
    plan = R.CATEGORY_SENTIMENT.over(articles)._jdf.queryExecution().executedPlan().toString()
    assert "partial_count" in plan


def test_board_reads_views_and_refreshes(spark, articles, tmp_path):
    path = str(tmp_path / "processed")
    assert read_processed(spark, path).count() == 0
    articles.write.parquet(f"{path}/batch_id=0")
    board = D.ArticleBoard(spark, path)
    view = board.view(category="world")
    assert listed(view["sentiment_counts"]) == [("positive", 2), ("negative", 1)]
    assert "full_text" not in board.articles().columns
    assert listed(board.facets("sentiment"))[0] == ("All",)
    articles.write.parquet(f"{path}/batch_id=1")
    assert board.articles().count() == 5
    assert board.refresh().count() == 10


@pytest.mark.parametrize(
    "facets", [{}, {"category": "world"}, {"source": "none such"}, {"sentiment": "positive"}]
)
def test_views_equal_the_single_figures(spark, articles, tmp_path, facets):
    path = str(tmp_path / "processed")
    articles.write.parquet(f"{path}/batch_id=0")
    board = D.ArticleBoard(spark, path)
    view, chosen = board.view(**facets), D.filter_articles(board.articles(), **facets)
    single = {
        "kpis": D.kpis(chosen),
        "sentiment_counts": D.SENTIMENT_COUNTS.over(chosen),
        "category_counts": D.CATEGORY_COUNTS.over(chosen),
        "category_sentiment_counts": D.CATEGORY_SENTIMENT_COUNTS.over(chosen),
        "articles_over_time": D.articles_over_time(chosen),
        "top_keywords": D.top_keywords(chosen),
        "source_stats": D.SOURCE_STATS.over(chosen),
        "latest": R.latest_articles(chosen),
    }
    for name, df in single.items():
        assert listed(view[name]) == listed(df), name
        assert view[name].schema.simpleString() == df.schema.simpleString(), name


def test_stored_filter_reaches_the_scan(spark, articles, tmp_path):
    path = str(tmp_path / "scan")
    articles.write.parquet(f"{path}/batch_id=0")
    chosen = D.filter_articles(read_processed(spark, path), category="world")
    plan = D.SENTIMENT_COUNTS.over(chosen)._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(category,world)" in plan
    assert "full_text" not in plan
