import hashlib
import json

import pytest
from pyspark.sql import functions as F

from newsflow.operators.identity import article_id, dedupe_first_wins
from newsflow.schemas import RAW_FIELDS
from newsflow.sources import articles as M
from newsflow.sources import feeds as S
from newsflow.streaming import jobs

RSS = """<?xml version="1.0"?><rss version="2.0" xmlns:content="c" xmlns:dc="d"><channel>
<title>{name}</title>
<item><title>One &amp; only</title><link>http://n/1</link><description>&lt;p&gt;s&lt;/p&gt;</description>
<content:encoded><![CDATA[<b>full</b>]]></content:encoded><dc:creator>Ann</dc:creator>
<pubDate>Mon</pubDate></item>
<item><title>Two</title><link>http://n/{link}</link></item>
<item><title>No link</title></item>
</channel></rss>"""
ATOM = """<?xml version="1.0"?><feed xmlns="http://www.w3.org/2005/Atom"><title>Atom feed</title>
<entry><title>A</title><link rel="self" href="http://n/self"/><link href="http://n/a"/>
<summary>s</summary><content type="html">body</content><author><name>Bo</name></author>
<updated>2024</updated></entry>
<entry><title>B</title><link rel="alternate" href="http://n/b"/></entry></feed>"""
RDF = """<?xml version="1.0"?><rdf:RDF xmlns:rdf="r" xmlns="http://purl.org/rss/1.0/" xmlns:dc="d">
<channel><title>Old feed</title><link>http://o</link></channel>
<item><title>O1</title><link>http://n/o1</link><description>d</description><dc:date>2003</dc:date></item>
<item><title>O2</title><link>http://n/o2</link></item></rdf:RDF>"""
GUIDS = """<rss><channel><title>G</title>
<item><title>g1</title><guid>http://n/g1</guid></item>
<item><title>g2</title><guid isPermaLink="true">http://n/g2</guid></item>
<item><title>g3</title><guid isPermaLink="false">tag:3</guid></item>
<item><title>g4</title><link>http://n/g4</link><guid isPermaLink="true">http://n/x</guid></item>
</channel></rss>"""
XHTML = """<feed xmlns="http://www.w3.org/2005/Atom"><title>X</title><entry><title>x</title>
<link href="http://n/x"/><content type="xhtml"><div><p>One <b>two</b></p></div></content></entry>
<entry><title>h</title><link href="http://n/h"/><content type="html">&lt;p&gt;t&lt;/p&gt;</content>
</entry></feed>"""
URLS = ("http://f/one", "http://f/two")


def md5(text):
    return hashlib.md5(text.encode()).hexdigest()


def land(root, url, text, name="1.xml"):
    folder = root / md5(url)
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text(text)


@pytest.fixture
def registry(spark):
    settings = {
        "RSS_FEEDS_WORLD": f" {URLS[1]} ,",
        "RSS_FEEDS_TECHNOLOGY": f"{URLS[0]}, {URLS[1]}",
        "OTHER": "http://x",
    }
    return S.registry_from_settings(spark, settings)


def test_registry(registry):
    assert [tuple(r) for r in registry.orderBy("category_pos", "feed_pos").collect()] == [
        (URLS[0], "technology", 0, 0),
        (URLS[1], "technology", 0, 1),
        (URLS[1], "world", 3, 0),
    ]


def test_rss_to_articles(spark, registry, tmp_path):
    land(tmp_path, URLS[0], RSS.format(name="First", link="2"))
    land(tmp_path, URLS[1], RSS.format(name="Second", link="3"))
    land(tmp_path, URLS[1], RSS.format(name="Cut", link="4")[:-40], "broken.xml")
    entries = S.read_feeds(spark, str(tmp_path))
    placed = S.attach_category(entries, registry, F.col("feed_key"))
    order = ("category_pos", "feed_pos", "entry_pos")
    raw = S.normalize_articles(placed, *order)
    assert raw.columns == RAW_FIELDS + list(order)
    assert raw.count() == 9
    first = dedupe_first_wins(raw, order)
    rows = {r["link"]: r for r in first.collect()}
    assert set(rows) == {"http://n/1", "http://n/2", "http://n/3", ""}
    one = rows["http://n/1"]
    assert (one["source"], one["category"], one["author"]) == ("First", "technology", "Ann")
    assert (one["title"], one["summary"], one["content"]) == (
        "One & only", "<p>s</p>", "<b>full</b>",
    )
    assert one["id"] == md5("http://n/1") and one["published"] == "Mon"
    two = rows["http://n/2"]
    assert (two["author"], two["content"], two["published"]) == ("Unknown", "", two["crawled_at"])
    assert rows[""]["id"] == "d41d8cd98f00b204e9800998ecf8427e"
    assert dedupe_first_wins(raw, order, linkless="keep").count() == 6


def test_atom(spark, tmp_path):
    land(tmp_path, URLS[0], ATOM)
    rows = S.read_feeds(spark, str(tmp_path), "atom").orderBy("entry_pos").collect()
    assert [(r["title"], r["link"], r["source"]) for r in rows] == [
        ("A", "http://n/a", "Atom feed"), ("B", "http://n/b", "Atom feed"),
    ]
    assert (rows[0]["content"], rows[0]["author"], rows[0]["published"]) == ("body", "Bo", "2024")


MESSAGES = [
    json.dumps({name: name.upper() for name in RAW_FIELDS}),
    json.dumps({"id": "p", "title": "t", "link": "l"}),
    json.dumps({"id": None, "title": 1, "source": {"a": 2}}),
    "[1, 2]", '{"id": "cu', "", None,
]


def test_decode(spark):
    messages = spark.createDataFrame([(m,) for m in MESSAGES], "value string")
    rows = M.decode_articles(messages).collect()
    assert len(rows) == len(MESSAGES)
    assert rows[0].asDict() == {name: name.upper() for name in RAW_FIELDS}
    assert (rows[1]["id"], rows[1]["summary"]) == ("p", None)
    assert (rows[2]["id"], rows[2]["title"], rows[2]["source"]) == (None, "1", '{"a":2}')
    assert all(v is None for row in rows[3:] for v in row)
    assert M.decode_articles(messages, malformed="drop").count() == 3
    assert M.malformed_messages(messages).count() == 4
    with pytest.raises(ValueError):
        M.decode_articles(messages, malformed="ignore")


def test_publish_counts_and_round_trips(spark, tmp_path):
    rows = [tuple(f"{n}{i}" for n in RAW_FIELDS) for i in range(7)]
    df = spark.createDataFrame(rows, RAW_FIELDS)
    path = str(tmp_path / "out")
    assert M.publish_articles(df, "text", {"path": path}) == 7
    back = M.decode_articles(spark.read.text(path))
    assert sorted(tuple(r) for r in back.collect()) == sorted(rows)


def test_kafka_options():
    source = M.kafka_source_options("b:9092", "articles", max_offsets_per_trigger=10)
    assert source == {
        "kafka.bootstrap.servers": "b:9092", "subscribe": "articles",
        "startingOffsets": "earliest", "failOnDataLoss": "false", "maxOffsetsPerTrigger": "10",
    }
    assert M.kafka_sink_options("b:9092", "articles")["kafka.acks"] == "all"


def test_hot_id_is_cut_before_the_shuffle(spark):
    df = spark.range(1000).select(
        F.when(F.col("id") % 3 == 0, "").otherwise(F.col("id").cast("string")).alias("link"),
        F.col("id").alias("entry_pos"),
    )
    first = dedupe_first_wins(df.withColumn("id", article_id(F.col("link"))), ["entry_pos"])
    plan = first._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2 and "Partial" in plan
    assert first.count() == 1000 - 333
    assert first.where("link = ''").first()["entry_pos"] == 0


def links(df):
    return sorted((r["title"], r["link"]) for r in df.select("title", "link").collect())


def test_all_dialects_in_one_folder(spark, tmp_path):
    for name, text in (("1.xml", RSS.format(name="F", link="2")), ("2.xml", ATOM), ("3.xml", RDF)):
        land(tmp_path, URLS[0], text, name)
    found = S.read_feeds(spark, str(tmp_path))
    assert links(found) == sorted([
        ("One & only", "http://n/1"), ("Two", "http://n/2"), ("No link", None), ("A", "http://n/a"),
        ("B", "http://n/b"), ("O1", "http://n/o1"), ("O2", "http://n/o2"),
    ], key=lambda x: x[0])
    old = {r["title"]: r for r in S.read_feeds(spark, str(tmp_path), "rdf").collect()}
    assert (old["O1"]["source"], old["O1"]["published"]) == ("Old feed", "2003")
    assert old["O1"]["summary"] == "d"


def test_a_permanent_identifier_stands_for_a_missing_link(spark, tmp_path):
    land(tmp_path, URLS[0], GUIDS)
    assert links(S.read_feeds(spark, str(tmp_path), "rss")) == [
        ("g1", "http://n/g1"), ("g2", "http://n/g2"), ("g3", None), ("g4", "http://n/g4"),
    ]


def test_markup_as_elements_is_content_too(spark, tmp_path):
    land(tmp_path, URLS[0], XHTML)
    found = {r["title"]: r["content"] for r in S.read_feeds(spark, str(tmp_path), "atom").collect()}
    assert found["h"] == "<p>t</p>"
    assert "<p>" in found["x"] and "two" in found["x"]


def test_publishing_a_stream_of_articles(spark, tmp_path):
    """Landed feeds to encoded messages, as far as files stand for the topic."""
    land(tmp_path / "feeds", URLS[0], RSS.format(name="First", link="2"))
    registry = S.registry_from_settings(spark, {"RSS_FEEDS_WORLD": URLS[0]})
    articles = jobs.feed_articles_stream(spark, str(tmp_path / "feeds"), registry)
    out, state = str(tmp_path / "topic"), str(tmp_path / "state")
    query = M.publish_stream(articles, state, "text", {"path": out}).trigger(availableNow=True).start()
    query.awaitTermination(120)
    assert query.exception() is None
    decoded = M.decode_articles(spark.read.text(out))
    assert links(decoded) == sorted(links(articles_of(spark, tmp_path, registry)))


def articles_of(spark, tmp_path, registry):
    entries = S.read_feeds(spark, str(tmp_path / "feeds"))
    placed = S.attach_category(entries, registry, F.col("feed_key"))
    order = ("ingested_at", "category_pos", "feed_pos", "entry_pos")
    return dedupe_first_wins(S.normalize_articles(placed, *order))
