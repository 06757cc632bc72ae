import html as H
import re

import pytest

from newsflow.llm import html_extract as X
from tests.llm.conftest import rows_of


def brute(page):
    """The given pages by plain cutting: what lies in the article, a block per p or h1."""
    if page is None or "<article>" not in page:
        return ""
    body = page.split("<article>", 1)[1].split("</article>", 1)[0]
    body = re.sub(r"<[^>]*\Z", "", body)
    blocks = re.split(r"</?(?:p|h1)>", re.sub(r"<br>", " ", body))
    texts = [" ".join(H.unescape(re.sub(r"<[^>]*>", "", b)).split()) for b in blocks]
    return "\n".join(t for t in texts if t)


def test_whole_table(spark):
    rows = rows_of("pages")
    df = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    found = {r.page_id: r for r in X.extract_pages(df).collect()}
    assert len(found) == len(rows)
    for row in rows:
        text = brute(row["html"])
        assert tuple(found[row["page_id"]]) == (row["page_id"], row["url"], text, len(text))


ARTICLE = "<h1>Title</h1><p>First &amp; best.</p><p>Second\n  line&nbsp;here.</p>"
TEXT = "Title\nFirst & best.\nSecond line here."
LONG = "Words of a long paragraph that goes on for a while. " * 8


def test_boilerplate_around_and_inside_an_article():
    page = f"""<html><head><title>t</title><style>p{{}}</style></head><body class="has-sidebar">
      <header><a href="/">Home</a><p>Site header</p></header>
      <nav><ul><li>Menu</li></ul></nav><div class="cookie-notice">We use cookies</div>
      <main><article><header><h1>Title</h1></header><script>if (a < b) "</p>"</script>
      <p>First &amp; best.</p><aside>Aside</aside><div class="ad">Buy</div>
      <form><label>Mail</label><input></form><!-- <p>not this</p> -->
      <p>Second\n  line&nbsp;here.</p><div class="share-buttons">Share</div>
      <section id="comments"><p>{LONG}</p><article class="comment"><p>Nice</p></article></section>
      </article></main>
      <div class="sidebar"><p>Side</p></div><footer>&copy; us</footer></body></html>"""
    assert X.main_text(page) == TEXT


def test_page_without_article_element_uses_surges_of_text():
    menu = "".join(f'<li><a href="/{i}">Entry number {i}</a></li>' for i in range(20))
    page = f"""<body><ul>{menu}</ul><div id="content"><h1>Title</h1><p>{LONG}</p><p>{LONG}</p>
      </div><ul>{menu}</ul><p>Imprint</p></body>"""
    paragraph = LONG.strip()
    assert X.main_text(page) == f"Title\n{paragraph}\n{paragraph}"
    assert X.main_text("just <b>some</b> text") == "just some text"


def test_messy_markup():
    for page in (
        f"<article>{ARTICLE}",
        f"<article>{ARTICLE}</article><footer>x</footer></div></p>",
        f"<ARTICLE CLASS=a>{ARTICLE.replace('<p>', '<P class=x>')}</ARTICLE><footer>cut o",
        f"<article>{ARTICLE}<p hidden>no</p><p style='display: none'>no</p></article><div cla",
        f'<article data-x="a>b">{ARTICLE}<button>Go</button></article>',
    ):
        assert X.main_text(page) == TEXT
    assert X.main_text("<article><p><b>bold text<br><p>next</p></article>") == "bold text\nnext"
    assert X.main_text("<article><p>a<br>b <i>c</i>d</p>tail</article>") == "a b cd\ntail"
    assert X.main_text("<article><p>1 < 2 &lt;b&gt; &am &notanentity;</p></article>") == (
        "1 < 2 <b> &am " + H.unescape("&notanentity;")
    )
    assert X.main_text("<article><ul><li>one<li>two</ul><table><tr><td>x<td>y</table></article>") == (
        "one\ntwo\nx\ny"
    )


def test_nothing_to_extract():
    for page in (None, "", "   ", "<html></html>", "<nav>menu</nav>", "<!-- x", "<script>x", "<a"):
        assert X.main_text(page) == ""


def test_very_long_page_is_read_whole_and_fast():
    text = "<p>" + "</p><p>".join(["word " * 50] * 20_000) + "</p>"
    assert X.main_text(f"<article>{text}</article>").count("\n") == 19_999
    assert X.main_text("<" * 200_000 + '<a "' * 1000) is not None


def test_frame_rows_and_clashing_columns(frame, spark):
    rows = [(1, "u", None, "t", 5), (2, None, "<p>x</p>", "t", 5), (2, None, "<p>x</p>", "t", 5)]
    schema = "page_id long, url string, html string, text string, n_chars int"
    found = sorted(map(tuple, X.extract_pages(frame(rows, schema)).collect()))
    assert found == [(1, "u", "", 0), (2, None, "x", 1), (2, None, "x", 1)]
    assert X.extract_pages(spark.createDataFrame([], schema)).collect() == []


def test_surge_and_dive_points():
    import numpy as np

    weights = np.array([0, 0, 0, 0, 5, 0, 7, 0, 0, 0, 0, 3])
    assert X._runs(weights) == [(2, 7), (9, 12)]
    assert X._runs(np.array([])) == []


def test_short_paragraph_after_an_advert_without_article_element():
    text = LONG.strip()
    for advert in ('<div class="ad">Buy</div>', "<aside>Aside</aside>", "<form>Mail</form>"):
        body = f"<p>{LONG}</p><p>{LONG}</p>{advert}<h2>End</h2><p>Short last words.</p>"
        for page in (f"<body>{body}</body>", f"<body><div><div id='c'>{body}</div></div></body>"):
            assert X.main_text(page) == f"{text}\n{text}\nEnd\nShort last words."
    page = f"<div id='c'><section><p>{LONG}</p></section><aside>x</aside><section><p>End.</p></section></div>"
    assert X.main_text(page) == f"{text}\nEnd."
    page = f"<body><div><p>{LONG}</p><p><a href='/'>All link</a></p><p>End.</p></div><footer>f</footer><p>Imprint</p>"
    assert X.main_text(page) == f"{text}\nAll link\nEnd."


def test_teaser_and_comment_articles_beside_a_body_without_one():
    text = LONG.strip()
    card = '<article class="card"><h3>Teaser</h3><p>A few words.</p></article>'
    remark = f'<article class="comment"><p>{LONG}</p></article>'
    body = f"<h1>Title</h1><p>{LONG}</p><p>{LONG}</p>"
    for others in (card, card * 4, remark, card + remark):
        assert X.main_text(f"<body><div>{body}</div>{others}</body>") == f"Title\n{text}\n{text}"
        assert X.main_text(f"<body>{others}<div>{body}</div></body>") == f"Title\n{text}\n{text}"


def test_unclassed_link_list_inside_main():
    links = "".join(f'<li><a href="/{i}">Entry number {i}</a></li>' for i in range(9))
    page = f"<main><h1>Title</h1><p>{LONG}</p><ul>{links}</ul><p><a href='/'>One</a></p><p>End.</p></main>"
    assert X.main_text(page.replace("<p><a href='/'>One</a></p>", "")) == f"Title\n{LONG.strip()}\nEnd."
    page = f"<main><p>{LONG}</p><p><a href='/'>One</a></p><p>End.</p></main>"
    assert X.main_text(page) == f"{LONG.strip()}\nOne\nEnd."


PROSE = "The council met on Monday to discuss the plan, and members agreed after a long debate. " * 3
BODY = f"<h1>Head</h1><p>{PROSE}</p><p>Second. {PROSE}</p>"
WHOLE = f"Head\n{PROSE.strip()}\nSecond. {PROSE.strip()}"
MENU = "<nav><a href=x>Home</a><a href=y>News</a></nav>"


@pytest.mark.parametrize("shape", [
    '<article class="post category-social">%s</article>', '<article class="post tag-reply">%s</article>',
    '<article class="post type-post status-publish format-standard category-ads tag-menu">%s</article>',
    '<article id="post-12" class="topic-comments">%s</article>', '<div class="layout menu-left">%s</div>',
    '<div class="site modal-open">%s</div>', '<div class="site modal-open"><article>%s</article></div>',
    '<div class="comment-free">%s</div>', '<div class="page search-results"><main>%s</main></div>',
    '<div id="page" class="has-sidebar">%s</div>', '<div class="no-comments">%s</div>',
    '<div class="sidebar-right"><div class="content">%s</div></div>', '<div class="overlay">%s</div>',
    '<article class="sponsored">%s</article>', '<main class="menu">%s</main>', '<div class="share">%s</div>',
    '<article>%s<div class="comments"><h2>Comments</h2><p>' + PROSE * 4 + "</p></div></article>",
    '<main>%s<h2>3 Comments</h2><div><p>Nice. ' + PROSE + "</p></div></main>",
    '<main>%s<section><h3>Leave a reply</h3><p>Write something nice.</p></section></main>',
    '<article>%s<div class="ad">Buy now. Buy this. Buy more.</div></article>',
    '<div class="ad">' + PROSE + "</div><article>%s</article>", '<div class="cookie">We use cookies.</div>%s',
    '<article>%s</article><div class="related"><h3>More</h3><p>A teaser.</p></div>',
    '<article>%s<div class="newsletter"><p>' + PROSE + PROSE + "</p></div></article>",
    '<article>%s<ul class="share"><li><a href=a>Tweet</a><li><a href=b>Mail</a></ul></article>',
    '<div class="wrap popup-ready"><div class="menu"><p>Menu</p></div><div class="post">%s</div></div>',
])
def test_class_words_do_not_decide_about_articles(shape):
    page = f"<html><body>{MENU}{shape % BODY}<footer>c 2024</footer></body></html>"
    assert X.main_text(page) == WHOLE


def test_a_section_of_the_article_named_like_a_menu():
    for word in ("search-engines", "social", "respond-to-alerts", "footer-notes"):
        section = f'<section id="{word}"><h2>Part</h2><p>{PROSE}</p><p>{PROSE}</p></section>'
        found = X.main_text(f"<main>{BODY}{section}</main>")
        expected = WHOLE if "respond" in word else f"{WHOLE}\nPart\n{PROSE.strip()}\n{PROSE.strip()}"
        assert found == expected


def test_pages_with_text_are_never_empty():
    for page in ("<article><p><a href=x>All of it is a link</a></p></article>", "<div class=ad>Only this.</div>",
                 "<p class=comment>One line", "<a href=x>link</a>", "<div class=menu><ul><li>a<li>b</ul></div>"):
        assert X.main_text(f"<html><body>{page}</body></html>")
    assert X.main_text("<html><body><nav>Menu</nav><script>x</script></body></html>") == ""


def test_time_grows_in_proportion_on_nested_pages():
    import time

    def seconds(n):
        start = time.perf_counter()
        X.main_text("<div>" * n + "x" + "</p>" * n + "<b>" * n + "</i>" * n + "<div class=ad>" * n)
        return time.perf_counter() - start

    seconds(1000)
    assert seconds(32_000) < 40 * max(seconds(2000), 0.01)
