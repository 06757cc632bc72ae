"""The same queries as SQL for a second engine (DuckDB), over views named as the given tables."""

from __future__ import annotations

from newsflow.functions.keywords import STOP_WORDS
from newsflow.functions.phrases import KINDS
from newsflow.plans.adapters import PHRASES_OF
from newsflow.plans.queries import CATEGORY, SENTIMENT
from newsflow.sources.feeds import CATEGORIES

# White space for the inside of a character class of the other engine.
WS = (
    r"\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
)
PUNCT = r"[!-/:-@\[-`{-~]"
# The references that occur in the pages; the ampersand itself is decoded last.
REFERENCES = (("&quot;", '"'), ("&copy;", "©"), ("&middot;", "·"), ("&amp;", "&"))


def unescape(c: str) -> str:
    for name, char in REFERENCES:
        c = f"replace({c}, '{name}', '{char}')"
    return c


def tags(c: str) -> str:
    return f"regexp_replace({c}, '<[^>]+>', '', 'g')"


def urls(c: str) -> str:
    return f"regexp_replace({c}, 'http[^{WS}]+|www[^{WS}]+', '', 'g')"


def spaces(c: str) -> str:
    return f"trim(regexp_replace({c}, '[{WS}]+', ' ', 'g'))"


def special(c: str) -> str:
    return rf"regexp_replace({c}, '[^\p{{L}}\p{{N}}_{WS}.,!?-]', '', 'g')"


def clean(c: str) -> str:
    return special(spaces(urls(tags(unescape(f"coalesce({c}, '')")))))


STOP = ", ".join(f"'{w}'" for w in STOP_WORDS)


def words(c: str) -> str:
    """Words with positions from 0, for use next to the row they come from."""
    runs = rf"regexp_extract_all(lower({c}), '[\p{{L}}\p{{N}}_]+')"
    return f"list_filter({runs}, lambda w: regexp_matches(w, '^[a-z]{{3,}}$'))"


def kept(c: str) -> str:
    return f"list_filter({words(c)}, lambda w: w NOT IN ({STOP}))"


def exploded(source: str, key: str, array: str) -> str:
    return f"""SELECT {key}, unnest(ws) AS word,
        CAST(generate_subscripts(ws, 1) - 1 AS INTEGER) AS pos
        FROM (SELECT {key}, {array} AS ws FROM {source})"""


def frequency(source: str, key: str, text: str) -> str:
    return f"""SELECT {key}, word, CAST(count(*) AS INTEGER) AS n, min(pos) AS first_pos
        FROM ({exploded(source, key, kept(text))}) GROUP BY {key}, word"""


def ranked(source: str, key: str, text: str) -> str:
    return f"""SELECT {key}, CAST(rank AS INTEGER) AS rank, word FROM (
        SELECT {key}, word,
            row_number() OVER (PARTITION BY {key} ORDER BY n DESC, first_pos) AS rank
        FROM ({frequency(source, key, text)})) WHERE rank <= 10"""


# Stop words of the corpus beside the fixed ones

CORPUS_STOP_WORDS = f"""SELECT word, count(*) AS n FROM (
        SELECT DISTINCT doc_id, word FROM ({exploded('documents', 'doc_id', words('text'))}))
    GROUP BY word HAVING count(*) * 100 >= (SELECT count(*) FROM documents) * 20"""
STOP_TABLE_TOKENS = f"""SELECT doc_id, pos, word
    FROM ({exploded('documents', 'doc_id', words('text'))})
    WHERE word NOT IN ({STOP}) AND word NOT IN (SELECT word FROM ({CORPUS_STOP_WORDS}))"""
STOP_TABLE_KEYWORDS = f"""SELECT d.doc_id, coalesce(k.keywords, '') AS keywords
    FROM documents d LEFT JOIN (
        SELECT doc_id, string_agg(word, ',' ORDER BY rank) AS keywords FROM (
            SELECT doc_id, word, row_number() OVER (
                PARTITION BY doc_id ORDER BY count(*) DESC, min(pos)) AS rank
            FROM ({STOP_TABLE_TOKENS}) GROUP BY doc_id, word)
        WHERE rank <= 10 GROUP BY doc_id
    ) k ON d.doc_id = k.doc_id"""

PAGE_HOST = "regexp_extract(url, '^https?://([^/:?#]+)', 1)"
CATEGORY_LIST = "[" + ", ".join(f"'{c}'" for c in CATEGORIES) + "]"
PAGE_CATEGORY = f"{CATEGORY_LIST}[CAST(page_id % 4 + 1 AS INTEGER)]"


def _xml_text(c: str) -> str:
    """A text as it comes out of an XML element: legal characters, line ends as XML reads them,
    without the blanks around it; an empty element is NULL."""
    legal = rf"regexp_replace({c}, '[\x00-\x08\x0B\x0C\x0E-\x1F]', '', 'g')"
    lines = f"replace(replace({legal}, chr(13) || chr(10), chr(10)), chr(13), chr(10))"
    return f"nullif(regexp_replace({lines}, '^[{WS}]+|[{WS}]+$', '', 'g'), '')"


PAGE_TITLE = "regexp_extract(html, '<title>([^<]*)</title>', 1)"

ENRICHED = f"""SELECT *, title_clean || ' ' || summary_clean || ' ' || content_clean AS full_text
    FROM (SELECT doc_id, lang, source,
        {clean('substring(text, 1, 80)')} AS title_clean,
        {clean('substring(text, 81, 200)')} AS summary_clean,
        {clean('text')} AS content_clean
        FROM documents)"""


def with_keywords(source: str, key: str) -> str:
    return f"""SELECT a.*, coalesce(k.keywords, '') AS keywords,
            CAST(length(full_text) AS INTEGER) AS text_length
        FROM ({source}) a LEFT JOIN (
            SELECT {key} AS k_key, string_agg(word, ',' ORDER BY rank) AS keywords
            FROM ({ranked(f'({source})', key, 'full_text')}) GROUP BY {key}
        ) k ON a.{key} = k.k_key"""


PAGES_ENRICHED = f"""SELECT *, title_clean || '  ' || content_clean AS full_text
    FROM (SELECT md5(url) AS id, {clean(PAGE_TITLE)} AS title_clean,
        {clean('html')} AS content_clean FROM pages)"""

# Stand-in lexicon, degree words and negations of the corpus's own words

CORPUS_WORDS = f"SELECT DISTINCT unnest({words('text')}) AS token FROM documents"
LEXICON = f"""SELECT token, CAST(v AS DOUBLE) AS valence FROM (
    SELECT token, (ascii(substr(token, 1, 1)) * 7 + ascii(substr(token, 2, 1)) * 3
        + length(token)) % 9 - 4 AS v FROM ({CORPUS_WORDS}) WHERE length(token) % 3 = 0)
    WHERE v <> 0"""
BOOSTERS = f"""SELECT token, CASE WHEN ascii(token) % 2 = 0 THEN 0.293::DOUBLE
    ELSE -0.293::DOUBLE END AS delta FROM ({CORPUS_WORDS}) WHERE length(token) % 5 = 4"""
NEGATIONS = f"SELECT token FROM ({CORPUS_WORDS}) WHERE length(token) % 7 = 4"


def tokens(source: str) -> str:
    """Sentiment tokens of ``full_text`` with positions from 1."""
    core = f"regexp_replace(w, '^{PUNCT}+|{PUNCT}+$', '', 'g')"
    parts = f"list_filter(regexp_split_to_array(full_text, '[{WS}]+'), lambda w: w <> '')"
    ws = f"list_transform({parts}, lambda w: CASE WHEN length({core}) > 2 THEN {core} ELSE w END)"
    return f"""SELECT doc_id, unnest(ws) AS tok, generate_subscripts(ws, 1) AS i
        FROM (SELECT doc_id, {ws} AS ws FROM ({source}))"""


def _phrase_table(source: str) -> str:
    """Stand-in phrases of one to three tokens of a source: phrase, n, kind, value."""
    two, three = "low || ' ' || lead(low, 1) OVER w", "lead(low, 1) OVER w || ' ' || lead(low, 2) OVER w"
    runs = f"""SELECT low AS g1, {two} AS g2, low || ' ' || {three} AS g3
        FROM (SELECT doc_id, i, lower(tok) AS low FROM ({tokens(source)}))
        WINDOW w AS (PARTITION BY doc_id ORDER BY i)"""
    ranked = " UNION ALL ".join(
        f"""SELECT * FROM (SELECT g{n} AS phrase, {n} AS n,
            row_number() OVER (ORDER BY count(*) DESC, g{n}) AS rank
            FROM ({runs}) WHERE g{n} IS NOT NULL GROUP BY g{n}) WHERE rank <= {top}"""
        for n, top in PHRASES_OF.items()
    )
    kinds = ", ".join(f"'{kind}'" for kind in KINDS)
    return f"""SELECT phrase, n, CASE WHEN n = 1 THEN ['flip', 'mute'][rank % 2 + 1]
        ELSE [{kinds}][rank % {len(KINDS)} + 1] END AS kind,
        CAST((rank * 7 % 11 - 5) / 2.0 AS DOUBLE) AS value FROM ({ranked})"""


def _begins(marked: str, source: str) -> str:
    """Tokens with the value of each kind of phrase of one to three tokens that begins there."""
    runs = f"""SELECT *, low AS g1, low || ' ' || lead(low, 1) OVER w AS g2,
        low || ' ' || lead(low, 1) OVER w || ' ' || lead(low, 2) OVER w AS g3
        FROM ({marked}) WINDOW w AS (PARTITION BY doc_id ORDER BY i)"""
    values = ", ".join(
        f"CASE WHEN p{n}.kind = '{kind}' THEN p{n}.value END AS {kind}{n}"
        for kind in KINDS for n in PHRASES_OF
    )
    joins = " ".join(f"LEFT JOIN phrases p{n} ON t.g{n} = p{n}.phrase AND p{n}.n = {n}" for n in PHRASES_OF)
    return f"""SELECT t.*, {values} FROM ({runs}) t {joins}"""


def _phrase_rules() -> dict[str, str]:
    """SQL for what phrases do to the token at hand, from the phrases that begin around it."""

    def begun(kind: str, n: int, before: int) -> str:
        return f"{kind}{n}" if not before else f"lag({kind}{n}, {before}) OVER w"

    idioms = [begun("idiom", n, n - 1 - on) for on in (2, 1, 0) for n in (3, 2) if n > on]
    idioms += [begun("idiom", n, n - 1 + back) for back in (1, 2) for n in (3, 2) if n + back <= 4]
    flips = ", ".join(begun("flip", n, n) for n in (3, 2, 1))
    denies = "lag(low, {0}) OVER w = 'no'"
    return {
        "mute": "coalesce(mute3, mute2, mute1) IS NOT NULL",
        "idiom": f"coalesce({', '.join(idioms)})",
        "degree": f"""(coalesce({begun('degree', 3, 3)}, {begun('degree', 2, 2)}, 0::DOUBLE)
            + coalesce({begun('degree', 2, 3)}, 0::DOUBLE))""",
        "flip": f"""CASE WHEN lag(valence, 1) OVER w IS NULL THEN coalesce({flips}, 1::DOUBLE)
            ELSE 1::DOUBLE END""",
        **{f"scale{d}x": f"coalesce({', '.join(begun('scale', n, d) for n in (3, 2, 1) if n <= d)})"
           for d in (1, 2, 3)},
        "base": f"""CASE WHEN coalesce({denies.format(1)}, false) OR coalesce({denies.format(2)}, false)
            OR coalesce({denies.format(3)} AND lag(low, 1) OVER w IN ('or', 'nor'), false)
            THEN valence * -0.74::DOUBLE
            WHEN low = 'no' AND lead(valence, 1) OVER w IS NOT NULL THEN 0::DOUBLE ELSE valence END""",
    }


def scores(source: str, context: bool, phrases: bool = False) -> str:
    """Label and scores per ``doc_id`` of a source with ``doc_id`` and ``full_text``."""
    if not context:
        per_token = f"""SELECT t.doc_id, t.i, l.valence AS v
            FROM ({tokens(source)}) t LEFT JOIN ({LEXICON}) l ON lower(t.tok) = l.token"""
        emphasis = "0::DOUBLE"
    else:
        step = "v{d}"
        lags = ", ".join(
            f"lag(valence, {d}) OVER w AS val{d}, lag(delta, {d}) OVER w AS del{d}, "
            f"lag(neg, {d}) OVER w AS neg{d}, lag(caps, {d}) OVER w AS caps{d}"
            for d in (1, 2, 3)
        )
        marked = f"""SELECT t.doc_id, t.i, lower(t.tok) AS low, l.valence, b.delta,
                n.token IS NOT NULL OR contains(lower(t.tok), 'n''t') AS neg,
                t.tok <> lower(t.tok) AND t.tok = upper(t.tok) AS caps
            FROM ({tokens(source)}) t
            LEFT JOIN ({LEXICON}) l ON lower(t.tok) = l.token
            LEFT JOIN ({BOOSTERS}) b ON lower(t.tok) = b.token
            LEFT JOIN ({NEGATIONS}) n ON lower(t.tok) = n.token"""
        base = "valence"
        if phrases:
            marked, base = _begins(marked, source), "base"
            lags += "".join(f", {rule} AS {name}" for name, rule in _phrase_rules().items())
        around = f"""SELECT *, {lags},
            count(*) FILTER (WHERE caps) OVER (PARTITION BY doc_id)
                BETWEEN 1 AND count(*) OVER (PARTITION BY doc_id) - 1 AS emphatic,
            min(CASE WHEN low = 'but' THEN i END) OVER (PARTITION BY doc_id) AS but
            FROM ({marked}) WINDOW w AS (PARTITION BY doc_id ORDER BY i)"""
        current = f"""SELECT *, CASE WHEN valence IS NOT NULL AND delta IS NULL THEN
            {base} + CASE WHEN emphatic AND caps
                THEN CASE WHEN {base} > 0 THEN 0.733::DOUBLE ELSE -0.733::DOUBLE END
                ELSE 0::DOUBLE END END AS v0 FROM ({around})"""
        for d, weight in ((1, "1.0"), (2, "0.95"), (3, "0.9")):
            v = step.format(d=d - 1)
            push = f"""CASE WHEN del{d} IS NULL THEN 0::DOUBLE ELSE {weight}::DOUBLE * (
                CASE WHEN {v} < 0 THEN -1 ELSE 1 END * del{d}
                + CASE WHEN emphatic AND caps{d}
                    THEN CASE WHEN {v} > 0 THEN 0.733::DOUBLE ELSE -0.733::DOUBLE END
                    ELSE 0::DOUBLE END) END"""
            factor = f"CASE WHEN coalesce(neg{d}, false) THEN -0.74::DOUBLE ELSE 1::DOUBLE END"
            factor = f"coalesce(scale{d}x, {factor})" if phrases else factor
            current = f"""SELECT *, CASE WHEN val{d} IS NOT NULL THEN {v} ELSE ({v} + {push})
                * {factor} END AS v{d} FROM ({current})"""
        last = "v3"
        if phrases:
            current = f"""SELECT *, CASE WHEN v3 IS NOT NULL THEN coalesce(idiom, v3) END AS v4
                FROM ({current})"""
            last = """CASE WHEN mute AND v4 IS NOT NULL THEN 0::DOUBLE
                ELSE (v4 + CASE WHEN v4 < 0 THEN -1 ELSE 1 END * degree) * flip END"""
        per_token = f"""SELECT doc_id, i, {last} * CASE WHEN but IS NULL OR i = but THEN 1::DOUBLE
            WHEN i < but THEN 0.5::DOUBLE ELSE 1.5::DOUBLE END AS v FROM ({current})"""
        marks = "(length(full_text) - length(replace(full_text, '{0}', '')))"
        bang, query = marks.format("!"), marks.format("?")
        emphasis = f"""least({bang}, 4) * 0.292::DOUBLE + CASE WHEN {query} <= 1 THEN 0::DOUBLE
            WHEN {query} <= 3 THEN {query} * 0.18::DOUBLE ELSE 0.96::DOUBLE END"""
    totals = f"""SELECT doc_id, sum(coalesce(v, 0::DOUBLE) ORDER BY i) AS s,
        sum(CASE WHEN v > 0 THEN v + 1 ELSE 0::DOUBLE END ORDER BY i) AS up,
        sum(CASE WHEN v < 0 THEN v - 1 ELSE 0::DOUBLE END ORDER BY i) AS down,
        count(*) - count(*) FILTER (WHERE v <> 0) AS flat
        FROM ({per_token}) GROUP BY doc_id"""
    pushed = f"""SELECT a.doc_id, t.doc_id IS NULL AS blank,
        coalesce(s + sign(s) * e, 0::DOUBLE) AS s,
        CASE WHEN up > abs(down) THEN up + e ELSE up END AS up,
        abs(CASE WHEN up < abs(down) THEN down - e ELSE down END) AS down, flat
        FROM (SELECT doc_id, {emphasis} AS e FROM ({source})) a
        LEFT JOIN ({totals}) t ON a.doc_id = t.doc_id"""
    finished = f"""SELECT doc_id, blank,
        round_even(greatest(-1::DOUBLE, least(1::DOUBLE, s / sqrt(s * s + 15))), 4) AS c,
        round_even(up / (up + down + flat), 3) AS p,
        round_even(down / (up + down + flat), 3) AS n,
        round_even(flat / (up + down + flat), 3) AS z
        FROM ({pushed})"""

    def narrowed(value: str, blank: str) -> str:
        return f"round(CAST(CAST(CASE WHEN blank THEN {blank} ELSE {value} END AS FLOAT) AS DOUBLE), 6)"

    first = f"WITH phrases AS MATERIALIZED ({_phrase_table(source)})" if phrases else ""
    return f"""{first} SELECT doc_id,
        CASE WHEN c >= 0.05 THEN 'positive' WHEN c <= -0.05 THEN 'negative' ELSE 'neutral' END
            AS sentiment,
        {narrowed('c', '0')} AS sentiment_compound, {narrowed('p', '0')} AS sentiment_pos,
        {narrowed('n', '0')} AS sentiment_neg, {narrowed('z', '1')} AS sentiment_neu
        FROM ({finished})"""


DOCUMENTS_CLEAN = f"SELECT doc_id, {clean('text')} AS full_text FROM documents"

PROCESSED = f"""SELECT md5(CAST(a.doc_id AS VARCHAR)) AS id,
    'doc://' || CAST(a.doc_id AS VARCHAR) AS link, 'Unknown' AS author,
    CAST(NULL AS VARCHAR) AS published, a.source, a.lang AS category,
    CAST(NULL AS VARCHAR) AS crawled_at, a.title_clean, a.full_text, a.keywords, a.text_length,
    s.sentiment, s.sentiment_compound, s.sentiment_pos, s.sentiment_neg, s.sentiment_neu,
    TIMESTAMP '2024-01-01 00:00:00' + to_seconds(a.doc_id * 977) AS processed_at
    FROM ({with_keywords(ENRICHED, 'doc_id')}) a
    JOIN ({scores(ENRICHED, True)}) s ON a.doc_id = s.doc_id"""

# Processed articles from events

M = "(event_id * 37 % 2001 - 1000)"
LABEL = f"""CASE WHEN {M} >= 50 THEN 'positive' WHEN {M} <= -50 THEN 'negative'
    ELSE 'neutral' END"""
EVENTS = f"""(SELECT md5(CAST(event_id AS VARCHAR)) AS id,
    'src' || CAST(user_id % 20 AS VARCHAR) AS source, event_type AS category,
    CAST({M} / 1000.0::DOUBLE AS FLOAT) AS sentiment_compound, {LABEL} AS sentiment,
    event_type || ',u' || CAST(user_id % 50 AS VARCHAR) AS keywords,
    CAST(length(props) AS INTEGER) AS text_length,
    event_type || ' ' || CAST(event_id AS VARCHAR) AS title_clean, ts AS processed_at
    FROM events)"""
CHOSEN = f"(SELECT * FROM {EVENTS} WHERE category = '{CATEGORY}' AND sentiment = '{SENTIMENT}')"
COMPOUND = "round(CAST(sentiment_compound AS DOUBLE), 6) AS sentiment_compound"
LISTING = f"title_clean, source, category, sentiment, {COMPOUND}, processed_at"


def counts(source: str, *keys: str) -> str:
    listed = ", ".join(keys)
    return f"SELECT {listed}, count(*) AS count FROM {source} GROUP BY {listed}"


def mean(column: str, alias: str) -> str:
    return f"round(avg(CAST({column} AS DOUBLE)), 6) AS {alias}"


def facet(column: str) -> str:
    return f"SELECT DISTINCT {column} FROM {EVENTS} WHERE {column} IS NOT NULL"


def key_figures(source: str) -> str:
    return f"""SELECT count(*) AS total_articles, {mean('sentiment_compound', 'avg_sentiment')},
        round(count(*) FILTER (WHERE sentiment = 'positive') * 100.0::DOUBLE / count(*), 6)
            AS positive_pct, {mean('text_length', 'avg_length')} FROM {source}"""


def keyword_counts(source: str, word: str, where: str = "true") -> str:
    return f"""SELECT keyword, count(*) AS count FROM (
        SELECT {word} AS keyword FROM (
            SELECT unnest(string_split(keywords, ',')) AS k FROM {source})) WHERE {where}
        GROUP BY keyword ORDER BY count DESC, keyword LIMIT 20"""


def latest(source: str) -> str:
    return f"SELECT {LISTING} FROM {source} ORDER BY processed_at DESC, id LIMIT 10"


# Articles before processing

RAW_DOCUMENTS = """SELECT md5(CAST(doc_id AS VARCHAR)) AS id, substring(text, 1, 80) AS title,
    substring(text, 81, 200) AS summary, text AS content,
    'doc://' || CAST(doc_id AS VARCHAR) AS link, 'Unknown' AS author, source, lang AS category
    FROM documents"""
REGISTRY = f"""SELECT url || suffix AS feed_url, {PAGE_CATEGORY} AS category,
    CAST(page_id % 4 AS INTEGER) AS category_pos, CAST(pos AS INTEGER) AS feed_pos
    FROM pages, (VALUES ('', 0), ('&feed=2', 1)) AS listed(suffix, pos)"""
CRAWLED = "strftime(ts, '%Y-%m-%dT%H:%M:%S.%f')"
ARRIVALS = """SELECT md5(link) AS id, * FROM (SELECT
    CASE WHEN event_id % 3 = 0 THEN ''
        ELSE 'https://news.example/' || CAST((event_id * 7919) % 1500 AS VARCHAR) END AS link,
    event_type AS title, ts AS ingested_at, CAST(user_id % 4 AS INTEGER) AS category_pos,
    CAST(user_id % 7 AS INTEGER) AS feed_pos, CAST(event_id AS INTEGER) AS entry_pos FROM events)"""


def _json_pairs() -> str:
    fields = "id title summary content link author source category".split()
    pairs = ", ',', ".join(f"'\"{f}\":', CAST(to_json({f}) AS VARCHAR)" for f in fields)
    return f"concat('{{', {pairs}, '}}')"


_RATED = f"""SELECT token, list_transform(range(1, 11), lambda k:
        (ascii(token) * k + length(token)) % 9 - 4) AS ratings,
        (ascii(substr(token, 2, 1)) + length(token)) % 8 AS kind FROM ({CORPUS_WORDS})"""
LEXICON_LINES = f"""SELECT token, ratings, string_split(line, chr(9)) AS fields, line FROM (
    SELECT *, CASE kind WHEN 1 THEN token WHEN 2 THEN token || chr(9) || 'high'
        ELSE token || chr(9) || CASE WHEN kind = 3 THEN '9.9'
            ELSE printf('%.1f', list_sum(ratings) / 10.0) END || chr(9) || '0.5' || chr(9)
            || '[' || array_to_string(ratings, ', ') || ']' END AS line FROM ({_RATED}))"""


def _report(name: str, key: str, measures: dict[str, str]) -> str:
    columns = ", ".join(f"CAST({value} AS DOUBLE) AS m{k}" for k, value in enumerate(measures.values()))
    return " UNION ALL ".join(
        f"""SELECT '{name}' AS report, key, '{measure}' AS measure, round(m{k}, 6) AS value
        FROM (SELECT {key} AS key, {columns} FROM {EVENTS} GROUP BY 1)"""
        for k, measure in enumerate(measures)
    )


COUNTED, COMPOUND = {"count": "count(*)"}, "avg(CAST(sentiment_compound AS DOUBLE))"
RUN_REPORTS = " UNION ALL ".join([
    _report("sentiment_distribution", "coalesce(sentiment, '-')", COUNTED),
    _report("category_sentiment", "coalesce(category, '-') || '/' || coalesce(sentiment, '-')",
            COUNTED | {"avg_score": COMPOUND}),
    _report("source_analysis", "coalesce(source, '-')",
            {"total_articles": "count(*)", "avg_sentiment": COMPOUND, "avg_length": "avg(text_length)"}),
    _report("hourly_activity", "coalesce(CAST(hour(processed_at) AS VARCHAR), '-')", COUNTED),
    _report("sentiment_by_category_pivot", "coalesce(category, '-')",
            {s: f"count(*) FILTER (WHERE sentiment = '{s}')" for s in ("positive", "negative", "neutral")}),
    f"""SELECT 'top_keywords', keyword, 'count', CAST(count AS DOUBLE)
        FROM ({keyword_counts(EVENTS, "trim(lower(k))", "keyword <> ''")})""",
])

ORACLES: dict[str, str] = {
    "html_unescape": f"SELECT page_id, {unescape('html')} AS text FROM pages",
    "strip_tags": f"SELECT page_id, {tags('html')} AS text FROM pages",
    "strip_urls": f"SELECT page_id, {urls('html')} AS text FROM pages",
    "collapse_whitespace": f"SELECT page_id, {spaces('html')} AS text FROM pages",
    "strip_special_chars": f"SELECT doc_id, {special('text')} AS text FROM documents",
    "clean_text_pages": f"SELECT page_id, {clean('html')} AS text FROM pages",
    "clean_text_documents": f"SELECT doc_id, {clean('text')} AS text FROM documents",
    "full_text": f"SELECT doc_id, title_clean, full_text FROM ({ENRICHED})",
    "text_length": f"""SELECT doc_id, CAST(length(full_text) AS INTEGER) AS text_length
        FROM ({ENRICHED})""",
    "article_text_pages": f"""SELECT id, title_clean, full_text, keywords, text_length
        FROM ({with_keywords(PAGES_ENRICHED, 'id')})""",
    "tokenize": f"SELECT doc_id, pos, word FROM ({exploded('documents', 'doc_id', words('text'))})",
    "stopword_filter": f"""SELECT doc_id, pos, word
        FROM ({exploded('documents', 'doc_id', kept('text'))})""",
    "term_frequency": frequency("documents", "doc_id", "text"),
    "top_terms_per_article": ranked("documents", "doc_id", "text"),
    "article_keywords": f"SELECT doc_id, keywords FROM ({with_keywords(ENRICHED, 'doc_id')})",
    "corpus_stop_words": CORPUS_STOP_WORDS,
    "stop_table_tokens": STOP_TABLE_TOKENS,
    "stop_table_tokens_joined": STOP_TABLE_TOKENS,
    "stop_table_keywords": STOP_TABLE_KEYWORDS,
    "stop_table_keywords_joined": STOP_TABLE_KEYWORDS,
    "lexicon_sentiment": scores(DOCUMENTS_CLEAN, False),
    "lexicon_sentiment_joined": scores(DOCUMENTS_CLEAN, False),
    "context_sentiment": scores(DOCUMENTS_CLEAN, True),
    "classify_sentiment": f"SELECT event_id, {LABEL} AS sentiment FROM events",
    "process_article": PROCESSED,
    "category_sentiment_documents": f"""SELECT category, sentiment, count(*) AS count,
        {mean('sentiment_compound', 'avg_score')} FROM ({PROCESSED}) GROUP BY category, sentiment""",
    "top_keywords_documents": keyword_counts(
        f"({with_keywords(ENRICHED, 'doc_id')})", "trim(lower(k))", "keyword <> ''"
    ),
    "feed_registry": REGISTRY,
    "feed_registry_join": f"""SELECT p.page_id, r.* FROM pages p
        JOIN ({REGISTRY}) r ON p.url = r.feed_url""",
    "feed_extract_pages": f"""SELECT page_id, 0::INTEGER AS entry_pos,
        nullif(trim({PAGE_TITLE}), '') AS title, url AS link, {_xml_text('html')} AS content,
        {PAGE_HOST} AS source FROM pages""",
    "feed_extract_rss": f"""SELECT conv_id, turn, CAST(pos AS INTEGER) AS entry_pos,
        role || suffix AS title,
        'https://talk.example/' || conv_id || '/' || turn || '/' || suffix AS link,
        'conversation ' || conv_id AS source,
        {_xml_text('CASE WHEN pos = 0 THEN substring(text, 1, 40) ELSE text END')} AS summary
        FROM conversations, (VALUES ('head', 0), ('text', 1)) AS part(suffix, pos)""",
    "feed_extract_atom": f"""SELECT conv_id, turn, 0::INTEGER AS entry_pos, role AS title,
        'https://talk.example/' || conv_id || '/' || turn AS link,
        'conversation ' || conv_id AS source, {_xml_text('text')} AS content
        FROM conversations""",
    "normalize_articles": f"""SELECT md5(coalesce(l, '')) AS id, coalesce(title, '') AS title,
        props AS summary, '' AS content, coalesce(l, '') AS link, coalesce(author, 'Unknown') AS
        author, coalesce(published, crawled_at) AS published, coalesce(source, 'Unknown') AS source,
        category, crawled_at, event_id FROM (SELECT event_id, props, event_type AS category,
            CASE WHEN event_id % 5 <> 0 THEN event_type END AS title,
            CASE WHEN event_id % 7 <> 0 THEN 'https://e.example/' || event_id END AS l,
            CASE WHEN event_id % 2 = 0 THEN 'user ' || user_id END AS author,
            CASE WHEN event_id % 3 = 0 THEN 'Mon, 01 Jan 2024' END AS published,
            CASE WHEN event_id % 4 <> 0 THEN 'wire' END AS source,
            {CRAWLED} AS crawled_at FROM events)""",
    "encode_article_json": f"SELECT {_json_pairs()} AS value FROM ({RAW_DOCUMENTS})",
    "decode_article_json": f"""SELECT *, CAST(NULL AS VARCHAR) AS published,
        CAST(NULL AS VARCHAR) AS crawled_at FROM ({RAW_DOCUMENTS})""",
    "malformed_messages": """SELECT '{"title' || CAST(doc_id AS VARCHAR) AS value FROM documents
        WHERE doc_id % 7 = 0""",
    "phrase_sentiment": scores(DOCUMENTS_CLEAN, True, phrases=True),
    "phrase_sentiment_joined": scores(DOCUMENTS_CLEAN, True, phrases=True),
    "lexicon_file": f"""SELECT token, CAST(fields[2] AS DOUBLE) AS valence, CAST(fields[3] AS DOUBLE) AS deviation,
        array_to_string(ratings, ' ') AS ratings FROM ({LEXICON_LINES})
        WHERE len(fields) = 4 AND abs(list_sum(ratings) / 10.0 - CAST(fields[2] AS DOUBLE)) <= 0.051""",
    "lexicon_file_rejects": f"""SELECT line, CASE len(fields) WHEN 1 THEN 'fields' WHEN 2 THEN 'mean'
        ELSE 'unequal' END AS reason FROM ({LEXICON_LINES})
        WHERE len(fields) < 4 OR abs(list_sum(ratings) / 10.0 - CAST(fields[2] AS DOUBLE)) > 0.051""",
    "blank_articles": """SELECT doc_id, 'neutral' AS sentiment, 0.0::DOUBLE AS sentiment_compound,
        0.0::DOUBLE AS sentiment_pos, 0.0::DOUBLE AS sentiment_neg, 1.0::DOUBLE AS sentiment_neu
        FROM documents""",
    "run_reports": RUN_REPORTS,
    "article_id": "SELECT url, md5(url) AS id FROM pages",
    "dedupe_first_wins": f"""SELECT * EXCLUDE (rank) FROM (SELECT *, row_number() OVER (
        PARTITION BY id ORDER BY ingested_at, category_pos, feed_pos, entry_pos) AS rank
        FROM ({ARRIVALS})) WHERE rank = 1""",
    "sentiment_distribution": counts(EVENTS, "sentiment"),
    "category_sentiment": f"""SELECT category, sentiment, count(*) AS count,
        {mean('sentiment_compound', 'avg_score')} FROM {EVENTS} GROUP BY category, sentiment""",
    "top_keywords": keyword_counts(EVENTS, "trim(lower(k))", "keyword <> ''"),
    "source_analysis": f"""SELECT source, count(*) AS total_articles,
        {mean('sentiment_compound', 'avg_sentiment')}, {mean('text_length', 'avg_length')}
        FROM {EVENTS} GROUP BY source""",
    "hourly_activity": f"""SELECT CAST(hour(processed_at) AS INTEGER) AS hour, count(*) AS count
        FROM {EVENTS} GROUP BY 1""",
    "sentiment_by_category_pivot": f"""SELECT category,
        count(*) FILTER (WHERE sentiment = 'positive') AS positive,
        count(*) FILTER (WHERE sentiment = 'negative') AS negative,
        count(*) FILTER (WHERE sentiment = 'neutral') AS neutral FROM {EVENTS} GROUP BY category""",
    "latest_articles": latest(EVENTS),
    "filter_articles": f"SELECT * REPLACE ({COMPOUND}) FROM {CHOSEN}",
    "facet_category": facet("category"),
    "facet_source": facet("source"),
    "facet_sentiment": facet("sentiment"),
    "time_parts": f"""SELECT id, processed_at, CAST(processed_at AS DATE) AS date,
        CAST(hour(processed_at) AS INTEGER) AS hour FROM {EVENTS}""",
    "kpis": key_figures(EVENTS),
    "filtered_kpis": key_figures(CHOSEN),
    "filtered_sentiment_counts": counts(
        f"(SELECT * FROM {EVENTS} WHERE category = '{CATEGORY}')", "sentiment"
    ),
    "category_counts": counts(EVENTS, "category"),
    "category_sentiment_counts": counts(EVENTS, "category", "sentiment"),
    "articles_over_time": f"""SELECT date_trunc('hour', processed_at) AS processed_at,
        count(*) AS count FROM {EVENTS} GROUP BY 1""",
    "dashboard_keywords": keyword_counts(EVENTS, "trim(k)"),
    "dashboard_source_stats": f"""SELECT source, {mean('sentiment_compound', 'sentiment_compound')},
        {mean('text_length', 'text_length')}, count(*) AS count FROM {EVENTS} GROUP BY source""",
    "filtered_latest": latest(CHOSEN),
    "tallied_kpis": key_figures(CHOSEN),
    "tallied_keywords": keyword_counts(CHOSEN, "trim(k)"),
    "tallied_source_stats": f"""SELECT source, {mean('sentiment_compound', 'sentiment_compound')},
        {mean('text_length', 'text_length')}, count(*) AS count FROM {EVENTS} GROUP BY source""",
}
