"""The SQL twin of each query, written for DuckDB over the same tables.

They take the direct road on purpose: tokens as rows, every window spelled out, plain joins.
"""

from __future__ import annotations

from collections.abc import Collection

from parley.sources import wordlists
from parley.sources.wordlists import STOP_WORDS

SPACES = (
    r"[\t-\r\x1c-\x20\x85\xa0\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"
)
WORD_TOKEN = r"""[.,;:!?*\-()"'']+|[^\s.,;:!?*\-()"''](?:\S*[^\s.,;:!?*\-()"''])?"""

STOPS = ", ".join("'" + w.replace("'", "''") + "'" for w in STOP_WORDS)

MOMENT = "(SELECT least((SELECT count(*) FROM events), (SELECT count(*) FROM documents)))"

MOMENTS = f"""moments AS (
  SELECT event_id % {MOMENT} AS moment, min(ts) AS ts, arg_min(user_id, ts) AS user_id,
         sum(CAST(value AS decimal(18, 2))) AS value
  FROM events GROUP BY 1)"""

COMMENTS = f"""{MOMENTS},
comments AS (
  SELECT CAST(d.doc_id AS varchar) AS id, concat('user', e.user_id) AS author, e.ts AS ts,
         CAST(floor(e.value) AS int) AS score, d.source AS subreddit,
         concat(d.text, ' see /u/user', e.user_id, ' in /r/', d.source, ' via ', p.url) AS text
  FROM documents d
  JOIN moments e ON d.doc_id % {MOMENT} = e.moment
  LEFT JOIN pages p ON d.doc_id % (SELECT count(*) FROM pages) = p.page_id)"""

TIMELINE = f"""{MOMENTS},
timeline AS (
  SELECT CAST(d.doc_id AS varchar) AS id, e.ts AS ts, d.text AS text
  FROM documents d JOIN moments e ON d.doc_id % {MOMENT} = e.moment)"""

DOCS = "docs AS (SELECT CAST(doc_id AS varchar) AS id, text FROM documents)"

RECORD_COLUMNS = """id, author, epoch_us(ts) / 1e6 AS created_utc, score,
  't3_' || subreddit AS parent_id, subreddit, '/r/' || subreddit || '/' || id AS permalink, text,
  date_trunc('second', ts) AS "timestamp" """


def _with(*parts: str) -> str:
    return "WITH " + ",\n".join(parts) + "\n"


# -- references ---------------------------------------------------------------------------------

USER, COMMUNITY, URL = r"/u/(\w+)", r"/r/(\w+)", r"(http\S+)"


def _first(pattern: str) -> str:
    return (
        _with(COMMENTS)
        + f"""SELECT ts, id, regexp_extract(text, '{pattern}', 0) AS reference FROM comments
WHERE regexp_extract(text, '{pattern}', 0) <> ''"""
    )


def _union(one: str) -> str:
    return "\nUNION ALL\n".join(
        one.format(kind=k, pattern=p)
        for k, p in (("user", USER), ("community", COMMUNITY), ("url", URL))
    )


REFS = "refs AS (" + _union(
    "SELECT ts, '{kind}' AS kind, regexp_extract(text, '{pattern}', 0) AS reference FROM comments"
    " WHERE regexp_extract(text, '{pattern}', 0) <> ''"
) + ")"

REF_COUNTS = """counts AS (
  SELECT time_bucket(INTERVAL 5 SECOND, ts, TIMESTAMP '1970-01-01') - to_seconds(5 * k)
           AS window_start,
         reference, count(*) AS "count"
  FROM refs, range(12) AS steps(k) GROUP BY ALL)"""

COUNTS_OUT = """SELECT window_start, window_start + INTERVAL 60 SECOND AS window_end, reference,
  "count" FROM counts"""

# -- records ------------------------------------------------------------------------------------

CONVERSATION_COMMENTS = """talk AS (
  SELECT concat_ws('-', conv_id, turn) AS id,
         CASE WHEN role = 'user' THEN role ELSE 'deleted' END AS author,
         CAST(0 AS double) AS created_utc, CAST(length(text) AS int) AS score,
         CASE WHEN turn > 0 THEN concat_ws('-', conv_id, turn - 1) END AS parent_id,
         'talk' AS subreddit, '/c/' || conv_id AS permalink, text
  FROM conversations)"""

PAGE_POSTS = """posts AS (
  SELECT CAST(page_id AS varchar) AS id,
         regexp_extract(html, '<title>([^<]*)</title>', 1) AS title,
         'deleted' AS author, 'web' AS subreddit, CAST(length(html) AS int) AS score,
         CAST(0 AS double) AS created_utc, url, CAST(0 AS int) AS num_comments, html AS text
  FROM pages)"""

SNAPSHOT_COLUMNS = "id, author, ts, score{0} AS score, subreddit, text, ts{1} AS ingest_ts"

# -- keywords -----------------------------------------------------------------------------------


def _terms(source: str, keep: str = "id", stops: bool = True) -> str:
    drop = f" AND word NOT IN ({STOPS})" if stops else ""
    return f"""terms AS (
  SELECT {keep}, lower(word) AS word
  FROM (SELECT {keep}, unnest(string_split_regex(text, '{SPACES}')) AS word FROM {source})
  WHERE word <> ''{drop})"""


def _tfidf(
    source: str = TIMELINE, name: str = "timeline", size: int = 6 * 3600, slide: int = 3600, stops: bool = True
) -> list[str]:
    return [
        source,
        _terms(name, stops=stops),
        f"""windowed AS (
  SELECT id, time_bucket(INTERVAL {slide} SECOND, ts, TIMESTAMP '1970-01-01') - to_seconds({slide} * k)
           AS window_start
  FROM {name}, range({size // slide}) AS steps(k))""",
        "tf AS (SELECT id, word, count(*) AS tf FROM terms GROUP BY ALL)",
        "n AS (SELECT window_start, count(*) AS n_docs FROM windowed GROUP BY ALL)",
        """ranked AS (
  SELECT window_start, word, sum(tf) AS total_tf, count(*) AS df,
         row_number() OVER (PARTITION BY window_start ORDER BY sum(tf) DESC, word) AS place
  FROM windowed JOIN tf USING (id) GROUP BY window_start, word)""",
        """vocabulary AS (
  SELECT window_start, word, CAST(total_tf AS bigint) AS total_tf, df, n_docs,
         ln(CAST(n_docs + 1 AS double) / CAST(df + 1 AS double)) AS idf
  FROM ranked JOIN n USING (window_start) WHERE place <= 1000)""",
        """scored AS (
  SELECT window_start, id, word, tf, tf * idf AS tfidf
  FROM windowed JOIN tf USING (id) JOIN vocabulary USING (window_start, word))""",
    ]


TFIDF = _tfidf()
WINDOWED = TFIDF[2]


def _span(size: int = 6 * 3600) -> str:
    return f"window_start, window_start + INTERVAL {size} SECOND AS window_end"


SPAN = _span()


def _top_pairs(size: int = 6 * 3600) -> str:
    return f"""SELECT word, round(tfidf, 6) AS tfidf, CAST(rank AS int) AS rank, {_span(size)}
FROM (SELECT *, row_number() OVER (PARTITION BY window_start
        ORDER BY round(tfidf, 10) DESC, word, tf DESC, id) AS rank FROM scored)
WHERE rank <= 10"""


TOP_PAIRS = _top_pairs()

TOP_PER_DOC = f"""SELECT {SPAN}, id, word, round(tfidf, 6) AS tfidf, CAST(rank AS int) AS rank
FROM (SELECT *, row_number() OVER (PARTITION BY window_start, id
        ORDER BY round(tfidf, 10) DESC, word) AS rank FROM scored)
WHERE rank <= 10"""


def _global_tfidf(words: int | None = None) -> str:
    """Window functions throughout: a table joined to what was made of it would be built twice."""
    return (
        _with(
            DOCS,
            _terms("docs"),
            "tf AS MATERIALIZED (SELECT id, word, count(*) AS tf FROM terms GROUP BY ALL)",
            "n AS MATERIALIZED (SELECT count(*) AS n_docs FROM docs)",
            """weighted AS (
  SELECT id, word, tf, sum(tf) OVER same AS total,
         ln(CAST(n_docs + 1 AS double) / (count(*) OVER same + 1)) AS idf
  FROM tf, n WINDOW same AS (PARTITION BY word))""",
            "ranked AS (SELECT *, dense_rank() OVER (ORDER BY total DESC, word) AS place FROM weighted)",
        )
        + "SELECT id, word, round(tf * idf, 6) AS tfidf FROM "
        + (f"ranked WHERE place <= {words}" if words else "weighted")
    )


# -- annotation ---------------------------------------------------------------------------------

BENCH_WORDS = f"""bench AS (
  SELECT DISTINCT word FROM (
    SELECT regexp_replace(lower(unnest(string_split_regex(text, '{SPACES}'))), '[^a-z]', '', 'g')
             AS word
    FROM benchmark)
  WHERE word <> '')"""

LEXICON = """lexicon AS (
  SELECT word, ((ascii(word) + length(word)) % 9 - 4) / 2.0 AS valence FROM bench
  WHERE (ascii(word) + length(word)) % 9 <> 4)"""

LEMMA_TABLE = """lemma_table AS (
  SELECT word, left(word, length(word) - 1) AS lemma FROM bench
  WHERE word LIKE '%s' AND length(word) > 2)"""

TAG_TABLE = """tag_table AS (
  SELECT word, CASE WHEN word LIKE '%n' THEN 'JJ' ELSE 'RB' END AS tag FROM bench
  WHERE word LIKE '%n' OR word LIKE '%y')"""


def _values(name: str, columns: str, entries: dict) -> str:
    rows = ", ".join(
        "('" + k.replace("'", "''") + "', " + (f"'{v}'" if isinstance(v, str) else f"{v}::double") + ")"
        for k, v in entries.items()
    )
    return f"{name}({columns}) AS (VALUES {rows})"


def _tokens(source: str = "docs", lemmas: str = LEMMA_TABLE) -> list[str]:
    """Token, normal-form, lemma and clean-lemma tables, each (id, pos, token) by position."""
    return [
        f"""matched AS (
  SELECT id, regexp_extract_all(text, '{WORD_TOKEN}') AS found FROM {source})""",
        """tokens AS (
  SELECT id, unnest(found) AS token, unnest(range(len(found))) AS pos FROM matched)""",
        r"""normal AS (
  SELECT id, pos, regexp_replace(lower(token), '[^\p{L}+]', '', 'g') AS token FROM tokens
  WHERE regexp_replace(lower(token), '[^\p{L}+]', '', 'g') <> '')""",
        BENCH_WORDS,
        lemmas,
        """lemma AS (
  SELECT id, pos, coalesce(lemma, token) AS token FROM normal LEFT JOIN lemma_table ON token = word)""",
        f"""clean AS (
  SELECT id, pos, token FROM lemma WHERE lower(token) NOT IN ({STOPS}))""",
    ]


def _lines(table: str, name: str, token: str = "token", more: tuple[str, ...] = ()) -> str:
    return (
        _with(DOCS, *_tokens(), *more)
        + f"""SELECT d.id, coalesce(l.line, '') AS {name} FROM docs d LEFT JOIN (
  SELECT id, string_agg({token}, ' ' ORDER BY pos) AS line FROM {table} GROUP BY id) l USING (id)"""
    )


TAGGED = """tagged AS (
  SELECT id, pos, token, coalesce(tag, 'NN') AS tag,
         row_number() OVER (PARTITION BY id ORDER BY pos) AS place
  FROM lemma LEFT JOIN tag_table ON token = word)"""

TAG_OPTIONS = """options AS (
  SELECT word, CASE right(word, 1) WHEN 'n' THEN 'JJ|NN' WHEN 'y' THEN 'RB' ELSE 'NN|VB' END AS tags
  FROM bench WHERE right(word, 1) IN ('n', 'y', 'e'))"""


def _sequence_tags(rounds: int = 4) -> str:
    """Rounds of learning spelled out, then the best path through each run of open tokens."""
    learning = ["weights0 AS (SELECT DISTINCT t, u, 1.0::double AS w FROM tag_pairs)"]
    for k in range(1, rounds + 1):
        learning.append(f"""weights{k} AS MATERIALIZED (
  SELECT t, u, sum(n * w / total) AS w
  FROM (SELECT t, u, n, w, sum(w) OVER (PARTITION BY a, b) AS total
        FROM tag_pairs JOIN weights{k - 1} USING (t, u)) GROUP BY t, u)""")
    parts = _with(
        DOCS,
        *_tokens(),
        TAG_OPTIONS,
        """sets AS MATERIALIZED (
  SELECT id, tags, row_number() OVER (PARTITION BY id ORDER BY pos) AS place
  FROM (SELECT id, pos, coalesce(tags, 'NN') AS tags FROM lemma LEFT JOIN options ON token = word))""",
        """set_pairs AS MATERIALIZED (
  SELECT a, b, count(*) AS n FROM (
    SELECT tags AS a, coalesce(lead(tags) OVER (PARTITION BY id ORDER BY place), '$') AS b FROM sets
    UNION ALL SELECT '^', tags FROM sets WHERE place = 1) GROUP BY a, b)""",
        """tag_pairs AS MATERIALIZED (
  SELECT a, b, n, t, unnest(string_split(b, '|')) AS u
  FROM (SELECT a, b, n, unnest(string_split(a, '|')) AS t FROM set_pairs))""",
        *learning,
        f"""costs AS MATERIALIZED (
  SELECT t, u, CAST(round(-1000000 * ln((w + 0.1)
           / (sum(w) OVER (PARTITION BY t) + 0.1 * count(*) OVER (PARTITION BY t)))) AS bigint) AS cost
  FROM (SELECT l.t, r.u, coalesce(w, 0) AS w
        FROM (SELECT DISTINCT t FROM tag_pairs) l CROSS JOIN (SELECT DISTINCT u FROM tag_pairs) r
        LEFT JOIN weights{rounds} k ON k.t = l.t AND k.u = r.u))""",
        """open_tokens AS MATERIALIZED (
  SELECT *, place - row_number() OVER (PARTITION BY id ORDER BY place) AS run
  FROM (SELECT *, coalesce(lag(tags) OVER same, '^') AS before, coalesce(lead(tags) OVER same, '$') AS after
        FROM sets WINDOW same AS (PARTITION BY id ORDER BY place))
  WHERE contains(tags, '|'))""",
        """choices AS MATERIALIZED (SELECT *, unnest(string_split(tags, '|')) AS tag FROM open_tokens)""",
        """paths AS (
  SELECT id, run, place, tag, after, cost, before AS back
  FROM choices JOIN costs ON t = before AND u = tag WHERE NOT contains(before, '|')
  UNION ALL
  SELECT c.id, c.run, c.place, c.tag, c.after, min(p.cost + k.cost),
         min({'cost': p.cost + k.cost, 'tag': p.tag}).tag
  FROM paths p JOIN choices c ON c.id = p.id AND c.run = p.run AND c.place = p.place + 1
  JOIN costs k ON k.t = p.tag AND k.u = c.tag
  GROUP BY c.id, c.run, c.place, c.tag, c.after)""",
        """chosen AS (
  SELECT p.id, p.run, p.place, min({'cost': p.cost + k.cost, 'tag': p.tag, 'back': p.back}) AS best
  FROM paths p JOIN costs k ON k.t = p.tag AND k.u = p.after
  WHERE NOT contains(p.after, '|') GROUP BY p.id, p.run, p.place
  UNION ALL
  SELECT p.id, p.run, p.place, {'cost': p.cost, 'tag': p.tag, 'back': p.back}
  FROM chosen c JOIN paths p ON p.id = c.id AND p.run = c.run AND p.place = c.place - 1 AND p.tag = c.best.back)""",
    )
    return (
        parts.replace("WITH ", "WITH RECURSIVE ", 1)
        + """SELECT d.id, coalesce(l.line, '') AS tags FROM docs d LEFT JOIN (
  SELECT s.id, string_agg(coalesce(c.best.tag, s.tags), ' ' ORDER BY s.place) AS line
  FROM sets s LEFT JOIN chosen c ON c.id = s.id AND c.place = s.place GROUP BY s.id) l USING (id)"""
    )


# Runs of equal tags, each with the word that follows it.
RUNS = """followed AS MATERIALIZED (
  SELECT *, lead(token) OVER (PARTITION BY id ORDER BY place) AS next_token,
         lead(tag) OVER (PARTITION BY id ORDER BY place) AS next_tag,
         place - row_number() OVER (PARTITION BY id, tag ORDER BY place) AS run
  FROM tagged),
runs AS MATERIALIZED (
  SELECT id, tag, count(*) AS len, string_agg(token, ' ' ORDER BY place) AS phrase,
         last(next_token ORDER BY place) AS next_token, last(next_tag ORDER BY place) AS next_tag
  FROM followed GROUP BY id, tag, run)"""

CHUNKS = """SELECT id, phrase || ' ' || next_token AS chunk FROM runs WHERE tag = 'JJ' AND next_tag = 'NN'
UNION ALL
SELECT id, phrase AS chunk FROM runs WHERE tag = 'NN' AND len > 1"""

# -- sentiment ----------------------------------------------------------------------------------


QUERY_BOOSTERS = {"er": 0.293, "tion": 0.293, "ti": -0.293}
QUERY_NEGATORS = ("nd", "es", "ed", "st")


def _sentiment(
    source: str = "docs",
    rules: bool = True,
    lexicon: str = LEXICON,
    lemmas: str = LEMMA_TABLE,
    boosters: dict = QUERY_BOOSTERS,
    negators: Collection[str] = QUERY_NEGATORS,
) -> list[str]:
    """... scores (id, compound, positive, neutral, negative)."""
    parts = [*_tokens(source, lemmas), lexicon]
    if not rules:
        parts.append(
            """valued AS (
  SELECT id, coalesce(valence, 0.0) AS v FROM clean LEFT JOIN lexicon ON token = word)"""
        )
        return [*parts, *_polarity(source)]
    parts += [
        _values("boosters", "word, boost", boosters),
        f"""marked AS (
  SELECT id, token, valence, boost, token IN ({", ".join(f"'{n}'" for n in negators)}) AS flips,
         row_number() OVER (PARTITION BY id ORDER BY pos) AS place
  FROM clean LEFT JOIN lexicon l ON token = l.word LEFT JOIN boosters b ON token = b.word)""",
        """near AS (
  SELECT *, """
        + ", ".join(
            f"lag({c}, {b}) OVER w AS {c}{b}"
            for b in (1, 2, 3)
            for c in ("token", "valence", "boost", "flips")
        )
        + " FROM marked WINDOW w AS (PARTITION BY id ORDER BY place))",
        "step0 AS (SELECT *, CAST(valence AS double) AS v FROM near)",
    ]
    for back, damp in ((1, 1.0), (2, 0.95), (3, 0.9)):
        doubt = {
            2: " AND NOT (token2 = 'without' AND token1 = 'doubt')",
            3: " AND NOT (token3 = 'without' AND 'doubt' IN (token1, token2))",
        }.get(back, "")
        moved = f"(v + sign_of * coalesce(boost{back}, 0.0) * {damp}::double)"
        parts.append(
            f"""step{back} AS (
  SELECT * EXCLUDE (v, sign_of),
    CASE WHEN token{back} IS NULL OR valence{back} IS NOT NULL THEN v
         WHEN flips{back}{doubt} THEN {moved} * -0.74::double ELSE {moved} END AS v
  FROM (SELECT *, CASE WHEN v < 0 THEN -1 ELSE 1 END AS sign_of FROM step{back - 1}))"""
        )
    parts.append(
        """valued AS (
  SELECT id, CASE WHEN valence IS NULL OR boost IS NOT NULL THEN 0.0
    WHEN token1 = 'least' AND valence1 IS NULL THEN v * -0.74 ELSE v END AS v FROM step3)"""
    )
    return [*parts, *_polarity(source)]


def _polarity(source: str) -> list[str]:
    return [
        """sums AS (
  SELECT id, sum(v) AS s, sum(CASE WHEN v > 0 THEN v + 1 ELSE 0 END) AS pos,
    sum(CASE WHEN v < 0 THEN 1 - v ELSE 0 END) AS neg,
    sum(CASE WHEN v = 0 THEN 1 ELSE 0 END) AS neu FROM valued GROUP BY id)""",
        f"""scores AS (
  SELECT x.id, coalesce(round(s / sqrt(s * s + 15), 4), 0.0) AS compound,
    coalesce(round(pos / (pos + neg + neu), 3), 0.0) AS positive,
    coalesce(round(neu / (pos + neg + neu), 3), 0.0) AS neutral,
    coalesce(round(neg / (pos + neg + neu), 3), 0.0) AS negative
  FROM {source} x LEFT JOIN sums USING (id))""",
    ]


SCORES = [DOCS, *_sentiment()]
SCORE_ROWS = "SELECT id, compound, positive, neutral, negative FROM scores"


HISTOGRAM = """
, stats AS (SELECT min(compound) AS low, max(compound) AS high FROM scores)
, placed AS (
  SELECT CASE WHEN high > low
           THEN least(CAST(floor((compound - low) / ((high - low) / 30.0)) AS bigint), 29)
           ELSE 0 END AS bin, count(*) AS n
  FROM scores, stats GROUP BY ALL)
SELECT b.bin, round(low + b.bin * ((high - low) / 30.0), 6) AS bin_start,
  round(low + (b.bin + 1) * ((high - low) / 30.0), 6) AS bin_end, coalesce(n, 0) AS "count"
FROM range(30) AS b(bin) CROSS JOIN stats LEFT JOIN placed ON placed.bin = b.bin"""

DENSITY = """
, stats AS (
  SELECT min(compound) AS low, max(compound) AS high, count(*) AS n,
    stddev_samp(compound) * pow(count(*), -0.2) AS h FROM scores)
SELECT CAST(p AS int) AS point, round(low + p * (high - low) / 199.0, 6) AS x,
  round(sum(exp(-pow((low + p * (high - low) / 199.0 - compound) / h, 2) / 2))
        / (any_value(n) * any_value(h) * sqrt(2 * pi())), 6) AS density
FROM scores, stats, range(200) AS g(p) GROUP BY p, low, high"""


ORACLES = {
    "ref_user": _first(USER),
    "ref_community": _first(COMMUNITY),
    "ref_url": _first(URL),
    "ref_all_union": _with(COMMENTS, REFS) + "SELECT ts, kind, reference FROM refs",
    "ref_all_matches": _with(
        COMMENTS,
        "named AS (SELECT ts, text || ' cc /u/' || author || ', /r/' || subreddit AS text"
        " FROM comments)",
    )
    + _union(
        "SELECT ts, '{kind}' AS kind, unnest(regexp_extract_all(text, '{pattern}', 0)) AS reference"
        " FROM named"
    ),
    "ref_counts_windowed": _with(COMMENTS, REFS, REF_COUNTS) + COUNTS_OUT,
    "parse_json_records": _with(COMMENTS) + f"SELECT {RECORD_COLUMNS} FROM comments",
    "malformed_lines": "SELECT text AS value FROM conversations",
    "shape_comments": _with(CONVERSATION_COMMENTS)
    + "SELECT *, CASE WHEN parent_id IS NULL THEN 'post' ELSE 'comment' END AS kind FROM talk",
    "shape_posts": _with(PAGE_POSTS) + "SELECT * FROM posts",
    "accumulated_rows": _with(CONVERSATION_COMMENTS, PAGE_POSTS)
    + "SELECT * FROM talk UNION ALL BY NAME SELECT * FROM posts",
    "dedup_records": _with(COMMENTS)
    + f"SELECT {SNAPSHOT_COLUMNS.format('', '')} FROM comments",
    "latest_snapshot": _with(COMMENTS)
    + f"SELECT {SNAPSHOT_COLUMNS.format(' + 1', ' + INTERVAL 5 MINUTE')} FROM comments",
    "stopword_filtered": _with(DOCS)
    + f"""SELECT id, array_to_string(list_filter(string_split_regex(text, '{SPACES}'),
  lambda w: w <> '' AND w NOT IN ({STOPS})), ' ') AS filtered_text FROM docs""",
    "tokenized_terms": _with(DOCS)
    + f"""SELECT id, array_to_string(words, ' ') AS words, CAST(len(words) AS int) AS n_words
FROM (SELECT id, list_transform(list_filter(string_split_regex(text, '{SPACES}'),
  lambda w: w <> ''), lambda w: lower(w)) AS words FROM docs)""",
    "term_counts": _with(DOCS, _terms("docs"))
    + "SELECT id, word, count(*) AS tf FROM terms GROUP BY ALL",
    "window_texts": _with(TIMELINE, WINDOWED)
    + f"SELECT {SPAN}, id, text FROM windowed JOIN timeline USING (id)",
    "idf_windowed": _with(*TFIDF)
    + f"SELECT {SPAN}, word, total_tf, df, n_docs, round(idf, 6) AS idf FROM vocabulary",
    "tfidf_top10_windowed": _with(*TFIDF) + TOP_PAIRS,
    "tfidf_top10_words": _with(*TFIDF)
    + f"""SELECT word, round(tfidf, 6) AS tfidf, CAST(rank AS int) AS rank, {SPAN}
FROM (SELECT *, row_number() OVER (PARTITION BY window_start
        ORDER BY round(tfidf, 10) DESC, word) AS rank
      FROM (SELECT window_start, word, max(tfidf) AS tfidf FROM scored GROUP BY ALL))
WHERE rank <= 10""",
    "tfidf_top10_per_doc": _with(*TFIDF) + TOP_PER_DOC,
    "tfidf_per_doc_all_words": _with(*_tfidf(stops=False)) + TOP_PER_DOC,
    "tfidf_top10_minute": _with(*_tfidf(size=60, slide=5)) + _top_pairs(60),
    "job_keywords": _with(*_tfidf(COMMENTS, "comments")) + TOP_PAIRS,
    "tfidf_global": _global_tfidf(),
    "tfidf_global_top_words": _global_tfidf(1000),
    "tfidf_vectors_pipeline": _global_tfidf(),
    "nlp_tokens": _with(DOCS, *_tokens()[:2])
    + """SELECT d.id, coalesce(string_agg(token, ' ' ORDER BY pos), '') AS tokens,
  CAST(count(token) AS int) AS n_tokens FROM docs d LEFT JOIN tokens USING (id) GROUP BY d.id""",
    "normalized_tokens": _lines("normal", "tokens"),
    "lemmas": _lines("lemma", "lemmas"),
    "lemmas_joined": _lines("lemma", "lemmas"),
    "lemmas_without_stopwords": _lines("clean", "lemmas"),
    "pos_tags": _lines("tagged", "tags", "tag", (TAG_TABLE, TAGGED)),
    "pos_tags_sequence": _sequence_tags(),
    "noun_chunks": _with(DOCS, *_tokens(), TAG_TABLE, TAGGED, RUNS) + CHUNKS,
    "processed_text": _lines("clean", "processed_text"),
    "sentiment_scores": _with(*SCORES) + SCORE_ROWS,
    "sentiment_plain": _with(DOCS, *_sentiment(rules=False)) + SCORE_ROWS,
    "sentiment_rows": _with(
        COMMENTS,
        *_sentiment("comments"),
        *[
            f"{t}_line AS (SELECT id, string_agg(token, ' ' ORDER BY pos) AS line FROM {t} GROUP BY id)"
            for t in ("clean", "normal", "tokens")
        ],
    )
    + """SELECT c.*, coalesce(cl.line, '') AS finished_no_stop_lemmatized,
  coalesce(nl.line, '') AS finished_normalized, coalesce(tl.line, '') AS finished_tokenized,
  coalesce(cl.line, '') AS processed_text, compound, positive, neutral, negative
FROM comments c JOIN scores USING (id) LEFT JOIN clean_line cl USING (id)
LEFT JOIN normal_line nl USING (id) LEFT JOIN tokens_line tl USING (id)""",
    "mean_sentiment": _with(*SCORES)
    + """SELECT 'neutral' AS sentiment, round(avg(neutral), 6) AS mean FROM scores
UNION ALL SELECT 'positive', round(avg(positive), 6) FROM scores
UNION ALL SELECT 'negative', round(avg(negative), 6) FROM scores""",
    "compound_over_time": _with(TIMELINE, *_sentiment("timeline"))
    + """SELECT ts, round(avg(compound), 6) AS compound FROM timeline JOIN scores USING (id)
GROUP BY ts""",
    "word_frequencies": _with(DOCS, *_tokens())
    + """SELECT word, n, round(CAST(n AS double) / max(n) OVER (), 6) AS weight
FROM (SELECT token AS word, count(*) AS n FROM clean GROUP BY token
      ORDER BY n DESC, word LIMIT 200)""",
    "compound_histogram": _with(*SCORES) + HISTOGRAM.lstrip(),
    "compound_density": _with(*SCORES) + DENSITY.lstrip(),
    "value_density_binned": """
WITH scores AS (SELECT sqrt(value) AS x FROM events WHERE value IS NOT NULL),
stats AS (SELECT min(x) AS low, max(x) AS high, count(*) AS n, stddev_samp(x) * pow(count(*), -0.2) AS h FROM scores),
spots AS (
  SELECT place, least(CAST(floor(place) AS bigint), 2047) AS cell
  FROM (SELECT (x - low) / (high - low) * 2048 AS place FROM scores, stats)),
grid AS (
  SELECT cell, sum(weight) AS weight FROM (
    SELECT cell, 1 - (place - cell) AS weight FROM spots
    UNION ALL SELECT cell + 1, place - cell FROM spots) GROUP BY cell)
SELECT CAST(p AS int) AS point, round(low + p * (high - low) / 199.0, 6) AS x,
  round(sum(weight * exp(-pow((low + p * (high - low) / 199.0 - (low + cell * (high - low) / 2048.0)) / h, 2) / 2))
        / (any_value(n) * any_value(h) * sqrt(2 * pi())), 6) AS density
FROM grid, stats, range(200) AS g(p) GROUP BY p, low, high""",
    "simulated_sentiment": _with(COMMENTS)
    + f"""SELECT id, score / 100.0::double AS compound, score / 200.0::double AS neutral,
  score / 300.0::double AS positive, score / 400.0::double AS negative,
  array_to_string(list_filter(string_split_regex(text, '{SPACES}'), lambda w: w <> ''), ' ')
    AS finished_no_stop_lemmatized, ts FROM comments""",
    "latest_rows": _with(COMMENTS) + "SELECT * FROM comments ORDER BY ts DESC, id DESC LIMIT 1000",
    "reference_view": _with(COMMENTS, REFS, REF_COUNTS) + COUNTS_OUT,
    "stream_ref_counts": _with(COMMENTS, REFS, REF_COUNTS)
    + COUNTS_OUT
    + """
WHERE window_start + INTERVAL 60 SECOND
  <= (SELECT date_trunc('millisecond', max(ts)) - INTERVAL 10 MINUTE FROM comments)""",
    "stream_dedup": _with(COMMENTS) + "SELECT * FROM comments",
    "stream_sentiment": _with(*SCORES) + SCORE_ROWS,
    "stream_keywords": _with(*TFIDF) + TOP_PAIRS,
    "stream_latest_snapshot": _with(COMMENTS)
    + f"SELECT {SNAPSHOT_COLUMNS.format(' + 1', ' + INTERVAL 5 MINUTE')} FROM comments",
    "stream_first_seen": _with(COMMENTS) + "SELECT * FROM comments",
    "stream_compaction": _with(COMMENTS) + "SELECT * FROM comments",
    "stream_mean_sentiment": _with(TIMELINE, *_sentiment("timeline"))
    + """SELECT 'neutral' AS sentiment, round(avg(neutral), 6) AS mean FROM scores
UNION ALL SELECT 'positive', round(avg(positive), 6) FROM scores
UNION ALL SELECT 'negative', round(avg(negative), 6) FROM scores""",
    "stream_compound_over_time": _with(TIMELINE, *_sentiment("timeline"))
    + """SELECT ts, round(avg(compound), 6) AS compound FROM timeline JOIN scores USING (id)
GROUP BY ts""",
    "stream_word_frequencies": _with(TIMELINE, *_tokens("timeline"))
    + """SELECT word, n, round(CAST(n AS double) / max(n) OVER (), 6) AS weight
FROM (SELECT token AS word, count(*) AS n FROM clean GROUP BY token
      ORDER BY n DESC, word LIMIT 200)""",
    "stream_compound_histogram": _with(TIMELINE, *_sentiment("timeline")) + HISTOGRAM.lstrip(),
    "stream_compound_density": _with(TIMELINE, *_sentiment("timeline")) + DENSITY.lstrip(),
    "stream_ingest": _with(COMMENTS) + f"SELECT {RECORD_COLUMNS} FROM comments",
    "stream_sentiment_large_dictionary": _with(*SCORES) + SCORE_ROWS,
    "job_ingest": _with(COMMENTS)
    + f"""SELECT {RECORD_COLUMNS}, CAST(NULL AS varchar) AS title, CAST(NULL AS varchar) AS url,
  CAST(NULL AS int) AS num_comments, 'comment' AS kind FROM comments""",
    "job_quarantine": "SELECT unnest(string_split(text, chr(10))) AS value FROM conversations",
    "job_dashboard": _with(COMMENTS, *_sentiment("comments"))
    + HISTOGRAM.lstrip().replace("SELECT b.bin, round", ", bins AS (SELECT b.bin, round")
    + """)
SELECT 'mean_sentiment' AS chart, 'neutral' AS label, round(avg(neutral), 6) AS value FROM scores
UNION ALL SELECT 'mean_sentiment', 'positive', round(avg(positive), 6) FROM scores
UNION ALL SELECT 'mean_sentiment', 'negative', round(avg(negative), 6) FROM scores
UNION ALL SELECT 'compound_histogram', CAST(bin AS varchar), CAST("count" AS double) FROM bins""",
    "job_references": _with(COMMENTS, REFS, REF_COUNTS) + COUNTS_OUT,
    "job_sentiment": _with(COMMENTS, *_sentiment("comments"))
    + """SELECT s.id, 'comment' AS kind, coalesce(line, '') AS processed_text,
  compound, positive, neutral, negative
FROM scores s LEFT JOIN (
  SELECT id, string_agg(token, ' ' ORDER BY pos) AS line FROM clean GROUP BY id) USING (id)""",
    "append_twice": _with(DOCS) + "SELECT * FROM docs UNION ALL SELECT * FROM docs",
    "json_round_trip": "SELECT conv_id, turn, role, text FROM conversations",
    "ref_counts_nested": _with(COMMENTS, REFS, REF_COUNTS) + COUNTS_OUT,
    "sentiment_default_tables": _with(
        """docs AS (
  SELECT CAST(doc_id AS varchar) AS id,
         text || ' People really loved it, the worst fears were not true.' AS text FROM documents)""",
        *_sentiment(
            lexicon=_values("lexicon", "word, valence", wordlists.LEXICON),
            lemmas=_values("lemma_table", "word, lemma", wordlists.LEMMAS),
            boosters=wordlists.BOOSTERS,
            negators=wordlists.NEGATORS,
        ),
    )
    + SCORE_ROWS,
}
