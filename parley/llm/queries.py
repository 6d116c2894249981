"""The corpus operators as queries over the given tables, and SQL twins where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parley.llm import url_filters
from parley.llm.common import read
from parley.llm.decontamination import contaminated
from parley.llm.exact_dedup import exact_dedup
from parley.llm.jaccard_join import jaccard_join
from parley.llm.language_id import language_id
from parley.llm.lexical_search import lexical_search
from parley.llm.line_dedup import NEAR, line_dedup
from parley.llm.merkle import merkle_audit
from parley.llm.packing import pack_documents
from parley.llm.sharding import shard
from parley.llm.token_counts import token_counts
from parley.llm.token_output import token_output
from parley.llm.warc import warc_round_trip
from parley.session import work_dir


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(read(spark, sf_dir, "documents"))


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard(read(spark, sf_dir, "documents"))


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = line_dedup(read(spark, sf_dir, "documents"), **NEAR)
    return docs.select("doc_id", "n_lines", "n_dropped", "text")


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id(read(spark, sf_dir, "documents"))


def url_captures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page, fetched at the time of the event of its number (numbers wrap around)."""
    pages, events = read(spark, sf_dir, "pages"), read(spark, sf_dir, "events")
    pages = pages.select("page_id", "url", (F.col("page_id") % events.count()).alias("event_id"))
    times = events.select("event_id", F.col("ts").alias("fetched"))
    return pages.join(times, "event_id", "left").select("page_id", "url", "fetched")


def url_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A dated list: errors block, purchases allow and clicks free what the event's page lies under.

    In turn that is the page's domain, its host, or its host with the first folder.
    """
    pages, events = read(spark, sf_dir, "pages"), read(spark, sf_dir, "events")
    action = (
        F.when(F.col("event_type") == "error", "block")
        .when(F.col("event_type") == "purchase", "allow")
        .when(F.col("event_type") == "click", "remove")
    )
    host = url_filters.host(F.col("url"))
    grain = (
        F.when(F.col("event_id") % 3 == 0, F.regexp_extract(host, r"([^.]+\.[^.]+)$", 1))
        .when(F.col("event_id") % 3 == 1, host)
        .otherwise(F.concat(host, F.lit("/"), url_filters.first_folder(F.col("url"))))
    )
    events = events.withColumn("page_id", F.col("event_id") % pages.count())
    return events.join(pages.select("page_id", "url"), "page_id").select(
        grain.alias("pattern"), action.alias("action"), F.col("ts").alias("dated")
    )


def op5_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filters.filter_urls(url_captures(spark, sf_dir), url_entries(spark, sf_dir))


def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(read(spark, sf_dir, "documents"))


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(read(spark, sf_dir, "documents"))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op9_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_output(read(spark, sf_dir, "documents"), work_dir(spark, "token-output"))


def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join(read(spark, sf_dir, "documents"))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle_audit(read(spark, sf_dir, "documents"))


def op12_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc_round_trip(read(spark, sf_dir, "pages"), work_dir(spark, "warc"))


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_exact_dedup,
        op2_sharding,
        op3_line_dedup,
        op4_language_id,
        op5_url_filters,
        op6_best_fit_packing,
        op7_token_counts,
        op8_decontamination,
        op9_token_output,
        op10_jaccard_join,
        op11_merkle_manifest,
        op12_warc,
        op13_lexical_search,
    )
}

ORACLES = {
    "op1_exact_dedup": """
        SELECT doc_id,
               max(doc_id) OVER same AS keep_id,
               count(*) OVER same AS group_size,
               doc_id = max(doc_id) OVER same AS kept,
               sha256(coalesce(text, '')) AS text_sha256
        FROM documents
        WINDOW same AS (PARTITION BY coalesce(text, ''))
    """,
    "op5_url_filters": r"""
        WITH parsed AS (
            SELECT page_id,
                   lower(coalesce(regexp_extract(url,
                       '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]+)(?::[0-9]*)?(/[^?#]*)?', 1), '')) AS host,
                   regexp_extract(coalesce(regexp_extract(url,
                       '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]+)(?::[0-9]*)?(/[^?#]*)?', 2), ''),
                       '^/([^/]+)', 1) AS folder
            FROM pages
        ),
        entries AS (
            SELECT CASE e.event_id % 3 WHEN 0 THEN regexp_extract(p.host, '([^.]+\.[^.]+)$', 1)
                                       WHEN 1 THEN p.host
                                       ELSE p.host || '/' || p.folder END AS pattern,
                   max(CASE e.event_type WHEN 'error' THEN 2 WHEN 'purchase' THEN 1 WHEN 'click' THEN 0 END) AS strength,
                   e.ts AS dated
            FROM events e JOIN parsed p ON e.event_id % (SELECT count(*) FROM pages) = p.page_id
            WHERE e.event_type IN ('error', 'purchase', 'click')
            GROUP BY ALL
        ),
        valid AS (
            SELECT pattern, strength, dated AS valid_from,
                   lead(dated) OVER (PARTITION BY pattern ORDER BY dated) AS valid_to
            FROM entries
        ),
        captures AS (
            SELECT p.page_id, p.host, p.folder, e.ts AS fetched
            FROM parsed p LEFT JOIN events e ON p.page_id % (SELECT count(*) FROM events) = e.event_id
        ),
        covers AS (
            SELECT page_id, fetched, -1 AS depth, host || '/' || folder AS pattern FROM captures WHERE folder <> ''
            UNION ALL
            SELECT page_id, fetched, i AS depth, array_to_string(list_slice(string_split(host, '.'), i, len(string_split(host, '.'))), '.') AS pattern
            FROM captures, LATERAL (SELECT unnest(generate_series(1, greatest(len(string_split(host, '.')) - 1, 1))) AS i)
            WHERE host <> ''
        ),
        found AS (
            SELECT c.page_id, c.depth, c.pattern, v.strength, v.valid_from,
                   row_number() OVER (PARTITION BY c.page_id ORDER BY c.depth) AS place
            FROM covers c JOIN valid v
              ON c.pattern = v.pattern AND v.strength > 0
             AND v.valid_from <= c.fetched AND (v.valid_to IS NULL OR c.fetched < v.valid_to)
        )
        SELECT c.page_id, c.fetched,
               CASE f.strength WHEN 2 THEN 'block' WHEN 1 THEN 'allow' ELSE 'none' END AS decision,
               f.pattern, f.valid_from AS since
        FROM captures c LEFT JOIN found f ON c.page_id = f.page_id AND f.place = 1
    """,
    "op11_merkle_manifest": """
        WITH RECURSIVE
        crc_steps AS (
            SELECT i, 0 AS k, i AS v FROM range(256) t(i)
            UNION ALL
            SELECT i, k + 1, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END
            FROM crc_steps WHERE k < 8
        ),
        crc_table AS (SELECT list(v ORDER BY i) AS t FROM crc_steps WHERE k = 8),
        rows AS (
            SELECT *, row_number() OVER () AS rid,
                   list_transform(range(1, length(doc_id::VARCHAR) + 1), lambda i: ord(substr(doc_id::VARCHAR, i, 1))::BIGINT) AS digits,
                   translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS other
            FROM documents
        ),
        fields AS (
            SELECT rid, doc_id, source,
                   xor(list_reduce(list_concat([4294967295::BIGINT], digits),
                       lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % 5 = 0 AS hit,
                   coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-')
                       || coalesce(strlen(source) || ':' || source, '-')
                       || coalesce(strlen(lang) || ':' || lang, '-')
                       || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') AS start,
                   coalesce(strlen(text) || ':' || text, '-') AS original,
                   coalesce(strlen(other) || ':' || other, '-') AS changed
            FROM rows, crc_table
        ),
        leaves AS (
            SELECT rid, doc_id, coalesce(strlen(source) || ':' || source, '-') AS tree, source,
                   sha256(start || original) AS leaf,
                   sha256(start || CASE WHEN hit THEN changed ELSE original END) AS copy
            FROM fields
        ),
        ranked AS (
            SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx FROM leaves
        ),
        nodes AS (
            SELECT tree, source, 0 AS lvl, idx, leaf AS digest FROM ranked
            UNION ALL
            SELECT tree, source, lvl + 1, idx >> 4, sha256(string_agg(digest, '' ORDER BY idx))
            FROM (SELECT *, count(*) OVER (PARTITION BY tree) AS n FROM nodes)
            WHERE n > 1 GROUP BY tree, source, lvl, idx >> 4
        ),
        counted AS (SELECT *, count(*) OVER (PARTITION BY tree, lvl) AS n FROM nodes),
        subroots AS (
            SELECT tree, digest AS subroot, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS place
            FROM counted WHERE n = 1
        ),
        top_nodes AS (
            SELECT 0 AS lvl, place AS idx, subroot AS digest FROM subroots
            UNION ALL
            SELECT lvl + 1, idx >> 4, sha256(string_agg(digest, '' ORDER BY idx))
            FROM (SELECT *, count(*) OVER () AS n FROM top_nodes)
            WHERE n > 1 GROUP BY lvl, idx >> 4
        ),
        top_counted AS (SELECT *, count(*) OVER (PARTITION BY lvl) AS n FROM top_nodes),
        siblings AS (
            SELECT r.rid, 0 AS tier, c.lvl, c.idx, r.idx >> (4 * c.lvl) AS own, c.digest
            FROM ranked r JOIN counted c
              ON c.tree = r.tree AND c.n > 1 AND c.idx >> 4 = r.idx >> (4 * c.lvl + 4)
            UNION ALL
            SELECT r.rid, 1, c.lvl, c.idx, s.place >> (4 * c.lvl), c.digest
            FROM ranked r JOIN subroots s USING (tree)
            JOIN top_counted c ON c.n > 1 AND c.idx >> 4 = s.place >> (4 * c.lvl + 4)
        ),
        steps AS (
            SELECT rid, row_number() OVER (PARTITION BY rid ORDER BY tier, lvl) AS step,
                   coalesce(string_agg(digest, '' ORDER BY idx) FILTER (idx < own), '') AS before,
                   coalesce(string_agg(digest, '' ORDER BY idx) FILTER (idx > own), '') AS after
            FROM siblings GROUP BY rid, tier, lvl
        ),
        folds AS (
            SELECT rid, 0 AS step, copy AS digest FROM ranked
            UNION ALL
            SELECT s.rid, s.step, sha256(s.before || f.digest || s.after)
            FROM folds f JOIN steps s ON s.rid = f.rid AND s.step = f.step + 1
        ),
        proofs AS (SELECT rid, string_agg(before || after, '' ORDER BY step) AS proof FROM steps GROUP BY rid)
        SELECT r.doc_id, r.leaf, s.subroot, t.digest AS root, sha256(coalesce(p.proof, '')) AS proof_sha256,
               f.digest AS folded_root, f.digest = t.digest AS verified
        FROM ranked r JOIN subroots s USING (tree) JOIN top_counted t ON t.n = 1
        LEFT JOIN proofs p USING (rid)
        JOIN (SELECT rid, arg_max(digest, step) AS digest FROM folds GROUP BY rid) f USING (rid)
    """,
    "op12_warc": """
        WITH hashed AS (
            SELECT page_id, coalesce(html, '') AS payload, sha1(coalesce(html, '')) AS hex FROM pages
        ),
        quarters AS (
            SELECT page_id, payload, k, ('0x' || substr(hex, 5 * k + 1, 5))::BIGINT AS bits
            FROM hashed, range(8) t(k)
        ),
        digests AS (
            SELECT page_id, payload, string_agg(
                substr(digits, (bits >> 15) + 1, 1) || substr(digits, ((bits >> 10) & 31) + 1, 1)
                || substr(digits, ((bits >> 5) & 31) + 1, 1) || substr(digits, (bits & 31) + 1, 1), '' ORDER BY k) AS digest
            FROM quarters, (SELECT 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567' AS digits)
            GROUP BY page_id, payload
        )
        SELECT page_id, strlen(payload) AS payload_bytes, digest AS payload_digest,
               CASE WHEN page_id = min(page_id) OVER same THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN page_id > min(page_id) OVER same THEN min(page_id) OVER same END AS refers_to
        FROM digests WINDOW same AS (PARTITION BY payload)
    """,
    "op13_lexical_search": r"""
        WITH texts AS (
            SELECT 'd' AS side, doc_id AS id, text FROM documents
            UNION ALL SELECT 'q', item_id, text FROM benchmark
        ),
        terms AS (
            SELECT side, id, term, count(*) AS tf
            FROM (
                SELECT side, id, unnest(regexp_extract_all(
                    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
                FROM texts
            )
            GROUP BY side, id, term
        ),
        docs AS MATERIALIZED (
            SELECT id, term, tf, sum(tf) OVER (PARTITION BY id)::BIGINT AS n, count(*) OVER (PARTITION BY term) AS df
            FROM terms WHERE side = 'd'
        ),
        whole AS (SELECT count(DISTINCT id) AS n_docs, sum(tf)::BIGINT AS n_terms FROM docs),
        weighted AS (
            SELECT id, term, tf, 25 + (75 * n * n_docs) // n_terms AS m,
                   floor(1000 * ln((2 * n_docs + 2) / (2 * df + 1)))::BIGINT AS weight
            FROM docs, whole
        ),
        scores AS (
            SELECT q.id AS item_id, w.id AS doc_id,
                   sum(q.tf * w.weight * ((1000000000 * w.tf) // (1000 * w.tf + 8 * w.m)))::BIGINT AS score
            FROM terms q JOIN weighted w ON q.term = w.term
            WHERE q.side = 'q' GROUP BY q.id, w.id
        )
        SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank, doc_id, score
        FROM scores WHERE score > 0
        QUALIFY rank <= 10
    """,
}
