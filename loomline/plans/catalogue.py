"""Named queries over the driver's tables, and the SQL that they are held against.

Each query applies one operator to its whole tables.  Times are shown as text,
so that both engines give the same values.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomline.fixtures import oracle, warehouse
from loomline.functions import text as X
from loomline.functions.vectors import cosine, hash_embed
from loomline.operators import chunkers, frontier, mutations
from loomline.operators import warehouse as W
from loomline.plans import chunk_sql, ivf, retrieval, table_functions
from loomline.schemas import serialized, validity, violations
from loomline.sources.work import fresh_path
from loomline.streaming import adaptive, control, queue

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}

#: The query vector of the search queries: 64 fixed components.
VECTOR = [((i * 37) % 19 - 9) / 10 for i in range(64)]
_VECTOR_SQL = "[" + ", ".join(f"{x}" for x in VECTOR) + "]::DOUBLE[]"
NOW = "timestamp'2024-02-01 00:00:00'"


def query(sql: str | None = None, *tables: str, name: str | None = None):
    """Register a query under its function's name, with its SQL over the named fixture tables."""

    def add(f: Callable[[SparkSession, str], DataFrame]):
        key = name or f.__name__
        QUERIES[key] = f
        if sql:
            ORACLE_SQL[key] = oracle(sql, *tables) if tables else sql
        return f

    return add


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def _shown(df: DataFrame, *times: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("string") for c in times})


def _rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in columns})


_FANOUT = "FROM discovered_urls d LEFT JOIN articles a ON d.id = a.crawled_from_url_id LEFT JOIN article_chunks c ON a.id = c.article_id"
_THREE = ("discovered_urls", "articles", "article_chunks")


# Statistics, integrity, deduplication


@query(
    f"""SELECT domain, count(d.id) AS total_urls, count(CASE WHEN crawl_status = 'completed' THEN 1 END) AS crawled_urls, count(CASE WHEN crawl_status = 'pending' THEN 1 END) AS pending_urls,
    count(CASE WHEN crawl_status = 'error' THEN 1 END) AS error_urls, count(a.id) AS total_articles, count(c.id) AS total_chunks,
    round(count(CASE WHEN crawl_status = 'completed' THEN 1 END) * 100.0e0 / count(d.id), 2) AS crawl_success_rate {_FANOUT} GROUP BY domain""",
    *_THREE,
)
def domain_stats(spark, sf_dir):
    return W.domain_stats(*warehouse(spark, sf_dir, *_THREE))


@query(
    f"""SELECT domain, count(DISTINCT d.id) AS total_urls, count(DISTINCT CASE WHEN crawl_status = 'completed' THEN d.id END) AS completed_urls, count(DISTINCT CASE WHEN crawl_status = 'pending' THEN d.id END) AS pending_urls,
    count(DISTINCT CASE WHEN crawl_status = 'error' THEN d.id END) AS error_urls, count(DISTINCT a.id) AS total_articles, CAST(sum(word_count) AS BIGINT) AS total_words, count(DISTINCT c.id) AS total_chunks,
    CAST(min(d.created_at) AS VARCHAR) AS first_discovered, CAST(max(d.updated_at) AS VARCHAR) AS last_updated {_FANOUT} GROUP BY domain""",
    *_THREE,
)
def domain_summary(spark, sf_dir):
    return _shown(W.domain_summary(*warehouse(spark, sf_dir, *_THREE)), "first_discovered", "last_updated")


@query(
    """SELECT count(d.id) AS total_discovered, count(CASE WHEN crawl_status = 'completed' THEN 1 END) AS total_crawled, count(CASE WHEN crawl_status = 'pending' THEN 1 END) AS total_pending,
    count(CASE WHEN crawl_status = 'error' THEN 1 END) AS total_errors, (SELECT count(*) FROM articles) AS total_articles, (SELECT count(*) FROM article_chunks) AS total_chunks,
    round((SELECT count(*) FROM article_chunks)::DOUBLE / (SELECT count(*) FROM articles), 2) AS avg_chunks_per_article, round(count(CASE WHEN crawl_status = 'completed' THEN 1 END) * 100.0e0 / count(d.id), 2) AS progress_percentage
    FROM discovered_urls d""",
    *_THREE,
)
def crawl_progress(spark, sf_dir):
    return W.crawl_progress(*warehouse(spark, sf_dir, *_THREE))


@query(
    """SELECT a.id, a.url, a.title, a.word_count, count(c.id) AS chunk_count, avg(c.chunk_size) AS avg_chunk_size, CAST(a.created_at AS VARCHAR) AS created_at
    FROM articles a LEFT JOIN article_chunks c ON a.id = c.article_id GROUP BY a.id, a.url, a.title, a.word_count, a.created_at""",
    "articles", "article_chunks",
)
def article_stats(spark, sf_dir):
    return _shown(W.article_stats(*warehouse(spark, sf_dir, "articles", "article_chunks")), "created_at")


_ERRORS = """SELECT * FROM (SELECT 'url_crawl' AS error_type, url, error_message, CAST(updated_at AS VARCHAR) AS error_time, crawl_attempts FROM discovered_urls WHERE crawl_status = 'error' AND error_message IS NOT NULL
    UNION ALL SELECT 'sitemap_parse', url, error_message, CAST(updated_at AS VARCHAR), 0 FROM sitemaps WHERE status = 'error' AND error_message IS NOT NULL) ORDER BY error_time DESC, url, error_type LIMIT 50"""


@query(_ERRORS, "discovered_urls", "sitemaps")
def recent_errors(spark, sf_dir):
    return _shown(W.recent_errors(*warehouse(spark, sf_dir, "discovered_urls", "sitemaps")), "error_time")


_INTEGRITY = " UNION ALL ".join(
    f"SELECT '{name}' AS check_name, CASE WHEN count(*) = 0 THEN 'OK' ELSE '{W.CHECKS[name][0]}' END AS status, count(*) AS issue_count, '{W.CHECKS[name][1]}' AS description FROM {rows}"
    for name, rows in {
        "orphaned_chunks": "article_chunks c LEFT JOIN articles a ON c.article_id = a.id WHERE a.id IS NULL", "articles_without_chunks": "articles a LEFT JOIN article_chunks c ON a.id = c.article_id WHERE c.id IS NULL",
        "duplicate_urls": "(SELECT url FROM discovered_urls GROUP BY url HAVING count(*) > 1)", "chunks_without_embeddings": "article_chunks WHERE embedding IS NULL",
    }.items()
)


@query(_INTEGRITY, *_THREE)
def data_integrity(spark, sf_dir):
    return W.data_integrity(*warehouse(spark, sf_dir, *_THREE))


_COUNTS = " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}" for t in (*_THREE, "sitemaps"))


@query(_COUNTS, *_THREE, "sitemaps")
def db_stats(spark, sf_dir):
    return W.db_stats(**dict(zip((*_THREE, "sitemaps"), warehouse(spark, sf_dir, *_THREE, "sitemaps"), strict=True)))


@query(f"SELECT count(*) AS tables, count(CASE WHEN row_count = 0 THEN 1 END) AS empty_tables, CAST(sum(row_count) AS BIGINT) AS total_rows, CASE WHEN sum(row_count) > 0 THEN 'OK' ELSE 'EMPTY' END AS status FROM ({_COUNTS})", *_THREE, "sitemaps")
def db_totals(spark, sf_dir):
    return W.db_totals(**dict(zip((*_THREE, "sitemaps"), warehouse(spark, sf_dir, *_THREE, "sitemaps"), strict=True)))


@query("SELECT url, count(*) AS copies FROM discovered_urls GROUP BY url HAVING count(*) > 1", "discovered_urls")
def duplicate_urls(spark, sf_dir):
    return W.duplicate_urls(*warehouse(spark, sf_dir, "discovered_urls"))


_RANKED = "(SELECT id, content_hash, first_value(id) OVER w AS kept_id, row_number() OVER w AS rn FROM articles WHERE content_hash IS NOT NULL WINDOW w AS (PARTITION BY content_hash ORDER BY created_at, id))"


@query(f"SELECT id, kept_id FROM {_RANKED} WHERE rn > 1", "articles")
def duplicate_articles(spark, sf_dir):
    return W.duplicate_articles(*warehouse(spark, sf_dir, "articles"))


@query(f"SELECT id, url, content_hash FROM articles WHERE id NOT IN (SELECT id FROM {_RANKED} WHERE rn > 1)", "articles")
def dedup_survivors(spark, sf_dir):
    return W.dedup_survivors(warehouse(spark, sf_dir, "articles")[0].select("id", "url", "content_hash", "created_at")).drop("created_at")


@query(f"WITH gone AS (SELECT id FROM {_RANKED} WHERE rn > 1) SELECT (SELECT count(*) FROM gone) AS deleted_articles, (SELECT count(*) FROM article_chunks WHERE article_id IN (SELECT id FROM gone)) AS deleted_chunks", "articles", "article_chunks")
def cleanup_duplicate_articles(spark, sf_dir):
    return W.cleanup_duplicates(*warehouse(spark, sf_dir, "articles", "article_chunks"))[2]


@query("SELECT c.id, c.article_id FROM article_chunks c LEFT JOIN articles a ON c.article_id = a.id WHERE a.id IS NULL", "articles", "article_chunks")
def orphan_chunks(spark, sf_dir):
    articles, chunks = warehouse(spark, sf_dir, "articles", "article_chunks")
    return W.orphan_chunks(chunks.select("id", "article_id"), articles)


@query("SELECT a.id, a.url FROM articles a LEFT JOIN article_chunks c ON a.id = c.article_id WHERE c.id IS NULL ORDER BY a.id LIMIT 100", "articles", "article_chunks")
def unprocessed_articles(spark, sf_dir):
    articles, chunks = warehouse(spark, sf_dir, "articles", "article_chunks")
    return W.unprocessed_articles(articles.select("id", "url"), chunks, 100)


@query("SELECT count(*) AS total_chunks, avg(chunk_size) AS avg_chunk_size, min(chunk_size) AS min_chunk_size, max(chunk_size) AS max_chunk_size FROM article_chunks", "article_chunks")
def chunk_statistics(spark, sf_dir):
    return W.chunk_statistics(*warehouse(spark, sf_dir, "article_chunks"))


@query("SELECT regexp_extract(url, '^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)', 1) AS domain, count(*) AS articles FROM articles GROUP BY 1", "articles")
def articles_per_domain(spark, sf_dir):
    return W.articles_per_domain(warehouse(spark, sf_dir, "articles")[0], X.domain(F.col("url")))


# Queue and mutations


@query("SELECT id, url, priority FROM discovered_urls WHERE crawl_status IS NULL OR crawl_status = 'pending' ORDER BY priority DESC NULLS LAST, coalesce(last_crawl_at, created_at), id LIMIT 100", "discovered_urls")
def pending_urls(spark, sf_dir):
    return W.pending_urls(*warehouse(spark, sf_dir, "discovered_urls")).select("id", "url", "priority")


@query("SELECT id, CASE WHEN crawl_status = 'error' OR crawl_status IS NULL THEN 'pending' ELSE crawl_status END AS crawl_status, CASE WHEN coalesce(crawl_status, '') <> 'error' THEN error_message END AS error_message FROM discovered_urls", "discovered_urls")
def reset_pending(spark, sf_dir):
    return mutations.reset_pending(*warehouse(spark, sf_dir, "discovered_urls")).select("id", "crawl_status", "error_message")


_UPDATES = "SELECT id AS url_id, CASE id % 3 WHEN 0 THEN 'crawling' WHEN 1 THEN 'completed' ELSE 'error' END AS status, CASE WHEN id % 6 = 2 THEN 'HTTP 503' WHEN id % 6 = 5 THEN '' END AS error FROM discovered_urls WHERE id % 2 = 0"


@query(
    f"""SELECT d.id, coalesce(u.status, d.crawl_status) AS crawl_status, CAST(d.crawl_attempts + CASE WHEN u.status = 'crawling' THEN 1 ELSE 0 END AS INT) AS crawl_attempts,
    CAST(CASE WHEN u.status IN ('completed', 'error') THEN TIMESTAMP '2024-02-01 00:00:00' ELSE d.last_crawl_at END AS VARCHAR) AS last_crawl_at,
    CASE WHEN u.status = 'error' AND u.error <> '' THEN u.error ELSE d.error_message END AS error_message FROM discovered_urls d LEFT JOIN ({_UPDATES}) u ON d.id = u.url_id""",
    "discovered_urls",
)
def status_transition(spark, sf_dir):
    (urls,) = warehouse(spark, sf_dir, "discovered_urls")
    even = urls.where("id % 2 = 0").select(
        F.col("id").alias("url_id"), F.when(F.col("id") % 3 == 0, "crawling").when(F.col("id") % 3 == 1, "completed").otherwise("error").alias("status"), F.when(F.col("id") % 6 == 2, "HTTP 503").when(F.col("id") % 6 == 5, "").alias("error")
    )
    return _shown(mutations.apply_transitions(urls, even, F.expr(NOW)), "last_crawl_at").select("id", "crawl_status", "crawl_attempts", "last_crawl_at", "error_message")


_BATCH = """SELECT url_id, status, error, seq FROM (
    SELECT id AS url_id, 'crawling' AS status, CAST(NULL AS VARCHAR) AS error, 0 AS seq FROM discovered_urls WHERE id % 2 = 0
    UNION ALL SELECT id, CASE id % 3 WHEN 0 THEN 'completed' WHEN 1 THEN 'error' ELSE 'crawling' END, CASE WHEN id % 6 = 4 THEN 'HTTP 503' END, 1 FROM discovered_urls WHERE id % 2 = 0
    UNION ALL SELECT id, 'pending', NULL, 2 FROM discovered_urls WHERE id % 10 = 0 UNION ALL SELECT -1 - id, 'error', 'gone', 3 FROM discovered_urls WHERE id % 7 = 0)"""


def _batch(urls: DataFrame) -> DataFrame:
    """Several updates of one URL, and some of URLs that are not there."""
    ident, text = F.col("id"), lambda v: F.lit(v).cast("string")
    step = lambda where, key, status, error, seq: urls.where(where).select(key.alias("url_id"), status.alias("status"), error.alias("error"), F.lit(seq).alias("seq"))
    second = F.when(ident % 3 == 0, "completed").when(ident % 3 == 1, "error").otherwise("crawling")
    return (
        step("id % 2 = 0", ident, F.lit("crawling"), text(None), 0).union(step("id % 2 = 0", ident, second, F.when(ident % 6 == 4, "HTTP 503"), 1))
        .union(step("id % 10 = 0", ident, F.lit("pending"), text(None), 2)).union(step("id % 7 = 0", -1 - ident, F.lit("error"), F.lit("gone"), 3))
    )


@query(
    f"""WITH b AS ({_BATCH}), u AS (SELECT url_id, arg_max(status, seq) AS status, arg_max(error, seq) FILTER (status = 'error' AND error <> '') AS error, count(*) FILTER (status = 'crawling') AS tries, bool_or(status IN ('completed', 'error')) AS ended FROM b GROUP BY url_id)
    SELECT d.id, coalesce(u.status, d.crawl_status) AS crawl_status, CAST(d.crawl_attempts + coalesce(u.tries, 0) AS INT) AS crawl_attempts,
    CAST(CASE WHEN u.ended THEN TIMESTAMP '2024-02-01 00:00:00' ELSE d.last_crawl_at END AS VARCHAR) AS last_crawl_at, coalesce(u.error, d.error_message) AS error_message FROM discovered_urls d LEFT JOIN u ON d.id = u.url_id""",
    "discovered_urls",
)
def batch_transitions(spark, sf_dir):
    (urls,) = warehouse(spark, sf_dir, "discovered_urls")
    return _shown(mutations.apply_transitions(urls, _batch(urls), F.expr(NOW)), "last_crawl_at").select("id", "crawl_status", "crawl_attempts", "last_crawl_at", "error_message")


@query(f"SELECT count(*) AS updates, count(*) FILTER (url_id IN (SELECT id FROM discovered_urls)) AS applied FROM ({_BATCH})", "discovered_urls")
def batch_counts(spark, sf_dir):
    (urls,) = warehouse(spark, sf_dir, "discovered_urls")
    return mutations.applied_updates(urls, _batch(urls))


@query(
    """SELECT domain, count(*) AS urls, count(*) FILTER (crawl_status = 'completed') AS completed, CAST(min(created_at) AS VARCHAR) AS first_seen FROM discovered_urls
    WHERE created_at >= TIMESTAMP '2024-01-01 00:01:00' AND created_at < TIMESTAMP '2024-01-01 12:00:00' GROUP BY domain""",
    "discovered_urls",
)
def urls_in_range(spark, sf_dir):
    (urls,) = warehouse(spark, sf_dir, "discovered_urls")
    return _shown(W.urls_in_range(urls, F.expr("timestamp'2024-01-01 00:01:00'"), F.expr("timestamp'2024-01-01 12:00:00'")), "first_seen")


@query("SELECT id, url FROM discovered_urls WHERE crawl_status = 'error' AND coalesce(updated_at, created_at) < TIMESTAMP '2024-02-01 00:00:00' - INTERVAL 25 DAY", "discovered_urls")
def expired_urls(spark, sf_dir):
    (urls,) = warehouse(spark, sf_dir, "discovered_urls")
    return W.expired(urls, F.expr(NOW), 25, F.col("crawl_status") == "error").select("id", "url")


@query(
    """SELECT count(*) AS total, count(*) FILTER (event_type <> 'error') AS succeeded, round(count(*) FILTER (event_type <> 'error') * 100.0 / count(*), 2) AS success_rate,
    round(count(*) / nullif(epoch(max(ts)) - epoch(min(ts)), 0), 6) AS per_second, round(avg(value), 6) AS mean_seconds FROM events"""
)
def load_summary(spark, sf_dir):
    return _rounded(W.load_summary(_read(spark, sf_dir, "events"), F.col("ts"), F.col("event_type") != "error", F.col("value")), "per_second", "mean_seconds")


@query("SELECT event_type, count(*) AS errors, round(count(*) * 100.0 / (SELECT count(*) FROM events WHERE event_type IN ('error', 'view')), 2) AS share FROM events WHERE event_type IN ('error', 'view') GROUP BY event_type")
def errors_by_type(spark, sf_dir):
    return W.errors_by_type(_read(spark, sf_dir, "events").where("event_type in ('error', 'view')"), "event_type")


@query("SELECT url FROM (SELECT 'https://articles.example.com/' || doc_id % 1500 AS url FROM documents UNION SELECT url FROM discovered_urls) WHERE url NOT IN (SELECT url FROM articles)", "articles", "discovered_urls")
def insert_new_urls(spark, sf_dir):
    articles, urls = warehouse(spark, sf_dir, "articles", "discovered_urls")
    rows = _read(spark, sf_dir, "documents").select(F.concat(F.lit("https://articles.example.com/"), (F.col("doc_id") % 1500).cast("string")).alias("url"))
    return mutations.insert_new(articles, rows.union(urls.select("url")), "url")


@query(
    """WITH new AS (SELECT url_id, 'new ' || url_id AS content, created_at + INTERVAL '1' DAY AS created_at FROM raw_pages WHERE url_id % 3 = 0 UNION ALL SELECT url_id + 500000, 'added', created_at FROM raw_pages WHERE url_id % 10 = 0)
    SELECT coalesce(r.url_id, n.url_id) AS url_id, md5(coalesce(n.content, r.content)) AS content_hash, CAST(least(r.created_at, n.created_at) AS VARCHAR) AS created_at, CAST(greatest(r.created_at, n.created_at) AS VARCHAR) AS updated_at
    FROM raw_pages r FULL JOIN new n ON r.url_id = n.url_id""",
    "raw_pages",
)
def upsert_raw_pages(spark, sf_dir):
    (pages,) = warehouse(spark, sf_dir, "raw_pages")
    changed = pages.where("url_id % 3 = 0").select("url_id", F.concat(F.lit("new "), F.col("url_id").cast("string")).alias("content"), F.expr("created_at + INTERVAL '1' DAY").alias("created_at"))
    added = pages.where("url_id % 10 = 0").select(F.col("url_id") + 500000, F.lit("added"), "created_at")
    out = mutations.upsert_raw_pages(pages, changed.union(added))
    return _shown(out.select("url_id", F.md5("content").alias("content_hash"), "created_at", "updated_at"), "created_at", "updated_at")


@query("SELECT url, url IN (SELECT url FROM discovered_urls UNION ALL SELECT url FROM sitemaps) AS known FROM (SELECT url FROM pages UNION SELECT 'https://b.example/sitemap.xml' UNION SELECT url || '?other' FROM pages)", "discovered_urls", "sitemaps")
def url_exists(spark, sf_dir):
    urls, sitemaps = warehouse(spark, sf_dir, "discovered_urls", "sitemaps")
    pages = _read(spark, sf_dir, "pages").select("url")
    wanted = pages.union(pages.select(F.concat("url", F.lit("?other")))).union(sitemaps.where("id = 2").select("url")).distinct()
    return W.url_exists(urls, sitemaps, wanted)


@query("SELECT id, url, title FROM articles WHERE url = 'https://articles.example.com/42' LIMIT 1", "articles")
def article_by_url(spark, sf_dir):
    return W.article_by_url(warehouse(spark, sf_dir, "articles")[0].select("id", "url", "title"), "https://articles.example.com/42")


@query("SELECT id, article_id FROM article_chunks WHERE article_id % 5 <> 0", "article_chunks")
def cascade_delete(spark, sf_dir):
    articles, chunks = warehouse(spark, sf_dir, "articles", "article_chunks")
    victims = articles.where("id % 5 = 0").select("id").union(chunks.where("article_id >= 1000000000 and article_id % 5 = 0").select("article_id"))
    return mutations.delete_articles(articles, chunks.select("id", "article_id"), victims)[1]


@query(
    """SELECT id, violation FROM (SELECT id, unnest(list_filter([CASE WHEN priority > 0.9 THEN 'priority is not within 0 and 1' END, CASE WHEN crawl_status = 'crawling' THEN 'crawl_status is unknown' END,
    CASE WHEN id % 9 = 0 THEN 'url is empty' END, CASE WHEN id % 9 = 1 THEN 'url is not http(s)' END], lambda x: x IS NOT NULL)) AS violation FROM discovered_urls)""",
    "discovered_urls",
)
def model_violations(spark, sf_dir):
    (urls,) = warehouse(spark, sf_dir, "discovered_urls")
    odd = urls.withColumns({"priority": F.when(F.col("priority") > 0.9, F.col("priority") + 1).otherwise(F.col("priority")), "crawl_status": F.when(F.col("crawl_status") == "crawling", "lost").otherwise(F.col("crawl_status")), "url": F.when(F.col("id") % 9 == 0, " ").when(F.col("id") % 9 == 1, "ftp://x").otherwise(F.col("url"))})
    return violations(odd, "discovered_urls")


# Vectors and retrieval

_SCORED = f"SELECT c.id AS chunk_id, c.article_id, a.url AS article_url, a.title AS article_title, c.content AS chunk_content, list_cosine_similarity(c.embedding::DOUBLE[], {_VECTOR_SQL}) AS s FROM article_chunks c JOIN articles a ON c.article_id = a.id WHERE c.embedding IS NOT NULL"


def _search(name: str, limit: int, threshold: float | None):
    where = f"WHERE s >= {threshold}" if threshold is not None else ""

    @query(f"SELECT chunk_id, article_id, article_url, article_title, chunk_content, round(s, 6) AS similarity_score FROM ({_SCORED}) {where} ORDER BY s DESC, chunk_id LIMIT {limit}", "articles", "article_chunks", name=name)
    def search(spark, sf_dir):
        articles, chunks = warehouse(spark, sf_dir, "articles", "article_chunks")
        return _rounded(W.vector_search(chunks, articles, VECTOR, limit, threshold), "similarity_score")


_search("vector_topk", 5, None)
_search("vector_topk_threshold", 10, 0.1)
_search("vector_search_cli", 5, 0.3)


@query(f"SELECT 'Context:' || chr(10) || string_agg(chunk_content, chr(10) ORDER BY s DESC, chunk_id) || chr(10) || chr(10) || 'Question: what?' AS prompt, count(*) AS n_sources FROM (SELECT * FROM ({_SCORED}) ORDER BY s DESC, chunk_id LIMIT 5)", "articles", "article_chunks")
def rag_context(spark, sf_dir):
    articles, chunks = warehouse(spark, sf_dir, "articles", "article_chunks")
    return W.rag_prompt(W.vector_search(chunks, articles, VECTOR, 5, None), "what?").select("prompt", F.size("sources").cast("long").alias("n_sources"))


@query("SELECT a.vec_id, b.vec_id AS next_id, round(list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]), 6) AS similarity, round(1 - list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]), 6) AS distance, len(a.embedding) AS dimension FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1")
def cosine_neighbours(spark, sf_dir):
    e = _read(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    after = e.select(F.col("vec_id").alias("next_id"), F.col("embedding").alias("other"))
    likeness = cosine(F.col("embedding"), F.col("other"))
    return e.join(after, F.col("next_id") == F.col("vec_id") + 1).select("vec_id", "next_id", F.round(likeness, 6).alias("similarity"), F.round(1 - likeness, 6).alias("distance"), F.size("embedding").cast("long").alias("dimension"))


@query()
def lsh_search(spark, sf_dir):
    e = _read(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), "embedding")
    return retrieval.lsh_search(retrieval.lsh_index(e, bits=4, tables=24), e.where("id % 100 = 0"), 10, bits=4, tables=24)


@query()
def ivf_search(spark, sf_dir):
    e = _read(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), "embedding")
    ivf.build(e, path := fresh_path(spark), 64)
    return _rounded(ivf.Index(spark, path).search(e.where("id % 100 = 0")), "similarity")


def _embedded(chunks: DataFrame) -> DataFrame:
    """Chunks with the size of their vectors, which no SQL makes, in place of these."""
    return chunks.select("id", "article_id", "content", "content_hash", "chunk_index", "chunk_size", F.size("embedding").alias("dimensions"))


@query(chunk_sql.EMBEDDED_SQL)
def chunk_and_embed(spark, sf_dir):
    return _embedded(retrieval.chunk_and_embed(warehouse(spark, sf_dir, "articles")[0], "sentence", chunkers.Config(language="en"), 64))


@query(chunk_sql.NEW_SQL)
def process_new_articles(spark, sf_dir):
    articles, chunks = warehouse(spark, sf_dir, "articles", "article_chunks")
    return _embedded(retrieval.process_new(articles.select("id", "content"), chunks, None, kind="sliding_window", dimensions=64))


def _called(name: str, call: str, *times: str, rounded: tuple[str, ...] = (), sql: str = "{}"):
    """The query `name`, as a call of a table function in SQL text."""

    @query(sql.format(ORACLE_SQL[name]), name=f"sql_{name}")
    def run(spark, sf_dir):
        names = (*_THREE, "sitemaps")
        table_functions.register(spark, "BIGINT", **dict(zip(names, warehouse(spark, sf_dir, *names), strict=True)))
        return _rounded(_shown(spark.sql(f"SELECT * FROM {call}"), *times), *rounded)


_called("db_stats", "get_db_stats()", sql="SELECT *, NULL::VARCHAR AS table_size FROM ({})")  # the fixtures are plans, without files of their own
_called("domain_stats", "get_domain_stats()")
_called("crawl_progress", "get_crawl_progress()")
_called("data_integrity", "check_data_integrity()")
_called("cleanup_duplicate_articles", "cleanup_duplicate_articles()")
_called("recent_errors", "get_recent_errors(50)", "error_time")
_called("vector_topk_threshold", f"search_similar_content(array({', '.join(f'{x}D' for x in VECTOR)}), 0.1D, 10)", rounded=("similarity_score",))

# Text

_SENTENCES = r"list_filter(list_transform(regexp_split_to_array(coalesce(text, ''), '[.!?]+'), lambda s: trim(regexp_replace(s, '\s+', ' ', 'g'))), lambda s: s <> '')"
_WORDS = r"list_filter(regexp_split_to_array(coalesce(text, ''), '\s+'), lambda w: w <> '')"


@query(rf"SELECT doc_id, len(string_split(coalesce(text, ''), ' ')) AS pieces, len({_WORDS}) AS words, length(coalesce(text, '')) AS characters, CASE WHEN text <> '' THEN md5(text) END AS content_hash FROM documents")
def word_count(spark, sf_dir):
    t = F.coalesce("text", F.lit(""))
    return _read(spark, sf_dir, "documents").select("doc_id", X.word_count_sql(t).cast("long").alias("pieces"), X.word_count_ws(t).cast("long").alias("words"), F.length(t).cast("long").alias("characters"), X.content_hash(F.col("text")).alias("content_hash"))


@query(f"SELECT doc_id, unnest({_SENTENCES}) AS sentence FROM documents")
def sentence_split(spark, sf_dir):
    return _read(spark, sf_dir, "documents").select("doc_id", F.explode(X.sentences(F.coalesce("text", F.lit("")), "en")).alias("sentence"))


@query(
    rf"""WITH w AS (SELECT doc_id, {_WORDS} AS w FROM documents),
    spans AS (SELECT doc_id, w, unnest(CASE WHEN len(w) <= 100 THEN [0] ELSE range(0, len(w) - 99, 50) END) AS word_start, false AS tail FROM w UNION ALL SELECT doc_id, w, len(w) - 100, true FROM w WHERE len(w) > 100 AND len(w) % 50 <> 0),
    shown AS (SELECT doc_id, word_start, tail, array_to_string(list_slice(w, word_start + 1, word_start + 100), ' ') AS content, array_to_string(list_slice(w, ((len(w) - 100) // 50) * 50 + 1, ((len(w) - 100) // 50) * 50 + 100), ' ') AS before FROM spans)
    SELECT doc_id, word_start, md5(content) AS content_hash FROM shown WHERE NOT (tail AND content = before)"""
)
def sliding_words(spark, sf_dir):
    windows = chunkers.word_windows(X.words(F.coalesce("text", F.lit(""))), 100, 50)
    return _read(spark, sf_dir, "documents").select("doc_id", F.explode(windows).alias("c")).select("doc_id", F.col("c.word_start").cast("long").alias("word_start"), F.md5("c.content").alias("content_hash"))


@query(
    f"""WITH s AS (SELECT doc_id, {_SENTENCES} AS s FROM documents), spans AS (SELECT doc_id, s, unnest(CASE WHEN len(s) <= 10 THEN [0] ELSE range(0, len(s), 9) END) AS i FROM s)
    SELECT doc_id, i AS sentence_start, md5(array_to_string(list_slice(s, i + 1, i + 10), ' ')) AS content_hash FROM spans"""
)
def sentence_windows(spark, sf_dir):
    windows = chunkers.sentence_windows(X.sentences(F.coalesce("text", F.lit("")), "en"), 10, 1)
    return _read(spark, sf_dir, "documents").select("doc_id", F.explode(windows).alias("c")).select("doc_id", F.col("c.sentence_start").cast("long").alias("sentence_start"), F.md5("c.content").alias("content_hash"))


@query(
    r"""SELECT page_id, trim(regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1)) AS title, regexp_extract(url, '^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)', 1) AS domain,
    CASE WHEN regexp_extract(url, '^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*([^?#]*)', 1) = '' THEN '/' ELSE regexp_extract(url, '^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*([^?#]*)', 1) END AS path FROM pages"""
)
def page_fields(spark, sf_dir):
    return _read(spark, sf_dir, "pages").select("page_id", X.title(F.col("html")).alias("title"), X.domain(F.col("url")).alias("domain"), X.url_path(F.col("url")).alias("path"))


@query(
    rf"""SELECT doc_id, characters, words, sentences, CASE WHEN sentences > 0 THEN round(words / sentences, 6) END AS words_per_sentence, CASE WHEN words = 0 THEN 0 WHEN words <= 100 THEN 1 ELSE (words - 100) // 50 + 1 END AS full_windows
    FROM (SELECT doc_id, length(coalesce(text, '')) AS characters, len({_WORDS}) AS words, len({_SENTENCES}) AS sentences FROM documents)"""
)
def chunk_report(spark, sf_dir):
    return _rounded(chunkers.chunk_report(_read(spark, sf_dir, "documents"), chunkers.Config(language="en"), "doc_id", "text").drop("paragraphs"), "words_per_sentence").withColumns({c: F.col(c).cast("long") for c in ("characters", "words", "sentences", "full_windows")})


def _chunker(name: str, kind: str, config: chunkers.Config, sql: str | None = None, columns: dict[str, str] | None = None, text=lambda t: t, **extra):
    """Chunks of all documents, with metadata in columns of their own where these are named."""

    @query(sql, name=name)
    def run(spark, sf_dir):
        docs = _read(spark, sf_dir, "documents").select("doc_id", text(F.col("text")).alias("text"))
        chunks = chunkers.chunk_documents(docs, kind, config, "doc_id", "text", **extra)
        if not columns:
            return chunks.withColumn("metadata", F.to_json("metadata"))
        kinds = {"VARCHAR": "string", "BIGINT": "long", "BOOLEAN": "boolean", "DOUBLE": "double"}
        return chunks.select("doc_id", "chunk_index", "content", "start_pos", "end_pos", *(F.col("metadata")[k].cast(kinds[t]).alias(k) for k, t in columns.items()))


def _with_paragraphs(text):
    pattern, blank = chunk_sql.PARAGRAPH_START
    return F.regexp_replace(text, pattern, f"$1{blank}$2")


_chunker("sliding_sentences", "sliding_window", chunkers.Config(), chunk_sql.SLIDING_SQL, chunk_sql.SLIDING_COLUMNS)
_chunker("sentence_chunks", "sentence", chunkers.Config(language="en", paragraphs=False), chunk_sql.SENTENCE_SQL, chunk_sql.SENTENCE_COLUMNS)
_chunker("paragraph_chunks", "sentence", chunkers.Config(language="en"), chunk_sql.PARAGRAPH_SQL, chunk_sql.PARAGRAPH_COLUMNS, _with_paragraphs)
_chunker("semantic_chunks", "semantic", chunkers.Config(language="en", similarity=0.2), None, chunk_sql.SEMANTIC_COLUMNS)  # SEMANTIC_SQL takes minutes on whole tables; tests use it
_chunker("semantic_vector_chunks", "semantic", chunkers.Config(language="en", similarity=0.2), None, chunk_sql.SEMANTIC_COLUMNS, load=lambda: lambda texts: hash_embed(texts, 256))

@query("SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS document_index, 'doc_' || (row_number() OVER (ORDER BY doc_id) - 1) AS document_id FROM documents")
def numbered_documents(spark, sf_dir):
    return chunkers.numbered(_read(spark, sf_dir, "documents").select("doc_id"), "doc_id")


# Frontier

#: A robots file of each host, with rules for the paths of its own pages: directories of odd pages are closed but
#: for pages of numbers that end in 7; every third host wants a delay of 1 to 40 seconds.
_DIRECTORY = r"^(.*/)[^/]*$"


def _robots_files(spark, sf_dir):
    pages = _read(spark, sf_dir, "pages").select("page_id", X.domain(F.col("url")).alias("domain"), X.url_path(F.col("url")).alias("path"))
    closed = F.when(F.col("page_id") % 2 == 1, F.concat(F.lit("Disallow: "), F.regexp_extract("path", _DIRECTORY, 1)))
    opened = F.when(F.col("page_id") % 10 == 7, F.concat(F.lit("allow : "), "path"))
    number = F.pmod(F.min("page_id"), F.lit(40))
    rules = F.concat(F.array(F.lit("User-agent: other"), F.lit("Disallow: /"), F.lit("User-agent: *"), F.lit("Disallow:"), F.lit("Crawl-delay: soon")), F.array_distinct(F.concat(F.collect_list(closed), F.collect_list(opened))))
    delay = F.when(number % 3 == 0, F.concat(F.lit("Crawl-delay: "), (number + 1).cast("string"))).otherwise("# none")
    lines = F.concat(rules, F.array(delay, F.concat(F.lit("Sitemap: https://"), "domain", F.lit("/sitemap.xml"))))
    return pages.groupBy("domain").agg(F.array_join(lines, "\n").alias("text"))


_PATHS = r"""p AS (SELECT page_id, url, regexp_extract(url, '^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)', 1) AS domain, regexp_extract(url, '^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*([^?#]*)', 1) AS raw FROM pages),
    u AS (SELECT page_id, url, domain, CASE WHEN raw = '' THEN '/' ELSE raw END AS path FROM p)"""


@query(
    f"""WITH {_PATHS}, r AS (SELECT DISTINCT domain, trim(regexp_extract(path, '^(.*/)[^/]*$', 1)) AS rule, false AS allow FROM u WHERE page_id % 2 = 1 UNION SELECT DISTINCT domain, trim(path), true FROM u WHERE page_id % 10 = 7),
    best AS (SELECT page_id, max_by(allow, len(rule) * 2 + allow::INT) AS allow FROM u JOIN r USING (domain) WHERE rule <> '' AND starts_with(path, rule) GROUP BY page_id)
    SELECT u.page_id, u.url, coalesce(allow, true) AS allowed FROM u LEFT JOIN best USING (page_id)"""
)
def robots_allowed(spark, sf_dir):
    return frontier.robots_allowed(_read(spark, sf_dir, "pages").select("page_id", "url"), frontier.robots_rules(_robots_files(spark, sf_dir)))


@query(
    f"""WITH {_PATHS}, d AS (SELECT domain, min(page_id) % 40 AS k FROM u GROUP BY domain), w AS (SELECT domain, CASE WHEN k % 3 = 0 THEN k + 1 ELSE 0 END AS wanted FROM d)
    SELECT domain, wanted <= 30 AS accepted, greatest(wanted, 0.5)::DOUBLE AS min_delay, 1::BIGINT AS n_sitemaps FROM w"""
)
def robots_delays(spark, sf_dir):
    summary = frontier.robots_summary(_robots_files(spark, sf_dir))
    return frontier.delay_gate(summary).join(summary.select("domain", F.size("sitemaps").cast("long").alias("n_sitemaps")), "domain")


@query(
    """WITH RECURSIVE links AS (SELECT 'https://s.example/' || page_id AS source, 'https://s.example/' || (page_id * 2 + k) % (SELECT count(*) FROM pages) AS loc FROM pages, (VALUES (1), (2)) AS t(k)),
    walk(url, depth) AS (SELECT 'https://s.example/0', 0 UNION SELECT loc, depth + 1 FROM walk JOIN links ON url = source WHERE depth < 40) SELECT url, CAST(min(depth) AS INT) AS depth FROM walk GROUP BY url"""
)
def sitemap_closure(spark, sf_dir):
    pages = _read(spark, sf_dir, "pages")
    total = pages.agg(F.count(F.lit(1)).alias("n"))
    name = lambda c: F.concat(F.lit("https://s.example/"), c.cast("string"))
    links = pages.crossJoin(F.broadcast(total)).select(name(F.col("page_id")).alias("source"), F.explode(F.array(*(name((F.col("page_id") * 2 + k) % F.col("n")) for k in (1, 2)))).alias("loc"))  # total is one row
    return frontier.sitemap_closure(links, spark.sql("SELECT 'https://s.example/0' AS url"))


@query(
    """SELECT 'https://m.example/' || page_id // 100 AS source, url AS loc, CASE WHEN page_id % 3 = 0 THEN 0.5::DOUBLE END AS priority, (page_id // 100) % 4 = 3 OR lower(url) LIKE '%.xml' OR lower(regexp_extract(url, '^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*([^?#]*)', 1)) LIKE '%sitemap%' AS nested FROM pages
    UNION ALL SELECT 'https://m.example/' || page_id // 100, 'https://m.example/part-' || page_id || '.XML', NULL, true FROM pages WHERE page_id % 7 = 0"""
)
def sitemap_entries(spark, sf_dir):
    """Files of a hundred pages each, every fourth an index; some list a file of their own beside the pages."""
    pages = _read(spark, sf_dir, "pages").select("page_id", F.floor(F.col("page_id") / 100).alias("file"), F.regexp_replace(F.regexp_replace("url", "&", "&amp;"), "<", "&lt;").alias("u"))
    index = F.col("file") % 4 == 3
    tag = F.when(index, "sitemap").otherwise("url")
    entry = lambda loc, more: F.concat(F.lit("<"), tag, F.lit("><loc> "), loc, F.lit(" </loc>"), more, F.lit("</"), tag, F.lit(">"))
    own = F.when(F.col("page_id") % 7 == 0, entry(F.concat(F.lit("https://m.example/part-"), F.col("page_id").cast("string"), F.lit(".XML")), F.lit(""))).otherwise("")
    item = F.concat(entry(F.col("u"), F.when(F.col("page_id") % 3 == 0, "<priority>0.5</priority>").otherwise("")), own)
    root = F.when(F.first("file") % 4 == 3, "sitemapindex").otherwise("urlset")
    xml = F.concat(F.lit("<"), root, F.lit(' xmlns="http://www.sitemaps.org/schemas/sitemap/0.9">'), F.array_join(F.collect_list(item), ""), F.lit("</"), root, F.lit(">"))
    files = pages.groupBy("file").agg(xml.alias("xml")).select(F.concat(F.lit("https://m.example/"), F.col("file").cast("string")).alias("url"), "xml")
    return frontier.sitemap_entries(files).select("source", "loc", "priority", "nested")


# Control and events


@query("SELECT event_id, CAST(event_id % 8 AS INT) AS attempt, greatest(0.1, least(pow(2, event_id % 8), 60) * CASE event_id % 3 WHEN 0 THEN 2.0 WHEN 1 THEN 1.5 ELSE 1.0 END)::DOUBLE AS delay FROM events")
def retry_schedule(spark, sf_dir):
    e = _read(spark, sf_dir, "events").select("event_id", (F.col("event_id") % 8).cast("int").alias("attempt"), F.when(F.col("event_id") % 3 == 0, "rate_limited").when(F.col("event_id") % 3 == 1, "server_error").alias("reason"))
    return control.retry_schedule(e).drop("reason")


@query(
    "SELECT user_id AS host, count(*) AS request_count, count(CASE WHEN event_type = 'error' THEN 1 END) AS failure_count, round(min(epoch(TIMESTAMP '2024-02-01 00:00:00') - epoch(ts)), 3) AS last_request_ago, count(CASE WHEN epoch(TIMESTAMP '2024-02-01 00:00:00') - epoch(ts) < 86400 THEN 1 END) / 86400.0e0 AS current_rate FROM events GROUP BY user_id"
)
def host_stats(spark, sf_dir):
    log = _read(spark, sf_dir, "events").select(F.col("user_id").alias("host"), F.col("ts").cast("timestamp").alias("ts"), (F.col("event_type") != "error").alias("ok"))
    return control.host_stats(log, F.expr(NOW), 86_400).withColumn("last_request_ago", F.round("last_request_ago", 3))


@query("SELECT event_type, count(*) AS requests, count(CASE WHEN value > 10 THEN 1 END) AS successes, round(count(CASE WHEN value > 10 THEN 1 END) * 100.0e0 / count(*), 2) AS success_rate, round(avg(value), 6) AS avg_duration FROM events GROUP BY event_type")
def request_stats(spark, sf_dir):
    return _rounded(W.request_stats(_read(spark, sf_dir, "events"), "event_type", F.coalesce(F.col("value") > 10, F.lit(False)), F.col("value")), "avg_duration")


@query("SELECT CAST(user_id AS VARCHAR) AS func, count(*) AS total_attempts, count(CASE WHEN event_type = 'click' THEN 1 END) AS total_retries, count(CASE WHEN event_type = 'purchase' THEN 1 END) AS success_count, count(CASE WHEN event_type = 'error' THEN 1 END) AS failure_count FROM events GROUP BY user_id")
def retry_stats(spark, sf_dir):
    outcome = F.when(F.col("event_type") == "click", "retry").when(F.col("event_type") == "purchase", "success").when(F.col("event_type") == "error", "failure")
    return control.retry_stats(_read(spark, sf_dir, "events").select(F.col("user_id").cast("string").alias("func"), outcome.alias("outcome")))


@query("SELECT CAST(time_bucket(INTERVAL '1 hour', ts) AS VARCHAR) AS start, event_type AS kind, count(*) AS n, round(avg((value > 10)::INT::DOUBLE), 6) AS success_share FROM events GROUP BY 1, 2")
def event_rates(spark, sf_dir):
    log = _read(spark, sf_dir, "events").select(F.col("ts").cast("timestamp").alias("at"), F.col("event_type").alias("kind"), (F.col("value") > 10).alias("ok"))
    return _rounded(_shown(queue.event_rates(log), "start"), "success_share")


@query(chunk_sql.TOKEN_SQL)
def token_bucket(spark, sf_dir):
    log = _read(spark, sf_dir, "events").select(F.col("user_id").cast("string").alias("host"), F.col("ts").cast("timestamp").alias("ts"), F.col("event_id").alias("request_id"))
    return _rounded(control.limit_requests(log), "wait")


@query(
    """WITH RECURSIVE e AS MATERIALIZED (SELECT user_id AS host, event_id AS request_id, epoch_us(ts) AS asked, (1 + user_id % 5) * 60000000 AS gap, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS i FROM events),
    walk AS (SELECT host, request_id, i, asked, asked AS release FROM e WHERE i = 1 UNION ALL SELECT e.host, e.request_id, e.i, e.asked, greatest(e.asked, w.release + e.gap) FROM walk w JOIN e ON e.host = w.host AND e.i = w.i + 1)
    SELECT host, request_id, asked, release FROM walk"""
)
def release_times(spark, sf_dir):
    log = _read(spark, sf_dir, "events").select(F.col("user_id").alias("host"), F.col("event_id").alias("request_id"), F.unix_micros(F.col("ts").cast("timestamp")).alias("asked"))
    return control.release_times(log, (1 + F.col("host") % 5) * 60_000_000, at="asked")


@query(f"""SELECT doc_id, len({_SENTENCES})::INT AS sentences, len(list_filter(string_split(coalesce(text, ''), chr(10) || chr(10)), lambda p: p ~ '(?s).*\\S.*'))::INT AS paragraphs,
    round(coalesce(list_avg(list_transform({_SENTENCES}, lambda s: len(string_split(s, ' ')))), 0), 2) AS mean_sentence_words, CASE WHEN len({_SENTENCES}) > 0 THEN greatest(1, len({_SENTENCES}) // 10) ELSE 0 END::INT AS estimated_chunks,
    10 AS max_sentences, 2 AS min_sentences, 1 AS sentence_overlap, 'en' AS language FROM documents""")
def sentence_report(spark, sf_dir):
    return chunkers.sentence_report(_read(spark, sf_dir, "documents"), chunkers.Config(language="en"), "doc_id", "text")


@query(f"""SELECT doc_id, len({_SENTENCES})::INT AS sentences, 0.7::DOUBLE AS similarity_threshold, false AS uses_encoder, 'words' AS compared_by, 3 AS min_similarity_sentences,
    CASE WHEN len({_SENTENCES}) > 0 THEN greatest(1, len({_SENTENCES}) // 3)::INT END AS estimated_groups FROM documents""")
def semantic_report(spark, sf_dir):
    return chunkers.semantic_report(_read(spark, sf_dir, "documents"), chunkers.Config(language="en"), "doc_id", "text")


@query(
    """SELECT to_json({id: id, url: url, crawl_status: crawl_status, crawl_attempts: crawl_attempts, last_crawl_at: strftime(last_crawl_at, '%Y-%m-%dT%H:%M:%S+00:00'), error_message: error_message, created_at: strftime(created_at, '%Y-%m-%dT%H:%M:%S+00:00')})::VARCHAR AS record FROM discovered_urls""",
    "discovered_urls",
)
def serialized_urls(spark, sf_dir):
    (urls,) = warehouse(spark, sf_dir, "discovered_urls")
    return serialized(urls.select("id", "url", "crawl_status", "crawl_attempts", "last_crawl_at", "error_message", "created_at"))


@query(
    """SELECT 'articles' AS table_name, count(*) AS rows, count(CASE WHEN content IS NULL OR trim(content) = '' OR NOT starts_with(url, 'http') THEN 1 END) AS broken, count(CASE WHEN content IS NULL OR trim(content) = '' OR NOT starts_with(url, 'http') THEN 1 END) = 0 AS valid FROM articles
    UNION ALL SELECT 'discovered_urls', count(*), count(CASE WHEN NOT regexp_matches(url, '^https?://') OR priority > 1 THEN 1 END), count(CASE WHEN NOT regexp_matches(url, '^https?://') OR priority > 1 THEN 1 END) = 0 FROM discovered_urls""",
    "discovered_urls", "articles",
)
def model_validity(spark, sf_dir):
    urls, articles = warehouse(spark, sf_dir, "discovered_urls", "articles")
    return validity(discovered_url=urls, article=articles)


_SIZED = "length(html) * page_id"


@query(
    f"""SELECT page_id, CASE WHEN regexp_matches(d, '^[a-z_][a-z0-9_]*$') THEN d ELSE '"' || replace(d, '"', '""') || '"' END AS quoted,
    CASE WHEN n < 10240 THEN n || ' bytes' WHEN n < 10485760 THEN round(n / 1024)::BIGINT || ' kB' WHEN n < 10737418240 THEN round(n / 1048576)::BIGINT || ' MB' ELSE round(n / 1073741824)::BIGINT || ' GB' END AS size
    FROM (SELECT page_id, {_SIZED} AS n, regexp_extract(url, '^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)', 1) AS d FROM pages)"""
)
def catalog_scalars(spark, sf_dir):
    pages = _read(spark, sf_dir, "pages")
    return pages.select("page_id", X.quote_ident(X.domain(F.col("url"))).alias("quoted"), X.pretty_size((F.length("html") * F.col("page_id")).cast("long")).alias("size"))


def _chunked(name: str, first: str, call: str):
    """The query `name`, as a call of the table function chunk over all documents."""

    @query(ORACLE_SQL[name], name=f"sql_{name}")
    def run(spark, sf_dir):
        table_functions.chunk_function.register(spark)
        return spark.sql(f"SELECT doc_id, CAST(first AS BIGINT) AS {first}, md5(content) AS content_hash FROM chunk(TABLE(SELECT doc_id, text FROM {{docs}}), {call})", docs=_read(spark, sf_dir, "documents"))


_chunked("sliding_words", "word_start", "'words', 100, 50")
_chunked("sentence_windows", "sentence_start", "'sentences', 10, 9")


@query()
def host_limits(spark, sf_dir):
    """Rates and penalties of every host after its log of responses."""
    log = _read(spark, sf_dir, "events").select(F.col("user_id").cast("string").alias("host"), F.col("ts").cast("timestamp").alias("at"), (F.coalesce("value", F.lit(0.0)) / 10).alias("seconds"), (F.col("event_type") != "error").alias("ok"))
    return adaptive.limits_of(log)
