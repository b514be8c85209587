"""The warehouse's table functions for SQL text: SELECT * FROM get_domain_stats().

`chunk` takes any table (see `chunk_function`).  cleanup_duplicate_articles tells what a cleanup
deletes; `warehouse.cleanup_duplicates` also gives what stays.

The others are functions of the session over the views articles, article_chunks,
discovered_urls and sitemaps (`Store.views`, or any DataFrames); a call is
inlined into its query, so filters and pruning reach the scans."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomline.functions.text import pretty_size
from loomline.operators.warehouse import CHECKS
from loomline.plans import chunk_function

_SHARE = "CAST(if(count(*) > 0, round(count_if(crawl_status = 'completed') * 100.0D / if(count(*) > 0, count(*), 1), 2), 0) AS DOUBLE)"

#: Articles and chunks are counted before they are joined; a URL without article or chunk still is one row.
_DOMAINS = """
    WITH c AS (SELECT article_id, count(id) AS chunks FROM article_chunks GROUP BY article_id),
    a AS (SELECT crawled_from_url_id AS url_id, count(*) AS articles, sum(coalesce(chunks, 0)) AS chunks, sum(greatest(coalesce(chunks, 0), 1)) AS rows
          FROM articles LEFT JOIN c ON id = article_id GROUP BY crawled_from_url_id),
    u AS (SELECT domain, crawl_status, coalesce(rows, 1) AS n, coalesce(rows, 0) AS articles, coalesce(chunks, 0) AS chunks FROM discovered_urls LEFT JOIN a ON id = url_id)
    SELECT domain, sum(n), sum(if(crawl_status = 'completed', n, 0)), sum(if(crawl_status = 'pending', n, 0)), sum(if(crawl_status = 'error', n, 0)), sum(articles), sum(chunks),
      round(sum(if(crawl_status = 'completed', n, 0)) * 100.0D / sum(n), 2) FROM u GROUP BY domain"""

_ORPHANS = {
    "orphaned_chunks": "article_chunks c LEFT ANTI JOIN articles a ON c.article_id = a.id",
    "articles_without_chunks": "articles a LEFT ANTI JOIN article_chunks c ON a.id = c.article_id",
    "duplicate_urls": "(SELECT url FROM discovered_urls GROUP BY url HAVING count(*) > 1)",
    "chunks_without_embeddings": "article_chunks WHERE embedding IS NULL",
}
_CHECKED = " UNION ALL ".join(f"SELECT '{name}', if(count(*) = 0, 'OK', '{CHECKS[name][0]}'), count(*), '{CHECKS[name][1]}' FROM {rows}" for name, rows in _ORPHANS.items())
#: Exploded from an array of one where it is used: so it is computed once a row, not in the filter and again in the projection.
_LIKENESS = (
    "aggregate(zip_with(c.embedding, query, (x, y) -> CAST(x AS DOUBLE) * y), 0.0D, (s, x) -> s + x) / "
    "sqrt(aggregate(c.embedding, 0.0D, (s, x) -> s + CAST(x AS DOUBLE) * x) * aggregate(query, 0.0D, (s, x) -> s + x * x))"
)

#: Name: (parameters, columns, body).
FUNCTIONS: dict[str, tuple[str, str, str]] = {
    "get_db_stats": ("", "table_name STRING, row_count BIGINT, table_size STRING", " UNION ALL ".join(f"SELECT '{t}', count(*), {{{t}}} FROM {t}" for t in ("article_chunks", "articles", "discovered_urls", "sitemaps"))),
    "get_domain_stats": ("", "domain STRING, total_urls BIGINT, crawled_urls BIGINT, pending_urls BIGINT, error_urls BIGINT, total_articles BIGINT, total_chunks BIGINT, crawl_success_rate DOUBLE", _DOMAINS),
    "get_crawl_progress": (
        "", "total_discovered BIGINT, total_crawled BIGINT, total_pending BIGINT, total_errors BIGINT, total_articles BIGINT, total_chunks BIGINT, avg_chunks_per_article DOUBLE, progress_percentage DOUBLE",
        f"""SELECT d.*, a.n, c.n, coalesce(round(CAST(c.n AS DOUBLE) / nullif(a.n, 0), 2), 0.0D), share
        FROM (SELECT count(*), count_if(crawl_status = 'completed'), count_if(crawl_status = 'pending'), count_if(crawl_status = 'error') FROM discovered_urls) d,
        (SELECT count(*) AS n FROM articles) a, (SELECT count(*) AS n FROM article_chunks) c, (SELECT {_SHARE} AS share FROM discovered_urls)""",
    ),
    "search_similar_content": (
        "query ARRAY<DOUBLE>, threshold DOUBLE DEFAULT 0.7D, most INT DEFAULT 10", "chunk_id BIGINT, article_id BIGINT, article_url STRING, article_title STRING, chunk_content STRING, similarity_score DOUBLE",
        f"""WITH scored AS (SELECT c.id, c.article_id, explode(array({_LIKENESS})) AS score FROM article_chunks c LEFT SEMI JOIN articles a ON c.article_id = a.id WHERE size(c.embedding) = size(query)),
        best AS (SELECT * FROM (SELECT *, row_number() OVER (ORDER BY score DESC, id) AS place FROM scored WHERE score >= threshold) WHERE place <= most)
        SELECT b.id, b.article_id, a.url, a.title, c.content, b.score FROM best b JOIN article_chunks c ON b.id = c.id JOIN articles a ON b.article_id = a.id""",
    ),
    "get_recent_errors": (
        "most INT DEFAULT 50", "error_type STRING, url STRING, error_message STRING, error_time TIMESTAMP, crawl_attempts INT",
        """SELECT error_type, url, error_message, at, tries FROM (SELECT *, row_number() OVER (ORDER BY at DESC, url, error_type) AS place FROM (
          SELECT 'url_crawl' AS error_type, url, error_message, updated_at AS at, crawl_attempts AS tries FROM discovered_urls WHERE crawl_status = 'error' AND error_message IS NOT NULL
          UNION ALL SELECT 'sitemap_parse', url, error_message, updated_at, 0 FROM sitemaps WHERE status = 'error' AND error_message IS NOT NULL)) WHERE place <= most""",
    ),
    "cleanup_duplicate_articles": (
        "", "deleted_articles BIGINT, deleted_chunks BIGINT",
        """WITH k AS (SELECT content_hash, min(struct(created_at, id)).id AS kept FROM articles WHERE content_hash <> '' GROUP BY content_hash HAVING count(*) > 1),
        gone AS (SELECT id FROM articles JOIN k USING (content_hash) WHERE id <> kept)
        SELECT (SELECT count(*) FROM gone), (SELECT count(*) FROM article_chunks LEFT SEMI JOIN gone ON article_id = gone.id)""",
    ),
    "check_data_integrity": ("", "check_name STRING, status STRING, issue_count BIGINT, description STRING", _CHECKED),
}


def register(spark: SparkSession, ids: str = "STRING", sizes: dict[str, int] | None = None, **tables: DataFrame) -> None:
    """Make the table functions callable from SQL, after the given tables have become views.

    `ids` is the type of ids; sizes are the tables' bytes (`Store.sizes`) when the functions are made, unknown ones null."""
    for name, rows in tables.items():
        rows.createOrReplaceTempView(name)
    chunk_function.register(spark)
    held = spark.range(1).select(*(pretty_size(F.lit(n)).alias(t) for t, n in (sizes or {}).items())).first().asDict() if sizes else {}
    for name, (parameters, columns, body) in FUNCTIONS.items():
        if name == "get_db_stats":
            body = body.format(**{t: f"'{held[t]}'" if t in held else "CAST(NULL AS STRING)" for t in ("article_chunks", "articles", "discovered_urls", "sitemaps")})
        typed = columns.replace("chunk_id BIGINT, article_id BIGINT", f"chunk_id {ids}, article_id {ids}")
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({parameters}) RETURNS TABLE({typed}) RETURN {body}")
