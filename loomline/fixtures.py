"""The crawl warehouse derived from the driver's tables, by the same SQL in Spark and DuckDB."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

HOST = r"'^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)'"
_WORDS = {"spark": "size(split(text, ' '))", "duckdb": "len(string_split(text, ' '))"}


def fixture_sql(dialect: str) -> dict[str, str]:
    """SELECT of each warehouse table; tables are named {pages}, {documents}, {embeddings}."""
    start = "TIMESTAMP '2024-01-01 00:00:00'"
    host = HOST if dialect == "duckdb" else f"r{HOST}"
    url_columns = f"""
        url, regexp_extract(url, {host}, 1) AS domain,
        CASE WHEN page_id % 10 < 4 THEN 'completed' WHEN page_id % 10 < 6 THEN 'pending' WHEN page_id % 10 < 8 THEN 'error' WHEN page_id % 10 = 8 THEN 'crawling' END AS crawl_status,
        CAST(page_id % 4 AS INT) AS crawl_attempts, CASE WHEN page_id % 7 <> 0 THEN (page_id % 11) / 10.0e0 END AS priority,
        CASE WHEN page_id % 3 = 0 THEN {start} + INTERVAL '1' MINUTE * CAST(page_id % 977 AS INT) END AS last_crawl_at,
        CASE WHEN page_id % 10 = 6 THEN 'timeout after ' || CAST(page_id % 30 AS STRING) || ' s' END AS error_message,
        {start} + INTERVAL '1' SECOND * CAST(page_id AS INT) AS created_at, {start} + INTERVAL '2' SECOND * CAST(page_id AS INT) AS updated_at"""
    return {
        "discovered_urls": f"SELECT page_id AS id, {url_columns} FROM {{pages}} UNION ALL SELECT page_id + 100000000 AS id, {url_columns} FROM {{pages}} WHERE page_id % 40 = 0",
        "articles": f"""SELECT doc_id AS id, 'https://articles.example.com/' || CAST(doc_id AS STRING) AS url, 'Article ' || CAST(doc_id AS STRING) AS title, text AS content,
            CASE WHEN text <> '' THEN md5(text) END AS content_hash, CAST({_WORDS[dialect]} AS INT) AS word_count, doc_id % (SELECT count(*) FROM {{pages}}) AS crawled_from_url_id,
            {start} + INTERVAL '1' SECOND * CAST(doc_id % 100 AS INT) AS created_at FROM {{documents}}""",
        "article_chunks": """SELECT vec_id AS id, CASE WHEN vec_id % 50 = 49 THEN vec_id + 1000000000 ELSE vec_id % (SELECT count(*) FROM {documents}) END AS article_id,
            'chunk ' || CAST(vec_id AS STRING) AS content, CASE WHEN vec_id % 37 <> 36 THEN embedding END AS embedding, CAST(vec_id % 5 AS INT) AS chunk_index,
            length('chunk ' || CAST(vec_id AS STRING)) AS chunk_size FROM {embeddings}""",
        "sitemaps": f"""SELECT * FROM (VALUES
            (1, 'https://a.example/sitemap.xml', 'a.example', 'completed', CAST(NULL AS STRING), {start}),
            (2, 'https://b.example/sitemap.xml', 'b.example', 'error', 'HTTP 500', {start} + INTERVAL '90' MINUTE),
            (3, 'https://c.example/sitemap_index.xml', 'c.example', 'error', CAST(NULL AS STRING), {start})) AS t(id, url, domain, status, error_message, updated_at)""",
        "raw_pages": f"SELECT page_id AS url_id, html AS content, {start} + INTERVAL '1' SECOND * CAST(page_id AS INT) AS created_at FROM {{pages}}",
    }


def warehouse(spark: SparkSession, sf_dir: str, *names: str) -> list[DataFrame]:
    """The named tables, each a plan over the driver's Parquet files."""
    base = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("pages", "documents", "embeddings")}
    sql = fixture_sql("spark")
    return [spark.sql(sql[n], **{t: df for t, df in base.items() if f"{{{t}}}" in sql[n]}) for n in names]


def oracle(query: str, *names: str) -> str:
    """DuckDB SQL: the named fixture tables as common table expressions, then the query."""
    sql = fixture_sql("duckdb")
    tables = ", ".join(f"{n} AS ({sql[n].format(pages='pages', documents='documents', embeddings='embeddings')})" for n in names)
    query = query.strip()
    recursive = query.startswith("WITH RECURSIVE")
    if query.startswith("WITH"):
        return f"WITH {'RECURSIVE ' if recursive else ''}{tables}, {query.removeprefix('WITH RECURSIVE').removeprefix('WITH').strip()}"
    return f"WITH {tables} {query}"
