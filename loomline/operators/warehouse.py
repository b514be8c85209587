"""Statistics, integrity, deduplication, search and queue queries over the crawl warehouse.

Functions take DataFrames of the tables in `schemas` and return plans; nothing
is collected.  The embedding column is read only by the vector queries.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomline.functions.vectors import cosine, cosine_to


def _when(condition: Column) -> Column:
    return F.count(F.when(condition, 1)).cast("long")


def _percent(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, F.round(part * F.lit(100.0) / whole, 2)).otherwise(0.0)


def _fanned(urls: DataFrame, articles: DataFrame, chunks: DataFrame) -> DataFrame:
    """URLs with what the left join with articles and chunks would give for each, without making its rows:
    n_rows of it, its articles and chunks, rows with an article, and words summed over these rows.

    Chunks are counted by article and these by URL before they are joined; ids
    are primary keys."""
    c = chunks.groupBy("article_id").agg(F.count(F.lit(1)).alias("fan"), F.count("id").alias("n_chunks"))
    a = articles.select(F.col("id").alias("a_id"), "crawled_from_url_id", "word_count").join(c, F.col("a_id") == F.col("article_id"), "left")
    fan = F.coalesce("fan", F.lit(1))
    by_url = a.groupBy("crawled_from_url_id").agg(F.count("a_id").alias("n_articles"), F.sum(fan).alias("a_rows"), F.sum("n_chunks").alias("n_chunks"), F.sum(F.col("word_count") * fan).alias("words"))
    u = urls.select("id", "domain", "crawl_status", "created_at", "updated_at").join(by_url, F.col("id") == F.col("crawled_from_url_id"), "left")
    zero = lambda name: F.coalesce(name, F.lit(0))
    return u.withColumns({"n_rows": F.when(F.col("id").isNull(), 0).otherwise(F.coalesce("a_rows", F.lit(1))), "n_articles": zero("n_articles"), "a_rows": zero("a_rows"), "n_chunks": zero("n_chunks")})


def domain_stats(urls: DataFrame, articles: DataFrame, chunks: DataFrame) -> DataFrame:
    """Counts by domain as after the fan-out of both joins (so a URL counts once a chunk)."""
    of = lambda status: F.sum(F.when(F.col("crawl_status") == status, F.col("n_rows")).otherwise(0))
    return _fanned(urls, articles, chunks).groupBy("domain").agg(
        F.sum("n_rows").alias("total_urls"), of("completed").alias("crawled_urls"), of("pending").alias("pending_urls"), of("error").alias("error_urls"),
        F.sum("a_rows").alias("total_articles"), F.sum("n_chunks").alias("total_chunks"), _percent(of("completed"), F.sum("n_rows")).alias("crawl_success_rate"),
    )


def domain_summary(urls: DataFrame, articles: DataFrame, chunks: DataFrame) -> DataFrame:
    """Counts by domain; total_words is summed as after the fan-out."""
    return _fanned(urls, articles, chunks).groupBy("domain").agg(
        F.count("id").alias("total_urls"), *(F.count(F.when(F.col("crawl_status") == s, F.col("id"))).alias(f"{s}_urls") for s in ("completed", "pending", "error")),
        F.sum("n_articles").alias("total_articles"), F.sum("words").alias("total_words"), F.sum("n_chunks").alias("total_chunks"),
        F.min("created_at").alias("first_discovered"), F.max("updated_at").alias("last_updated"),
    )


def crawl_progress(urls: DataFrame, articles: DataFrame, chunks: DataFrame) -> DataFrame:
    """One row of global counts and ratios."""
    status = F.col("crawl_status")
    u = urls.agg(F.count("id").alias("total_discovered"), _when(status == "completed").alias("total_crawled"), _when(status == "pending").alias("total_pending"), _when(status == "error").alias("total_errors"))
    a, c = articles.agg(F.count(F.lit(1)).alias("total_articles")), chunks.agg(F.count(F.lit(1)).alias("total_chunks"))
    return u.crossJoin(a).crossJoin(c).select(  # three rows of one
        "*", F.when(F.col("total_articles") > 0, F.round(F.col("total_chunks") / F.col("total_articles"), 2)).otherwise(0.0).alias("avg_chunks_per_article"),
        _percent(F.col("total_crawled"), F.col("total_discovered")).alias("progress_percentage"),
    )


def article_stats(articles: DataFrame, chunks: DataFrame) -> DataFrame:
    """Chunks of each article; chunks are counted before the join."""
    per = chunks.groupBy("article_id").agg(F.count("id").alias("n"), F.avg("chunk_size").alias("avg_chunk_size"))
    a = articles.select("id", "url", "title", "word_count", "created_at")
    return a.join(per, a["id"] == per["article_id"], "left").select("id", "url", "title", "word_count", F.coalesce("n", F.lit(0)).alias("chunk_count"), "avg_chunk_size", "created_at")


def recent_errors(urls: DataFrame, sitemaps: DataFrame, limit: int = 50) -> DataFrame:
    u = urls.where("crawl_status = 'error' and error_message is not null").select(F.lit("url_crawl").alias("error_type"), "url", "error_message", F.col("updated_at").alias("error_time"), "crawl_attempts")
    s = sitemaps.where("status = 'error' and error_message is not null").select(F.lit("sitemap_parse").alias("error_type"), "url", "error_message", F.col("updated_at").alias("error_time"), F.lit(0).alias("crawl_attempts"))
    return u.unionByName(s).orderBy(F.desc("error_time"), "url", "error_type").limit(limit)


def duplicate_urls(urls: DataFrame) -> DataFrame:
    return urls.groupBy("url").agg(F.count(F.lit(1)).alias("copies")).where("copies > 1")


def orphan_chunks(chunks: DataFrame, articles: DataFrame) -> DataFrame:
    """Chunks whose article is missing."""
    return chunks.join(articles.select(F.col("id").alias("_id")), F.col("article_id") == F.col("_id"), "left_anti")


def unprocessed_articles(articles: DataFrame, chunks: DataFrame, limit: int | None = None) -> DataFrame:
    """Articles without chunks, the first `limit` by id if given."""
    found = articles.join(chunks.select("article_id"), articles["id"] == chunks["article_id"], "left_anti")
    return found if limit is None else found.orderBy("id").limit(limit)


#: The checks' descriptions, as reports show them.
CHECKS = {
    "orphaned_chunks": ("WARNING", "存在沒有對應文章的文章分塊"), "articles_without_chunks": ("INFO", "存在沒有分塊的文章"),
    "duplicate_urls": ("WARNING", "存在重複的 URL"), "chunks_without_embeddings": ("INFO", "存在沒有嵌入向量的文章分塊"),
}


def data_integrity(urls: DataFrame, articles: DataFrame, chunks: DataFrame) -> DataFrame:
    """Four checks: name, status, number of issues, description."""
    found = {
        "orphaned_chunks": orphan_chunks(chunks.select("id", "article_id"), articles), "articles_without_chunks": unprocessed_articles(articles.select("id"), chunks),
        "duplicate_urls": duplicate_urls(urls), "chunks_without_embeddings": chunks.where("embedding is null"),
    }
    rows = []
    for name, issues in found.items():
        severity, text = CHECKS[name]
        n = issues.agg(F.count(F.lit(1)).alias("issue_count"))
        rows.append(n.select(F.lit(name).alias("check_name"), F.when(F.col("issue_count") == 0, "OK").otherwise(severity).alias("status"), "issue_count", F.lit(text).alias("description")))
    return reduce(DataFrame.unionByName, rows)


def db_stats(**tables: DataFrame) -> DataFrame:
    """Rows of each table."""
    return reduce(DataFrame.unionByName, (df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count") for name, df in sorted(tables.items())))


def db_totals(**tables: DataFrame) -> DataFrame:
    """Health summary: tables, empty ones, rows of all."""
    return db_stats(**tables).agg(F.count(F.lit(1)).alias("tables"), _when(F.col("row_count") == 0).alias("empty_tables"), F.sum("row_count").alias("total_rows"), F.when(F.sum("row_count") > 0, "OK").otherwise("EMPTY").alias("status"))


def pending_urls(urls: DataFrame, limit: int = 100) -> DataFrame:
    """Next URLs to crawl: by priority, then longest untouched."""
    pending = urls.where(F.col("crawl_status").isNull() | (F.col("crawl_status") == "pending"))
    return pending.orderBy(F.desc_nulls_last("priority"), F.coalesce("last_crawl_at", "created_at"), "id").limit(limit)


def url_exists(urls: DataFrame, sitemaps: DataFrame, wanted: DataFrame) -> DataFrame:
    """wanted(url) with whether it is known as sitemap or page; all addresses in one join."""
    known = urls.select("url").union(sitemaps.select("url")).distinct().withColumn("_known", F.lit(True))
    return wanted.join(known, "url", "left").select("url", F.coalesce("_known", F.lit(False)).alias("known"))


def article_by_url(articles: DataFrame, url: str) -> DataFrame:
    return articles.where(F.col("url") == url).limit(1)


def articles_per_domain(articles: DataFrame, domain: Column) -> DataFrame:
    return articles.groupBy(domain.alias("domain")).agg(F.count(F.lit(1)).alias("articles"))


def duplicate_articles(articles: DataFrame) -> DataFrame:
    """Articles that repeat an older one's content: id, kept_id.

    The oldest of each hash is found by aggregation, not a window, so a hash
    that a third of all rows share is one row a task before the shuffle."""
    hashed = articles.where("content_hash is not null and content_hash <> ''").select("id", "content_hash", "created_at")
    first = hashed.groupBy("content_hash").agg(F.min(F.struct("created_at", "id")).alias("k"), F.count(F.lit(1)).alias("n")).where("n > 1").select("content_hash", F.col("k.id").alias("kept_id"))
    return hashed.join(first, "content_hash").where("id <> kept_id").select("id", "kept_id")


def dedup_survivors(articles: DataFrame) -> DataFrame:
    return articles.join(duplicate_articles(articles).select(F.col("id").alias("_dup")), F.col("id") == F.col("_dup"), "left_anti")


def cleanup_duplicates(articles: DataFrame, chunks: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(articles that stay, chunks that stay, one row of deleted_articles and deleted_chunks)."""
    gone = duplicate_articles(articles).select(F.col("id").alias("_dup"))
    kept = chunks.join(gone, F.col("article_id") == F.col("_dup"), "left_anti")
    lost = chunks.select("id", "article_id").join(gone, F.col("article_id") == F.col("_dup"), "left_semi")
    counts = gone.agg(F.count(F.lit(1)).alias("deleted_articles")).crossJoin(lost.agg(F.count(F.lit(1)).alias("deleted_chunks")))
    return dedup_survivors(articles), kept, counts


def vector_search(chunks: DataFrame, articles: DataFrame, query: list[float] | Column, limit: int = 10, threshold: float | None = 0.7) -> DataFrame:
    """Chunks most similar to a query vector, with their articles.

    Only ids are scored, joined (a semi join drops chunks without article) and
    ordered (TakeOrderedAndProject keeps k rows a task); contents and article
    columns are fetched for the k best alone."""
    score = cosine_to(F.col("embedding"), query) if isinstance(query, list) else cosine(F.col("embedding"), query)
    size = F.size("embedding") == (F.lit(len(query)) if isinstance(query, list) else F.size(query))
    # generated, so that the filter on the score does not compute it again
    scored = chunks.where(F.col("embedding").isNotNull() & size).select(F.col("id").alias("chunk_id"), "article_id", F.explode(F.array(score)).alias("similarity_score"))
    if threshold is not None:
        scored = scored.where(F.col("similarity_score") >= threshold)
    a = articles.select(F.col("id").alias("_id"), F.col("url").alias("article_url"), F.col("title").alias("article_title"))
    best = scored.join(a.select("_id"), F.col("article_id") == F.col("_id"), "left_semi").orderBy(F.desc("similarity_score"), "chunk_id").limit(limit)
    # `limit` rows: safe to broadcast
    found = chunks.select(F.col("id").alias("_chunk"), F.col("content").alias("chunk_content")).join(F.broadcast(best), F.col("_chunk") == F.col("chunk_id"))
    return found.join(a, F.col("article_id") == F.col("_id")).select("chunk_id", "article_id", "article_url", "article_title", "chunk_content", "similarity_score")


def rag_prompt(found: DataFrame, question: str) -> DataFrame:
    """The prompt: context lines by rank, then the question; with its sources."""
    ranked = found.select(F.struct((-F.col("similarity_score")).alias("d"), "chunk_id", "chunk_content", "article_url").alias("r"))
    rows = F.sort_array(F.collect_list("r"))
    return ranked.agg(F.array_join(F.transform(rows, lambda r: r["chunk_content"]), "\n").alias("context"), F.transform(rows, lambda r: r["article_url"]).alias("sources")).select(
        F.concat(F.lit("Context:\n"), "context", F.lit(f"\n\nQuestion: {question}")).alias("prompt"), "sources"
    )


def chunk_statistics(chunks: DataFrame) -> DataFrame:
    return chunks.agg(F.count(F.lit(1)).alias("total_chunks"), F.avg("chunk_size").alias("avg_chunk_size"), F.min("chunk_size").alias("min_chunk_size"), F.max("chunk_size").alias("max_chunk_size"))


def request_stats(log: DataFrame, key: str, ok: Column, duration: Column) -> DataFrame:
    """Requests, successes, success rate and mean duration by key."""
    return log.groupBy(key).agg(F.count(F.lit(1)).alias("requests"), _when(ok).alias("successes"), _percent(_when(ok), F.count(F.lit(1))).alias("success_rate"), F.avg(duration).alias("avg_duration"))


def urls_in_range(urls: DataFrame, start: Column, stop: Column) -> DataFrame:
    """URLs discovered from start up to stop, by domain."""
    found = urls.where((F.col("created_at") >= start) & (F.col("created_at") < stop))
    return found.groupBy("domain").agg(F.count(F.lit(1)).alias("urls"), _when(F.col("crawl_status") == "completed").alias("completed"), F.min("created_at").alias("first_seen"))


def expired(rows: DataFrame, now: Column, days: int, also: Column | None = None) -> DataFrame:
    """Rows that retention removes: untouched for more than `days`, and as `also` says."""
    old = F.coalesce("updated_at", "created_at") < now - F.expr(f"interval {int(days)} days")
    return rows.where(old if also is None else old & also)


def load_summary(log: DataFrame, at: Column, ok: Column, duration: Column) -> DataFrame:
    """One row over a request log: requests, successes and their rate, requests a second, mean duration."""
    seconds = F.unix_micros(F.max(at).cast("timestamp")) - F.unix_micros(F.min(at).cast("timestamp"))
    total = F.count(F.lit(1))
    return log.agg(total.alias("total"), _when(ok).alias("succeeded"), _percent(_when(ok), total).alias("success_rate"), F.when(seconds > 0, total * 1e6 / seconds).alias("per_second"), F.avg(duration).alias("mean_seconds"))


def errors_by_type(log: DataFrame, kind: str) -> DataFrame:
    """Errors of a log by kind, and each kind's share of all."""
    counts = log.groupBy(kind).agg(F.count(F.lit(1)).alias("errors"))
    total = log.agg(F.count(F.lit(1)).alias("_all"))
    return counts.crossJoin(F.broadcast(total)).select(kind, "errors", _percent(F.col("errors"), F.col("_all")).alias("share"))  # total is one row


def table_sizes(sizes: dict[str, int], **tables: DataFrame) -> DataFrame:
    """db_stats with the bytes of each table, as text with a unit and as a number."""
    from loomline.functions.text import pretty_size

    stats = db_stats(**tables)
    held = F.create_map(*(F.lit(x) for name, n in sizes.items() for x in (name, n))) if sizes else F.create_map().cast("map<string,long>")
    size = F.coalesce(F.try_element_at(held, F.col("table_name")).cast("long"), F.lit(0))
    return stats.select("table_name", "row_count", size.alias("size_bytes"), pretty_size(size).alias("table_size"))
