"""Inserts, upserts, status changes and resets as plans from old state to new state.

Files have no in-place update: each function returns the rows that the table
then has (or the rows to append), and `sources.store` writes them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def insert_new(target: DataFrame, rows: DataFrame, key: str = "url") -> DataFrame:
    """Rows to append: one for each key (the least row) that target lacks."""
    others = [c for c in rows.columns if c != key]
    first = rows.groupBy(key).agg(F.min(F.struct(*others)).alias("r")).select(key, "r.*").select(*rows.columns) if others else rows.distinct()
    return first.join(target.select(F.col(key).alias("_key")), F.col(key) == F.col("_key"), "left_anti")


def upsert_raw_pages(pages: DataFrame, rows: DataFrame, now: Column | None = None) -> DataFrame:
    """raw_pages after rows(url_id, content, created_at): content replaced, first creation time kept.

    Old and new rows meet in one aggregation: the latest write wins."""
    both = pages.select("url_id", "content", "created_at", F.lit(0).alias("_new")).unionByName(rows.select("url_id", "content", "created_at", F.lit(1).alias("_new")))
    latest = F.max_by("content", F.struct("_new", "created_at", "content"))
    updated = F.max("created_at") if now is None else F.when(F.max("_new") == 1, now).otherwise(F.max("created_at"))
    return both.groupBy("url_id").agg(latest.alias("content"), F.min("created_at").alias("created_at"), updated.alias("updated_at"))


def apply_transitions(urls: DataFrame, updates: DataFrame, now: Column) -> DataFrame:
    """URLs after updates(url_id, status, error, and seq for their order if a URL has several).

    Each crawling counts as an attempt; the last status stays; the crawl time is
    set if any of them ends a crawl; the message changes only with an error that
    has one, the last of these.  The updates of a URL are reduced to one row
    first, so a URL stays one row however often it is updated; updates of URLs
    that are not there change nothing."""
    at = F.col("seq") if "seq" in updates.columns else F.monotonically_increasing_id()
    u = updates.select(F.col("url_id").alias("_id"), F.col("status").alias("_status"), F.col("error").alias("_error"), at.alias("_at"))
    told = (F.col("_status") == "error") & (F.col("_error") != "")
    u = u.groupBy("_id").agg(
        F.max_by("_status", F.when(F.col("_status").isNotNull(), F.col("_at"))).alias("_status"), F.max_by("_error", F.when(told, F.col("_at"))).alias("_error"),
        F.count(F.when(F.col("_status") == "crawling", 1)).cast("int").alias("_tries"), F.max(F.coalesce(F.col("_status").isin("completed", "error", "crawled"), F.lit(False))).alias("_ended"), F.max(F.coalesce(told, F.lit(False))).alias("_told"),
    )
    new = {
        "crawl_status": F.coalesce("_status", "crawl_status"), "crawl_attempts": F.col("crawl_attempts") + F.coalesce("_tries", F.lit(0)),
        "last_crawl_at": F.when(F.col("_ended"), now).otherwise(F.col("last_crawl_at")), "updated_at": F.when(F.col("_id").isNotNull(), now).otherwise(F.col("updated_at")),
        "error_message": F.when(F.col("_told"), F.col("_error")).otherwise(F.col("error_message")),
    }
    joined = urls.join(u, urls["id"] == u["_id"], "left")
    return joined.select(*(new[c].alias(c) if c in new else urls[c] for c in urls.columns))


def applied_updates(urls: DataFrame, updates: DataFrame) -> DataFrame:
    """One row: updates, and how many of them find their URL."""
    known = urls.select(F.col("id").alias("_id")).where("_id is not null").distinct()
    found = updates.groupBy(F.col("url_id").alias("_url")).agg(F.count(F.lit(1)).alias("n")).join(known, F.col("_url") == F.col("_id"), "left")
    return found.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("updates"), F.coalesce(F.sum(F.when(F.col("_id").isNotNull(), F.col("n"))), F.lit(0)).alias("applied"))


def requeue_failed(urls: DataFrame, max_attempts: int | None = None) -> DataFrame:
    """Failed URLs pending again, below max_attempts if given."""
    again = F.col("crawl_status") == "error"
    if max_attempts is not None:
        again &= F.col("crawl_attempts") < max_attempts
    return urls.withColumn("crawl_status", F.when(again, "pending").otherwise(F.col("crawl_status")))


def reset_pending(urls: DataFrame) -> DataFrame:
    """Failed URLs (message cleared) and those without status are pending."""
    failed = F.col("crawl_status") == "error"
    return urls.withColumns({"error_message": F.when(~F.coalesce(failed, F.lit(False)), F.col("error_message")), "crawl_status": F.when(failed | F.col("crawl_status").isNull(), "pending").otherwise(F.col("crawl_status"))})


def delete_articles(articles: DataFrame, chunks: DataFrame, victims: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Articles and chunks after deleting victims(id): chunks go with their article."""
    v = victims.select(F.col("id").alias("_gone"))
    return articles.join(v, F.col("id") == F.col("_gone"), "left_anti"), chunks.join(v, F.col("article_id") == F.col("_gone"), "left_anti")


def delete_urls(urls: DataFrame, articles: DataFrame, victims: DataFrame) -> tuple[DataFrame, DataFrame]:
    """URLs after deleting victims(id), and articles, whose reference to them becomes null."""
    v = victims.select(F.col("id").alias("_gone")).distinct()
    kept = articles.join(v, F.col("crawled_from_url_id") == F.col("_gone"), "left")
    return urls.join(v, F.col("id") == F.col("_gone"), "left_anti"), kept.withColumn("crawled_from_url_id", F.when(F.col("_gone").isNull(), F.col("crawled_from_url_id"))).drop("_gone")


def embedding_rows(rows: DataFrame) -> DataFrame:
    """rows(url_id, texts, embeddings) as one row a text; a row whose lists differ in length or are null yields none."""
    whole = rows.where((F.size("texts") == F.size("embeddings")) & ~F.exists("embeddings", lambda e: e.isNull()))
    return whole.select("url_id", F.posexplode(F.arrays_zip("texts", "embeddings")).alias("chunk_index", "z")).select("url_id", "chunk_index", F.col("z.texts").alias("content"), F.col("z.embeddings").alias("embedding"))


def articles_from_pages(pages: DataFrame, title: Column, content: Column) -> DataFrame:
    """raw_pages(url_id, url, ...) as articles with derived hash and word count."""
    from loomline.functions.text import content_hash, word_count_sql

    made = pages.select("url", title.alias("title"), content.alias("content"), F.col("url_id").alias("crawled_from_url_id"), "created_at")
    return made.withColumns({"id": F.md5("url"), "content_hash": content_hash(F.col("content")), "word_count": word_count_sql(F.col("content"))})
