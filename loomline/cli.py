"""Command line over a Store: python -m loomline.cli ROOT COMMAND [ARGUMENT]."""

from __future__ import annotations

import argparse
import importlib
import itertools
import textwrap
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomline.functions.text import title
from loomline.functions.vectors import hash_embed
from loomline.operators import frontier, mutations, warehouse
from loomline.plans.retrieval import process_new
from loomline.schemas import TABLES
from loomline.sources.store import Store
from loomline.sources.work import checkpointed
from loomline.streaming.queue import fetch_pages

DIMENSIONS = 1024


def shown(results: list, width: int = 80) -> str:
    """Search results as text: rank, similarity, title, address, wrapped content."""
    lines = []
    for i, r in enumerate(results, 1):
        lines += [f"{i}. [{r.similarity_score:.3f}] {r.article_title}", f"   {r.article_url}", textwrap.fill(r.chunk_content, width, initial_indent="   ", subsequent_indent="   ")]
    return "\n".join(lines)


def discover(store: Store, path: str) -> int:
    """Queue the pages of sitemap files (JSON lines of url, xml) under path."""
    files = store.spark.read.schema("url string, xml string").json(path)
    rows = frontier.discovered(frontier.sitemap_entries(files), F.current_timestamp())
    return store.append("discovered_urls", mutations.insert_new(store.read("discovered_urls"), rows))


def embed(store: Store, limit: int | None) -> int:
    """Chunk and embed articles that have no chunks yet."""
    new = process_new(store.read("articles"), store.read("article_chunks"), limit, dimensions=DIMENSIONS)
    return store.append("article_chunks", new.withColumn("article_id", F.col("article_id").cast("string")).withColumn("created_at", F.current_timestamp()))


def crawl(store: Store, load: Callable[[], Callable[[str], dict]], limit: int = 100) -> int:
    """Fetch the next pending URLs, keep their pages and articles, set their states; how many were tried.

    Fetched rows are written before anything is made of them, so no page is fetched twice."""
    now, urls = F.current_timestamp(), store.read("discovered_urls")
    batch = checkpointed(warehouse.pending_urls(urls, limit).select("id", "url", "created_at"))
    tried = batch.count()
    if not tried:
        return 0
    got = checkpointed(fetch_pages(batch, load).join(batch, "url").withColumn("created_at", now))
    ok = F.col("success") & F.col("content").isNotNull()
    pages = got.where(ok).select(F.col("id").alias("url_id"), "url", "content", "created_at")
    store.update("raw_pages", lambda rows: mutations.upsert_raw_pages(rows, pages, now))
    articles = mutations.articles_from_pages(pages, title(F.col("content")), F.col("content"))
    store.append("articles", mutations.insert_new(store.read("articles"), articles))
    ended = got.select(F.col("id").alias("url_id"), F.when(ok, "completed").otherwise("error").alias("status"), F.when(~ok, F.coalesce("error", F.lit("no content"))).alias("error"), F.lit(1).alias("seq"))
    begun = batch.select(F.col("id").alias("url_id"), F.lit("crawling").alias("status"), F.lit(None).cast("string").alias("error"), F.lit(0).alias("seq"))
    # what was queued during the fetch stays: states are put on the table as it then is
    store.update("discovered_urls", lambda rows: mutations.apply_transitions(rows, begun.unionByName(ended), now))
    return tried


def auto(store: Store, load: Callable[[], Callable[[str], dict]], path: str | None = None, batch: int = 100, interval: float | None = None, rounds: int | None = None) -> dict[str, int]:
    """Discover, crawl and embed until nothing is pending, or every `interval` seconds, `rounds` times or for good."""
    done = {"discovered": 0, "crawled": 0, "chunks": 0}
    for number in itertools.count(1):
        done["discovered"] += discover(store, path) if path else 0
        while tried := crawl(store, load, batch):
            done["crawled"] += tried
        done["chunks"] += embed(store, None)
        if interval is None or number == rounds:
            return done
        time.sleep(interval)


def client(name: str) -> Callable[[], Callable[[str], dict]]:
    """The maker of a client, a function that is named as module:function."""
    module, _, function = name.partition(":")
    return getattr(importlib.import_module(module), function)


def rebuild(store: Store) -> dict[str, bool]:
    """Empty all tables, make those that are missing, and tell of each whether it is there, empty and of its schema."""
    for table in TABLES:
        store.update(table, lambda _, table=table: store.spark.createDataFrame([], TABLES[table]))
    found = {table: store.read(table) for table in TABLES}
    return {table: store.exists(table) and rows.columns == TABLES[table].names and not rows.limit(1).count() for table, rows in found.items()}


def search(store: Store, question: str, limit: int = 5, threshold: float = 0.3) -> list:
    vector = [float(x) for x in hash_embed([question], DIMENSIONS)[0]]
    return warehouse.vector_search(store.read("article_chunks"), store.read("articles"), vector, limit, threshold).orderBy(F.desc("similarity_score")).collect()


def report(store: Store, name: str) -> DataFrame:
    urls, articles, chunks, sitemaps = (store.read(t) for t in ("discovered_urls", "articles", "article_chunks", "sitemaps"))
    return {
        "stats": lambda: warehouse.db_stats(discovered_urls=urls, articles=articles, article_chunks=chunks, sitemaps=sitemaps), "domains": lambda: warehouse.domain_stats(urls, articles, chunks).orderBy(F.desc("total_urls")),
        "progress": lambda: warehouse.crawl_progress(urls, articles, chunks), "integrity": lambda: warehouse.data_integrity(urls, articles, chunks), "errors": lambda: warehouse.recent_errors(urls, sitemaps), "pending": lambda: warehouse.pending_urls(urls),
    }[name]()


def main(arguments: list[str] | None = None, spark: SparkSession | None = None) -> object:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("root")
    parser.add_argument("command", choices=["discover", "crawl", "auto", "embed", "rebuild", "search", "reset-pending", "clear", "dedup", "stats", "domains", "progress", "integrity", "errors", "pending"])
    parser.add_argument("argument", nargs="?")
    parser.add_argument("--client", help="module:function that makes a fetching client")
    parser.add_argument("--batch", type=int, default=100)
    parser.add_argument("--interval", type=float)
    a = parser.parse_args(arguments)
    store = Store(spark or SparkSession.builder.getOrCreate(), a.root)
    if a.command == "discover":
        return discover(store, a.argument)
    if a.command in ("crawl", "auto"):
        if not a.client:
            parser.error(f"{a.command} needs --client")
        if a.command == "crawl":
            return crawl(store, client(a.client), a.batch)
        return auto(store, client(a.client), a.argument, a.batch, a.interval)
    if a.command == "rebuild":
        return rebuild(store)
    if a.command == "embed":
        return embed(store, int(a.argument) if a.argument else None)
    if a.command == "search":
        print(shown(found := search(store, a.argument or "")))
        return found
    if a.command == "reset-pending":
        return store.write("discovered_urls", mutations.reset_pending(store.read("discovered_urls")))
    if a.command == "clear":
        return store.clear(*([a.argument] if a.argument in TABLES else []))
    if a.command == "dedup":
        articles, chunks, counts = warehouse.cleanup_duplicates(store.read("articles"), store.read("article_chunks"))
        row = counts.first()
        store.write("article_chunks", chunks)
        store.write("articles", articles)
        return row.asDict()
    found = report(store, a.command)
    found.show(50, truncate=False)
    return found


if __name__ == "__main__":
    main()
