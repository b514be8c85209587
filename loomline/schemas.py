"""Tables of the crawl warehouse: schemas, value sets, row validation."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomline.functions.text import iso_format

S, L, I, D, TS = T.StringType(), T.LongType(), T.IntegerType(), T.DoubleType(), T.TimestampType()

#: States of a URL, change frequencies, kinds of URL and sitemap.
CRAWL_STATUS = ["pending", "crawling", "crawled", "completed", "error", "skipped"]
CHANGE_FREQ = ["always", "hourly", "daily", "weekly", "monthly", "yearly", "never"]
URL_TYPES = ["sitemap", "article", "page"]
SITEMAP_TYPES = ["sitemap", "sitemapindex", "urlset"]
EMBEDDING_DIMENSIONS = 1024


def _table(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


_TIMES = {"created_at": TS, "updated_at": TS}
TABLES = {
    "discovered_urls": _table(id=S, url=S, domain=S, source_sitemap=S, priority=T.DecimalType(3, 2), changefreq=S, lastmod=TS, crawl_status=S, crawl_attempts=I, last_crawl_at=TS, error_message=S, metadata=S, **_TIMES),
    "articles": _table(id=S, url=S, title=S, content=S, content_hash=S, word_count=I, crawled_from_url_id=S, metadata=S, **_TIMES),
    "article_chunks": _table(id=S, article_id=S, content=S, content_hash=S, embedding=T.ArrayType(T.FloatType()), chunk_index=I, chunk_size=I, metadata=S, created_at=TS),
    "sitemaps": _table(id=S, url=S, domain=S, status=S, urls_count=I, parsed_at=TS, error_message=S, metadata=S, **_TIMES),
    "raw_pages": _table(url_id=S, content=S, **_TIMES),
    "embeddings": _table(url_id=S, chunk_index=I, content=S, embedding=T.ArrayType(T.FloatType()), created_at=TS),
    "crawl_logs": _table(id=S, url=S, status=S, message=S, created_at=TS),
    "search_logs": _table(id=S, query=S, results_count=I, created_at=TS),
}


def _http(c: Column) -> Column:
    return c.startswith("http://") | c.startswith("https://")


def rules(table: str, dimensions: int = EMBEDDING_DIMENSIONS) -> dict[str, Column]:
    """Name and condition that every row of the table must meet."""
    filled = lambda name: F.coalesce(F.trim(F.col(name)), F.lit("")) != ""
    found = {
        "discovered_urls": {
            "url is empty": filled("url"), "url is not http(s)": ~filled("url") | _http(F.col("url")), "priority is not within 0 and 1": F.coalesce(F.col("priority").between(0, 1), F.lit(True)),
            "crawl_status is unknown": F.coalesce(F.col("crawl_status").isin(CRAWL_STATUS), F.lit(True)),
        },
        "articles": {"url is empty": filled("url"), "url is not http(s)": ~filled("url") | _http(F.col("url")), "content is empty": filled("content")},
        "article_chunks": {
            "article_id is missing": F.col("article_id").isNotNull(), "content is empty": filled("content"), "chunk_index is negative": F.coalesce(F.col("chunk_index") >= 0, F.lit(False)),
            "embedding has another dimension": F.col("embedding").isNull() | (F.size("embedding") == dimensions),
        },
        "sitemaps": {"url is empty": filled("url"), "domain is empty": filled("domain"), "urls_count is negative": F.coalesce(F.col("urls_count") >= 0, F.lit(True))},
    }
    return found[table]


def violations(df: DataFrame, table: str, key: str = "id", dimensions: int = EMBEDDING_DIMENSIONS) -> DataFrame:
    """(key, violation): one row for each rule that a row breaks, in one pass."""
    broken = F.filter(F.array(*(F.when(~ok, F.lit(name)) for name, ok in rules(table, dimensions).items())), lambda x: x.isNotNull())
    return df.select(F.col(key), F.explode(broken).alias("violation"))


def table_of(name: str) -> str:
    """Table name of a table or of a model, its singular."""
    singular = {"discovered_url": "discovered_urls", "article": "articles", "chunk": "article_chunks", "article_chunk": "article_chunks", "sitemap": "sitemaps"}
    return singular.get(name.lower(), name.lower())


def model(name: str) -> T.StructType:
    """Schema by table name or by its singular model name."""
    return TABLES[table_of(name)]


def validity(dimensions: int = EMBEDDING_DIMENSIONS, **tables: DataFrame) -> DataFrame:
    """Of each table (by model or table name): its rows, those that break a rule, and whether all are valid."""
    found = []
    for name, df in sorted(tables.items()):
        table = table_of(name)
        fine = reduce(lambda a, b: a & b, rules(table, dimensions).values())
        found.append(df.agg(F.count(F.lit(1)).alias("rows"), F.count(F.when(~fine, 1)).alias("broken")).select(F.lit(table).alias("table_name"), "rows", "broken", (F.col("broken") == 0).alias("valid")))
    return reduce(DataFrame.unionByName, found)


def serialized(df: DataFrame) -> DataFrame:
    """Each row as one JSON object, `record`: times in ISO 8601, nulls kept, columns in their order."""
    shown = [iso_format(F.col(f"`{f.name}`")).alias(f.name) if isinstance(f.dataType, T.TimestampType | T.TimestampNTZType) else F.col(f"`{f.name}`") for f in df.schema.fields]
    return df.select(F.to_json(F.struct(*shown), {"ignoreNullFields": "false"}).alias("record"))
