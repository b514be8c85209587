"""The crawl frontier: robots rules, sitemaps, discovery."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomline.functions.text import domain, is_sitemap, strip, url_path
from loomline.sources.work import checkpointed

#: A longer wanted delay refuses the domain.
MAX_CRAWL_DELAY = 30.0


def robots_lines(files: DataFrame) -> DataFrame:
    """files(domain, text) as lines: domain, pos, name, value, agent (the last one named before)."""
    lines = files.select("domain", F.posexplode(F.split("text", "\r\n|\n|\r")).alias("pos", "raw")).withColumn("line", strip(F.col("raw")))
    fields = lines.where(~F.col("line").startswith("#") & F.col("line").contains(":")).select(
        "domain", "pos", F.lower(strip(F.substring_index("line", ":", 1))).alias("name"), strip(F.expr("substring(line, instr(line, ':') + 1)")).alias("value")
    )
    before = Window.partitionBy("domain").orderBy("pos")
    return fields.withColumn("agent", F.last(F.when(F.col("name") == "user-agent", F.col("value")), ignorenulls=True).over(before))


def robots_rules(files: DataFrame, agent: str = "*") -> DataFrame:
    """domain, allow, path: the rules for one agent; empty ones are dropped."""
    return robots_lines(files).where((F.col("agent") == agent) & F.col("name").isin("allow", "disallow") & (F.col("value") != "")).select("domain", (F.col("name") == "allow").alias("allow"), F.col("value").alias("path"))


def robots_summary(files: DataFrame, agent: str = "*") -> DataFrame:
    """domain, crawl_delay (the last valid one), sitemaps in order of mention."""
    lines = robots_lines(files)
    delay = F.when((F.col("agent") == agent) & (F.col("name") == "crawl-delay"), F.expr("try_cast(value AS double)"))
    return lines.groupBy("domain").agg(
        F.max_by(delay, F.when(delay.isNotNull(), F.col("pos"))).alias("crawl_delay"),
        F.transform(F.sort_array(F.collect_list(F.when(F.col("name") == "sitemap", F.struct("pos", "value")))), lambda x: x["value"]).alias("sitemaps"),
    )


def robots_allowed(urls: DataFrame, rules: DataFrame, url: str = "url") -> DataFrame:
    """urls with `allowed`: the longest rule that begins the path decides, allow on a tie, else allowed.

    Each path is cut at the lengths that rules of its domain have, and these prefixes
    meet the rules in one equal join on (domain, prefix): no URL looks through a list
    of rules, however many a host has, and a host's rules and prefixes are spread over
    tasks.  A path is looked up once however many URLs have it."""
    path, host = url_path(F.col(url)), domain(F.col(url))
    known = rules.groupBy(F.col("domain").alias("_domain"), F.col("path").alias("_prefix")).agg(F.max("allow").alias("_allow"))
    lengths = known.groupBy("_domain").agg(F.collect_set(F.length("_prefix")).alias("_lengths"))  # as many as the longest path has characters, at most
    cut = F.transform(F.filter("_lengths", lambda n: n <= F.length("_path")), lambda n: F.substring(F.col("_path"), F.lit(1), n))
    asked = urls.select(host.alias("_domain"), path.alias("_path")).distinct().join(lengths, "_domain")
    met = asked.select("_domain", "_path", F.explode(cut).alias("_prefix")).join(known, ["_domain", "_prefix"])
    best = met.groupBy("_domain", "_path").agg(F.max_by("_allow", F.length("_prefix")).alias("_best"))
    joined = urls.join(best, (host == F.col("_domain")) & (path == F.col("_path")), "left")
    return joined.withColumn("allowed", F.coalesce("_best", F.lit(True))).drop("_domain", "_path", "_best")


def delay_gate(summary: DataFrame, min_delay: float = 0.5) -> DataFrame:
    """domain, accepted, min_delay: a domain that wants more than MAX_CRAWL_DELAY is refused."""
    wanted = F.coalesce("crawl_delay", F.lit(0.0))
    return summary.select("domain", (wanted <= MAX_CRAWL_DELAY).alias("accepted"), F.greatest(wanted, F.lit(min_delay)).alias("min_delay"))


def sitemap_entries(sitemaps: DataFrame) -> DataFrame:
    """sitemaps(url, xml) as entries: source, loc, priority, lastmod, changefreq, nested. Malformed XML yields none."""
    item = "STRUCT<loc: STRING, priority: STRING, lastmod: STRING, changefreq: STRING>"
    read = lambda tag: F.from_xml(F.col("xml"), f"`{tag}` ARRAY<{item}>")
    entries = sitemaps.withColumn("xml", F.regexp_replace("xml", r"(</?)[A-Za-z_][\w.-]*:", "$1")).select(
        F.col("url").alias("source"), F.explode(F.concat(F.coalesce(read("url")["url"], F.array()), F.coalesce(read("sitemap")["sitemap"], F.array()))).alias("e"), F.col("xml").contains("<sitemapindex").alias("index")
    )
    return entries.where("trim(e.loc) <> ''").select(
        "source", F.trim("e.loc").alias("loc"), F.expr("try_cast(e.priority AS double)").alias("priority"), F.expr("try_to_timestamp(e.lastmod)").alias("lastmod"), F.col("e.changefreq").alias("changefreq"),
        (F.col("index") | is_sitemap(F.trim("e.loc"))).alias("nested"),
    )


def sitemap_closure(links: DataFrame, roots: DataFrame) -> DataFrame:
    """(url, depth): sitemaps reachable over links(source, loc), each at its least depth; ends when a level brings nothing new.

    One join a level, with what the level before found; it and all that is known
    are written to the checkpoint folder, so the plan stays short however deep
    the sitemaps are."""
    step = seen = checkpointed(roots.select("url").distinct().withColumn("depth", F.lit(0)))
    depth = 0
    while True:
        depth += 1
        reached = step.join(links, F.col("url") == F.col("source")).select(F.col("loc").alias("url")).distinct()
        step = checkpointed(reached.join(seen.select("url"), "url", "left_anti").withColumn("depth", F.lit(depth)))
        if not step.limit(1).count():
            return seen
        seen = checkpointed(seen.union(step))


def discovered(entries: DataFrame, now: Column) -> DataFrame:
    """discovered_urls rows for page entries, one a URL."""
    pages = entries.where(~F.col("nested")).groupBy("loc").agg(F.min("source").alias("source_sitemap"), F.max("priority").alias("priority"), F.max("lastmod").alias("lastmod"), F.min("changefreq").alias("changefreq"))
    return pages.select(
        F.md5("loc").alias("id"), F.col("loc").alias("url"), domain(F.col("loc")).alias("domain"), "source_sitemap", F.col("priority").cast("decimal(3,2)"), "changefreq", "lastmod",
        F.lit("pending").alias("crawl_status"), F.lit(0).alias("crawl_attempts"), now.alias("created_at"), now.alias("updated_at"),
    )


def normalized_items(items: DataFrame) -> DataFrame:
    """Queue input, a string or a struct of (url, priority, lastmod), as columns; a bad time is null."""
    if dict(items.dtypes)["item"] == "string":
        return items.select(F.col("item").alias("url"), F.lit(None).cast("double").alias("priority"), F.lit(None).cast("timestamp").alias("lastmod"))
    return items.select("item.url", F.col("item.priority").cast("double").alias("priority"), F.expr("try_to_timestamp(item.lastmod)").alias("lastmod"))


def generated_urls(spark, total: int, prefix: str = "http://example.com/page/") -> DataFrame:
    """Synthetic URLs for load tests."""
    return spark.range(total).select(F.concat(F.lit(prefix), F.col("id").cast("string")).alias("url"))
