"""The crawl queue as a stream: new URLs once, status by event, pages fetched in micro-batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from loomline.sources.store import Store

URL = T.StructType([T.StructField("url", T.StringType()), T.StructField("priority", T.DoubleType()), T.StructField("seen_at", T.TimestampType())])
STATE = "crawl_status string, crawl_attempts int, last_at timestamp, error_message string"
STATUS = f"url_id string, {STATE}"


def url_stream(spark: SparkSession, path: str, schema: T.StructType = URL, files_per_batch: int = 100) -> DataFrame:
    """New files of URLs under path."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).json(path)


def distinct_urls(stream: DataFrame, delay: str = "1 day", at: str = "seen_at") -> DataFrame:
    """Each URL once within the watermark; older state is dropped, so state does not grow without bound."""
    return stream.withWatermark(at, delay).dropDuplicatesWithinWatermark(["url"])


def url_states(events: DataFrame) -> DataFrame:
    """Current state of each URL after events(url_id, status, error, at), which are put in time order within a batch.

    Crawling counts an attempt; completed, crawled and error set the time; only an error with a message changes it."""

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        status, attempts, last, message = state.get if state.exists else ("pending", 0, None, None)
        for r in pd.concat(list(batches)).sort_values("at", kind="stable").itertuples():
            status = r.status
            attempts += status == "crawling"
            last = r.at if status in ("completed", "crawled", "error") else last
            message = r.error if status == "error" and r.error else message
        state.update((status, int(attempts), last, message))
        yield pd.DataFrame([(key[0], status, int(attempts), last, message)], columns=["url_id", "crawl_status", "crawl_attempts", "last_at", "error_message"])

    return events.select("url_id", "status", "error", "at").groupBy("url_id").applyInPandasWithState(step, STATUS, STATE, "update", GroupStateTimeout.NoTimeout)


def fetch_pages(urls: DataFrame, load: Callable[[], Callable[[str], dict]], url: str = "url") -> DataFrame:
    """urls fetched by a client that load() makes once a task: url, success, content, error. Failures become rows."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        get = load()
        for batch in batches:
            rows = []
            for address in batch["url"]:
                try:
                    page = get(address)
                    rows.append((address, bool(page.get("success", True)), page.get("content"), page.get("error")))
                except Exception as error:  # noqa: BLE001 - recorded with the URL
                    rows.append((address, False, None, str(error) or type(error).__name__))
            yield pd.DataFrame(rows, columns=["url", "success", "content", "error"])

    return urls.select(F.col(url).alias("url")).mapInPandas(run, "url string, success boolean, content string, error string")


def consume(stream: DataFrame, sink: Callable[[DataFrame, int], None], checkpoint: str, interval: str | None = None):
    """Run sink on every micro-batch until what is there is done, or every `interval`."""
    writer = stream.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint)
    return (writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)).start()


def stored(store: Store, table: str, name: str, change: Callable[[DataFrame], DataFrame] = lambda rows: rows) -> Callable[[DataFrame, int], None]:
    """A sink for `consume` that appends each micro-batch of the stream `name` to a table exactly once: one that is run again adds nothing."""
    return lambda rows, batch: (store.append(table, change(rows), batch=(name, batch)), None)[1]


def event_rates(events: DataFrame, window: str = "1 hour", slide: str | None = None, delay: str = "10 minutes") -> DataFrame:
    """events(at, kind, ok): counts and success share by time window; the same plan runs on tables and streams."""
    timed = events.withWatermark("at", delay) if events.isStreaming else events
    return timed.groupBy(F.window("at", window, slide or window).alias("w"), "kind").agg(F.count(F.lit(1)).alias("n"), F.avg(F.col("ok").cast("double")).alias("success_share")).select(F.col("w.start").alias("start"), "kind", "n", "success_share")
