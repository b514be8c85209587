import datetime as dt
import json
import os
import random

import pytest

from loomline.streaming import adaptive as A
from loomline.streaming import queue as Q
from pyspark.sql import functions as F

T0 = dt.datetime(2024, 1, 1)
RESPONSE = "host string, at timestamp, seconds double, ok boolean"
EVENT = "url_id string, status string, error string, at timestamp"


@pytest.fixture
def states(spark):
    A.needed(spark)
    yield
    spark.conf.unset(A.PROVIDER[0])


def put(folder, i, rows):
    path = folder / f"{i:03d}.json"
    path.write_text("".join(json.dumps(r, default=lambda t: t.isoformat()) + "\n" for r in rows))
    os.utime(path, (1_700_000_000 + i, 1_700_000_000 + i))  # files are read in the order of their times


def files(folder, batches):
    folder.mkdir()
    for i, rows in enumerate(batches):
        put(folder, i, rows)


def ran(spark, folder, schema, made, out, checkpoint):
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).json(str(folder))
    # rows are kept by batch, so that a batch that runs again is not counted twice
    sink = lambda df, batch: df.withColumn("batch", F.lit(batch)).write.mode("overwrite").parquet(f"{out}/{batch}")
    Q.consume(made(stream), sink, str(checkpoint)).awaitTermination()
    return spark.read.parquet(f"{out}/*").orderBy("batch").collect()


def at(seconds):
    return T0 + dt.timedelta(seconds=seconds)


def test_rates_of_stream_and_batch_are_equal_also_after_a_restart(spark, states, tmp_path):
    rng, log = random.Random(2), []
    for i in range(240):
        host = rng.choice(["a", "b", "slow", "bad"])
        log.append({"host": host, "at": at(i * 2), "seconds": 7.0 if host == "slow" else rng.random() * 2, "ok": host != "bad" or rng.random() < 0.5})
    parts = [log[i : i + 60] for i in range(0, 240, 60)]
    files(tmp_path / "in", parts[:2])
    ran(spark, tmp_path / "in", RESPONSE, A.adaptive_limits, tmp_path / "out", tmp_path / "ck")
    for i in (2, 3):  # state is taken up where the first run ended
        put(tmp_path / "in", i, parts[i])
    rows = ran(spark, tmp_path / "in", RESPONSE, A.adaptive_limits, tmp_path / "out", tmp_path / "ck")
    last = {}
    for r in rows:
        last[r.host] = max(last.get(r.host, r), r, key=lambda x: (x.requests, x.batch, -x.at))
    frame = spark.createDataFrame([(r["host"], r["at"], r["seconds"], r["ok"]) for r in log], RESPONSE)
    want = {r.host: r for r in A.limits_of(frame).collect()}
    assert {h: tuple(r)[1:9] for h, r in last.items()} == {h: tuple(r)[1:9] for h, r in want.items()}
    assert want["slow"].rate < 1 and want["bad"].rate < 1 and want["bad"].failures > 0 and want["a"].errors == 0
    shown = {r.host: r for r in A.penalties(A.limits_of(frame)).collect()}
    assert set(shown) == {h for h, r in want.items() if r.in_penalty} and all(r.penalty_left > 0 for r in shown.values())
    assert A.limits_of(frame.limit(0)).count() == 0


def test_a_slow_response_lowers_the_rate():
    state, recent = A.adapted(A.START | {"rate": 10.0}, [], 0.0, 6.0, True)
    assert state["rate"] == 8.0
    state, recent = A.adapted(dict(A.START), [], 0.0, 0.1, False)
    assert state["failures"] == 1 and state["penalty_until"] == 60.0
    state, recent = A.adapted(state, recent, 400.0, 3.0, True)
    assert recent == [(400.0, 3.0)] and state["failures"] == 0


def test_a_penalty_lapses_by_a_timer(spark, states, tmp_path):
    files(tmp_path / "in", [[{"host": "h", "at": at(0), "seconds": 2.0, "ok": False}], [{"host": "other", "at": at(1000), "seconds": 2.0, "ok": True}], [{"host": "other", "at": at(1001), "seconds": 2.0, "ok": True}]])
    rows = [r for r in ran(spark, tmp_path / "in", RESPONSE, A.adaptive_limits, tmp_path / "out", tmp_path / "ck") if r.host == "h"]
    assert [(r.in_penalty, r.failures) for r in rows] == [(True, 1), (False, 1)]


def test_a_crawl_that_never_ends_goes_back(spark, states, tmp_path):
    event = lambda url, status, seconds, error=None: {"url_id": url, "status": status, "error": error, "at": at(seconds)}
    files(tmp_path / "in", [
        [event("1", "crawling", 0), event("2", "completed", 5), event("2", "crawling", 1), event("3", "crawling", 2)], [event("3", "error", 8, "HTTP 500")],
        [event("9", "pending", 5000)], [event("9", "pending", 5001)], [event("1", "crawling", 5002), event("1", "completed", 5003)],
    ])
    rows = ran(spark, tmp_path / "in", EVENT, A.crawl_states, tmp_path / "out", tmp_path / "ck")
    seen = lambda url: [(r.crawl_status, r.crawl_attempts, r.error_message) for r in rows if r.url_id == url]
    assert seen("1") == [("crawling", 1, None), ("pending", 1, None), ("completed", 2, None)]
    assert seen("2") == [("completed", 1, None)] and seen("3") == [("crawling", 1, None), ("error", 1, "HTTP 500")]
