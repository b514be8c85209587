import json
import os

import crawl_stub
import pytest

from loomline.sources import http
from loomline.streaming.queue import consume

OPTIONS = {"transport": "crawl_stub:client", "sleep": "crawl_stub:sleep", "retries": "3", "base": "1"}


@pytest.fixture
def stub(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(crawl_stub, "FOLDER", str(tmp_path / "stub"))
    (tmp_path / "stub").mkdir()
    before = dict(spark.sparkContext.environment)
    paths = [os.path.dirname(os.path.abspath(__file__)), os.path.dirname(os.path.dirname(os.path.abspath(__file__)))]
    spark.sparkContext.environment.update(CRAWL_STUB=str(tmp_path / "stub"), PYTHONPATH=os.pathsep.join(paths))
    monkeypatch.setenv("CRAWL_STUB", str(tmp_path / "stub"))
    monkeypatch.setenv("PYTHONPATH", os.pathsep.join(paths))
    spark.dataSource.register(http.CrawlSource)
    yield tmp_path / "stub"
    spark.sparkContext.environment.clear()
    spark.sparkContext.environment.update(before)


def test_batch(spark, stub):
    urls = [f"http://{h}.example/{p}" for h, p in [("a", "ok"), ("a", "busy"), ("b", "down"), ("b", "flaky"), ("c", "slow"), ("c", "gone"), ("c", "odd"), ("c", "cut")]]
    df = spark.read.format("crawl").options(**OPTIONS, urls=json.dumps(urls), pause="2").load()
    assert df.rdd.getNumPartitions() == 3  # a host each
    got = {r.url.rsplit("/", 1)[1]: (r.status, r.error, r.attempts, r.content) for r in df.collect()}
    page = lambda name: f"<title>{name}</title>"
    assert got == {
        "ok": (200, None, 1, page("ok")), "busy": (200, None, 3, page("busy")), "down": (503, "HTTP 503", 4, None), "flaky": (200, None, 2, page("flaky")), "slow": (None, "timeout", 4, None),
        "gone": (404, "HTTP 404", 1, None), "odd": (None, "'odd'", 1, None), "cut": (200, None, 2, page("cut")),
    }
    slept = sorted(float(x) for x in (stub / "slept").read_text().split())
    # five pauses; busy waits for Retry-After; the others by policy (server errors half as long again)
    assert slept == sorted([2.0] * 5 + [7.0, 7.0] + [1.5, 3.0, 6.0] + [1.5] + [1.0, 2.0, 4.0] + [1.0])
    assert spark.read.format("crawl").options(**OPTIONS, urls="[]").load().count() == 0


def test_stream_goes_on_from_its_offset(spark, stub, tmp_path):
    def run(size):
        (stub / "size").write_text(str(size))
        stream = spark.readStream.format("crawl").options(**OPTIONS, feed="crawl_stub:feed", most="4").load()
        sink = lambda df, batch: df.select("url", "status").write.mode("overwrite").parquet(str(tmp_path / f"out/{batch}"))
        query = consume(stream, sink, str(tmp_path / "ck"), "0 seconds")
        try:
            query.processAllAvailable()
        finally:
            query.stop()
        return sorted(int(r.url.rsplit("p", 1)[1]) for r in spark.read.parquet(str(tmp_path / "out/*")).collect())

    assert run(6) == list(range(6))
    assert run(13) == list(range(13))  # nothing twice, nothing left out
    assert run(14) == list(range(14))
    assert run(14) == list(range(14)) and run(40) == list(range(40))
    assert all(os.path.getsize(stub / f"http:__h{i % 3}.example_p{i}") == 1 for i in range(40))
