import json

from loomline.cli import main
from loomline.sources.store import Store
from pyspark.sql import functions as F


def test_commands(spark, tmp_path):
    root = f"file://{tmp_path}/w"
    (tmp_path / "maps.json").write_text(json.dumps({"url": "s", "xml": "<urlset><url><loc>http://h/a</loc></url><url><loc>http://h/b</loc></url></urlset>"}) + "\n")
    run = lambda *a: main([root, *a], spark)
    assert run("discover", str(tmp_path / "maps.json")) == 2 and run("discover", str(tmp_path / "maps.json")) == 0
    store = Store(spark, root)
    same = spark.createDataFrame([("1", "http://h/a", "Cats", "Cats sit on mats."), ("2", "http://h/b", "Dogs", "Dogs run."), ("3", "http://h/c", "Dogs", "Dogs run.")], "id string, url string, title string, content string").withColumns({"content_hash": F.md5("content"), "created_at": F.lit("2024-01-01").cast("timestamp")})
    store.append("articles", same)
    assert run("embed") == 3 and run("embed") == 0
    assert [r.article_title for r in run("search", "cats sit on")] == ["Cats"]
    assert run("dedup") == {"deleted_articles": 1, "deleted_chunks": 1}
    assert {r.table_name: r.row_count for r in run("stats").collect()}["articles"] == 2
    store.write("discovered_urls", store.read("discovered_urls").withColumn("crawl_status", F.lit("error")))
    run("reset-pending")
    assert run("pending").count() == 2 and run("integrity").count() == 4 and run("progress").count() == 1 and run("errors").count() == 0 and run("domains").count() == 1
    run("clear")
    assert store.count("articles") == 0


def make_client():
    """A client without network: pages /a and /b, no others."""

    def get(url):
        if url.endswith(("/a", "/b")):
            return {"content": f"<title>{url[-1]}</title> words of {url[-1]}"}
        raise ConnectionError("no host")

    return get


def test_crawl_and_auto(spark, tmp_path):
    root = f"file://{tmp_path}/w"
    store = Store(spark, root)
    locs = "".join(f"<url><loc>http://h/{n}</loc></url>" for n in "abc")
    (tmp_path / "maps.json").write_text(json.dumps({"url": "s", "xml": f"<urlset>{locs}</urlset>"}) + "\n")
    assert all(main([root, "rebuild"], spark).values())
    done = main([root, "auto", str(tmp_path / "maps.json"), "--client", "tests.test_cli:make_client", "--batch", "2"], spark)
    assert done == {"discovered": 3, "crawled": 3, "chunks": 2}
    states = {r.url: (r.crawl_status, r.crawl_attempts, r.error_message) for r in store.read("discovered_urls").collect()}
    assert states == {"http://h/a": ("completed", 1, None), "http://h/b": ("completed", 1, None), "http://h/c": ("error", 1, "no host")}
    assert sorted(r.title for r in store.read("articles").collect()) == ["a", "b"] and store.count("raw_pages") == 2
    assert main([root, "crawl", "--client", "tests.test_cli:make_client"], spark) == 0


def test_events(spark, tmp_path):
    import logging

    import pytest
    from loomline.operators.warehouse import errors_by_type
    from loomline.sources import events
    from loomline.streaming.control import retry_stats

    log = events.json_log(str(tmp_path / "events.jsonl"), "loomline.test_events")
    events.emit(log, "request", url="http://h/ü", status=200, duration=0.5, ok=True)
    events.emit(log, "retry", func="get", attempt=0, outcome="retry", delay=1.0)
    events.emit(log, "error", "it broke", logging.ERROR, error_type="timeout")
    try:
        raise OSError("disk")
    except OSError:
        log.exception("plain")
    with pytest.raises(ValueError, match="nothing"):
        events.emit(log, "request", nothing=1)
    for handler in log.handlers:
        handler.close()
    with (tmp_path / "events.jsonl").open("a") as f:
        f.write("half a li")
    found = events.read(spark, str(tmp_path / "events.jsonl"))
    assert [(r.url, r.status, r.duration, r.ok) for r in events.requests(found).collect()] == [("http://h/ü", 200, 0.5, True)]
    assert [r.total_retries for r in retry_stats(events.outcomes(found)).collect()] == [1]
    assert [r.broken for r in found.collect() if r.broken] == ["half a li"]
    assert sum("OSError" in (r.exception or "") for r in found.collect()) == 1
    assert "timeout" in str(errors_by_type(found.where("kind = 'error'"), "error_type").collect())
