import json
import os
import time

import numpy as np
import pytest

from loomline.operators import mutations as M
from loomline.operators import warehouse as W
from loomline.plans.retrieval import answer, chunk_and_embed, lsh_index, lsh_search
from loomline.schemas import TABLES, model, violations
from loomline.sources.store import Conflict, Store, function_exists, load_config, query, run_script, save_report, split_script, table_exists
from loomline.streaming import control as C
from loomline.streaming import queue as Q
from pyspark.sql import functions as F


def test_store(spark, tmp_path):
    store = Store(spark, f"file://{tmp_path}/w")
    assert store.count("articles") == -1 and store.read("articles").count() == 0
    rows = spark.createDataFrame([("1", "http://a"), ("2", "http://b")], "id string, url string")
    assert store.append("articles", M.insert_new(store.read("articles"), rows)) == 2
    assert store.append("articles", M.insert_new(store.read("articles"), rows)) == 0
    assert store.count("articles") == 2 and store.size("articles") > 0 and store.read("articles").columns == TABLES["articles"].names
    for i in range(3):
        store.write("articles", store.read("articles").withColumn("title", F.lit(str(i))))
    assert [r.title for r in store.read("articles").collect()] == ["2", "2"]
    store.views()
    assert table_exists(spark, "articles") and not table_exists(spark, "nothing") and function_exists(spark, "md5")
    assert query(spark, "SELECT id FROM articles WHERE url = :u", u="http://b") == [{"id": "2"}]
    store.clear()
    assert store.count("articles") == 0


def test_scripts_and_files(spark, tmp_path):
    script = "-- c;\nSELECT ';' AS a; /* x; */ SELECT $$ ; $$; SELECT 2 -- end\n;;"
    assert split_script(script) == ["SELECT ';' AS a", "SELECT $$ ; $$", "SELECT 2"]
    done, failed, errors = run_script(spark, "SELECT 1; SELEC 2; SELECT 3")
    assert (done, failed) == (2, 1) and errors[0].startswith("SELEC 2")
    save_report(str(tmp_path / "r"), {"tables": 4}, "Health")
    assert json.loads((tmp_path / "r.json").read_text()) == {"tables": 4} and "| tables | 4 |" in (tmp_path / "r.md").read_text()
    (tmp_path / ".env").write_text("# c\nA=1\nB='two'\nbad\n")
    assert load_config(str(tmp_path / ".env"), {"A": "9", "Z": "0"}) == {"A": "9", "B": "two"}


def test_models(spark):
    chunk = spark.createDataFrame([("1", "a", "x", 0, [0.0] * 4), ("2", None, "", -1, [0.0])], "id string, article_id string, content string, chunk_index int, embedding array<float>")
    assert {(r.id, r.violation) for r in violations(chunk, "article_chunks", dimensions=4).collect()} == {("2", v) for v in ("article_id is missing", "content is empty", "chunk_index is negative", "embedding has another dimension")}
    assert model("Chunk") == TABLES["article_chunks"]


def test_mutations(spark):
    urls = spark.createDataFrame([("1", "crawling", 1, "m"), ("2", "error", 3, "m"), ("3", None, 0, None)], "id string, crawl_status string, crawl_attempts int, error_message string")
    assert {r.id: r.crawl_status for r in M.requeue_failed(urls, 3).collect()} == {"1": "crawling", "2": "error", "3": None}
    assert {r.id: (r.crawl_status, r.error_message) for r in M.reset_pending(urls).collect()} == {"1": ("crawling", "m"), "2": ("pending", None), "3": ("pending", None)}
    articles = spark.createDataFrame([("a", "1"), ("b", "2"), ("c", None)], "id string, crawled_from_url_id string")
    left, kept = M.delete_urls(urls, articles, spark.createDataFrame([("1",)], "id string"))
    assert left.count() == 2 and {r.id: r.crawled_from_url_id for r in kept.collect()} == {"a": None, "b": "2", "c": None}
    made = M.embedding_rows(spark.createDataFrame([("u", ["x", "y"], [[1.0], [2.0]]), ("v", ["x"], [[1.0], [2.0]]), ("w", ["x"], [None])], "url_id string, texts array<string>, embeddings array<array<float>>"))
    assert [(r.url_id, r.chunk_index, r.content) for r in made.collect()] == [("u", 0, "x"), ("u", 1, "y")]
    page = spark.createDataFrame([("7", "http://h/x", "<title>T</title>b", "2024-01-01")], "url_id string, url string, html string, created_at string")
    row = M.articles_from_pages(page, F.lit("T"), F.col("html")).first()
    assert (row.title, row.word_count, row.crawled_from_url_id) == ("T", 1, "7")


def test_appends_add_files_and_writers_do_not_lose_each_other(spark, tmp_path):
    one, two = (Store(spark, f"file://{tmp_path}/w") for _ in range(2))
    rows = lambda *ids: spark.createDataFrame([(i, f"http://{i}") for i in ids], "id string, url string")
    one.write("articles", rows("a"))
    before = {p.name for p in (tmp_path / "w" / "articles").glob("data-*")}
    assert two.append("articles", rows("b")) == 1 and before < {p.name for p in (tmp_path / "w" / "articles").glob("data-*")}
    with pytest.raises(Conflict):  # two's row came after what `one` last knew
        one.write("articles", rows("z"))
    assert sorted(r.id for r in one.read("articles").collect()) == ["a", "b"]
    assert two.append("articles", rows("c")) == 1
    stale = one.read("articles")
    assert one.append("articles", rows("x")) == 1
    with pytest.raises(Conflict):  # its own append too
        one.write("articles", stale)
    one.update("articles", lambda t: t.where("id <> 'x'"))
    seen = []

    def meanwhile(t):
        if not seen:
            seen.append(two.append("articles", rows("d")))
        return t

    one.update("articles", meanwhile)  # goes round once more
    assert sorted(r.id for r in one.read("articles").collect()) == ["a", "b", "c", "d"]
    one.compact("articles")
    assert one.count("articles") == 4 and len(one._newest("articles")[1]["folders"]) == 1
    number = one._newest("articles")[0] + 1
    assert one._claim("articles", number) and not two._claim("articles", number)  # a writer between its claim and its manifest
    two.patience = 0.2
    for attempt in (lambda: two.append("articles", rows("e")), lambda: two.write("articles", rows("e"))):
        with pytest.raises(Conflict):
            attempt()
    assert one.count("articles") == 4
    two.recover("articles")
    two.read("articles")
    assert two.append("articles", rows("e")) == 1
    one.update("articles", lambda t: t.where("id <> 'e'"))
    sizes = W.table_sizes({"articles": one.size("articles")}, articles=one.read("articles"), none=rows()).collect()
    assert [(r.table_name, r.row_count, r.size_bytes > 0) for r in sizes] == [("articles", 4, True), ("none", 0, False)]


def test_repeated_updates_and_victims(spark):
    urls = spark.createDataFrame([("1", "pending", 0, None, None, None), ("2", "pending", 1, None, None, "old")], "id string, crawl_status string, crawl_attempts int, last_crawl_at timestamp, updated_at timestamp, error_message string")
    updates = spark.createDataFrame([("1", "crawling", None, 1), ("1", "completed", None, 2), ("2", "error", "x", 2), ("2", "error", "", 3), ("2", "crawling", None, 1), ("9", "error", "y", 1)], "url_id string, status string, error string, seq int")
    got = {r.id: r for r in M.apply_transitions(urls, updates, F.expr("timestamp'2024-02-01 00:00:00'")).collect()}
    assert {i: (r.crawl_status, r.crawl_attempts, r.error_message, r.last_crawl_at is not None) for i, r in got.items()} == {"1": ("completed", 1, None, True), "2": ("error", 2, "x", True)}
    assert M.applied_updates(urls, updates).first().asDict() == {"updates": 6, "applied": 5}
    articles = spark.createDataFrame([("a", "1"), ("b", "2")], "id string, crawled_from_url_id string")
    left, kept = M.delete_urls(urls, articles, spark.createDataFrame([("1",), ("1",)], "id string"))
    assert left.count() == 1 and sorted((r.id, r.crawled_from_url_id) for r in kept.collect()) == [("a", None), ("b", "2")]


def test_retrieval(spark):
    articles = spark.createDataFrame([(1, "http://a", "A", "Cats sit on mats."), (2, "http://b", "B", "Dogs run in parks."), (3, "http://c", "C", None)], "id int, url string, title string, content string")
    chunks = chunk_and_embed(articles, "sentence", dimensions=64)
    got = answer("cats sit", chunks, articles, lambda prompt: prompt.splitlines()[1], 64, limit=1)
    assert got == {"answer": "Cats sit on mats.", "sources": ["http://a"]}
    with pytest.raises(LookupError):
        answer("x", chunks.limit(0), articles, str, 64)


def test_lsh_recall(spark):
    e = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet").select(F.col("vec_id").alias("id"), "embedding")
    queries = e.where("id % 100 = 0")
    found = {(r.query_id, r.id) for r in lsh_search(lsh_index(e, bits=4, tables=24), queries, 5, bits=4, tables=24).collect()}
    from loomline.functions.vectors import cosine
    from pyspark.sql import Window

    q = queries.select(F.col("id").alias("qid"), F.col("embedding").alias("q"))
    ranked = e.crossJoin(F.broadcast(q)).select("qid", "id", cosine(F.col("embedding"), F.col("q")).alias("s")).withColumn("r", F.row_number().over(Window.partitionBy("qid").orderBy(F.desc("s"), "id"))).where("r <= 5")
    exact = {(r.qid, r.id) for r in ranked.collect()}
    assert len(found & exact) / len(exact) >= 0.9


def test_lsh_pairs_are_no_rows(spark, monkeypatch):
    """The same as comparing all pairs that share a bucket, in cells: copies, multiples, zero, null, NaN and infinite components, repeated ids."""
    from loomline.functions.vectors import cosine
    from loomline.plans import retrieval
    from pyspark.sql import Window

    monkeypatch.setattr(retrieval, "ROWS", 100)
    monkeypatch.setattr(retrieval, "QUERIES", 7)
    rng = np.random.default_rng(3)
    vectors = [[float(x) for x in v] for v in np.round(rng.normal(size=(1500, 8)), 2).astype(np.float32)]
    for i in range(0, 1500, 3):
        vectors[i] = vectors[i % 30]
    for i in range(1, 200, 20):
        vectors[i] = [x * (i + 2) for x in vectors[0]]
    vectors[4], vectors[5], vectors[7], vectors[8], vectors[10], vectors[11] = [0.0] * 8, [None, *vectors[5][1:]], [float("nan")] * 8, None, [1.0], [float("inf"), *vectors[11][1:]]
    rows = [(i, v) for i, v in enumerate(vectors)] + [(3, vectors[3]), (3, vectors[13]), (None, vectors[3])]
    e = spark.createDataFrame(rows, "id long, embedding array<float>").repartition(3)
    queries = e.where("id % 50 = 0 or id between 3 and 11")
    index, q = lsh_index(e, 3, 4, 8), lsh_index(queries, 3, 4, 8)
    made = lsh_search(index, queries, 6, 3, 4, 8)
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Generate posexplode" not in plan
    share = F.exists(F.zip_with("buckets", "mine", lambda x, y: x == y), lambda x: x)
    pairs = index.crossJoin(q.select(F.col("id").alias("query_id"), F.col("embedding").alias("q"), F.col("buckets").alias("mine"))).where(share)
    near = pairs.select("query_id", "id", cosine(F.col("embedding"), F.col("q")).alias("similarity")).distinct()
    want = near.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("similarity"), "id"))).where("rank <= 6")
    got, want = (sorted(map(str, x.collect())) for x in (made, want))
    assert got == want and len(got) > 200
    assert lsh_search(lsh_index(e.limit(0), 3, 4, 8), queries, 6, 3, 4, 8).count() == lsh_search(index, queries.limit(0), 6, 3, 4, 8).count() == 0


def test_token_bucket_and_adaptation():
    one = C.Limiter(C.Rate(per_second=1, burst=1))
    assert one.acquire(0) == 0 and one.acquire(0) >= 0.99
    quick = C.Limiter(C.Rate(per_second=10))
    quick.respond("h", 0, 6.0, True)
    assert quick.rate.per_second < 10
    assert C.Limiter(C.Rate(2.0)).interval("x") == 0.5
    bad = C.Limiter()
    bad.failure("h", 0, severe=True)
    assert bad.acquire(0, "h") == 60 and bad.acquire(400, "h") == 0 and bad.interval("h") == 1.5
    bad.success("h")
    assert bad.interval("h") == 1.0
    big = C.Limiter()
    big.acquire(0, "www.google.com")
    assert big.interval("www.google.com") == 2 and big.current_rate(1) == 1 / 60
    spaced, at = C.Limiter(C.Rate(per_second=2, burst=1)), 0.0
    for _ in range(4):
        while (wait := spaced.acquire(at, "h")) > 0:
            at += wait
    assert at >= 1.5


def test_limit_requests_by_host(spark):
    log = spark.createDataFrame([("a", float(t), t) for t in range(3)] + [("b", 0.0, 9), ("b", 0.1, 10)], "host string, ts double, request_id int")
    got = {r.request_id: round(r.wait, 6) for r in C.limit_requests(log, C.Rate(1.0, 5)).collect()}
    assert got == {0: 0, 1: 0, 2: 0, 9: 0, 10: 0.9}


def test_retry(spark):
    assert [C.retry_delay(n) for n in (0, 1, 2, 9)] == [1, 2, 4, 60] and C.retry_delay(1, policy=C.Retry(strategy="linear")) == 2 and C.retry_delay(5, "rate_limited", C.Retry(strategy="fixed")) == 2
    assert C.retry_delay(0, policy=C.Retry(base=0.01)) == 0.1

    class Http(Exception):
        status_code = 503

    tries, waits, log = [0], [], []

    def call():
        tries[0] += 1
        if tries[0] < 3:
            raise Http
        return "ok"

    assert C.call_with_retry(call, sleep=waits.append, log=log) == "ok" and waits == [1.5, 3.0] and [o for _, o in log] == ["retry", "retry", "success"]
    with pytest.raises(ValueError):
        C.call_with_retry(lambda: (_ for _ in ()).throw(ValueError()), sleep=waits.append)
    stats = C.retry_stats(spark.createDataFrame([("f", o) for _, o in log], "func string, outcome string")).first()
    assert (stats.total_attempts, stats.total_retries, stats.success_count, stats.failure_count) == (3, 2, 1, 0)


def test_streams(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    for n in range(2):
        (source / f"{n}.json").write_text("".join(json.dumps({"url": f"http://h/{i % 3}", "priority": 0.5, "seen_at": f"2024-01-01T00:0{i}:00Z"}) + "\n" for i in range(5)))
    seen = []
    stream = Q.distinct_urls(Q.url_stream(spark, str(source), files_per_batch=1))
    began = time.time()
    Q.consume(stream, lambda df, n: seen.extend(r.url for r in df.collect()), str(tmp_path / "c")).awaitTermination(60)
    assert sorted(seen) == ["http://h/0", "http://h/1", "http://h/2"] and time.time() - began < 60

    events = tmp_path / "events"
    events.mkdir()
    lines = [("u", "crawling", None, 1), ("u", "error", "HTTP 500", 2), ("u", "crawling", None, 3), ("u", "completed", None, 4), ("v", "crawling", None, 1)]
    for n, part in enumerate((lines[:2], lines[2:])):
        (events / f"{n}.json").write_text("".join(json.dumps({"url_id": u, "status": s, "error": e, "at": f"2024-01-01T00:00:0{t}Z"}) + "\n" for u, s, e, t in part))
        os.utime(events / f"{n}.json", (1_700_000_000 + n, 1_700_000_000 + n))  # files are read oldest first
    last = {}
    states = Q.url_states(spark.readStream.schema("url_id string, status string, error string, at timestamp").option("maxFilesPerTrigger", 1).json(str(events)))
    Q_sink = lambda df, n: last.update({r.url_id: (r.crawl_status, r.crawl_attempts, r.error_message) for r in df.collect()})
    states.writeStream.outputMode("update").foreachBatch(Q_sink).option("checkpointLocation", str(tmp_path / "c2")).trigger(availableNow=True).start().awaitTermination(60)
    assert last == {"u": ("completed", 2, "HTTP 500"), "v": ("crawling", 1, None)}


def test_fetch(spark):
    def load():
        def get(url):
            if "bad" in url:
                raise OSError("down")
            return {"success": True, "content": f"<title>{url}</title>"}

        return get

    got = {r.url: (r.success, r.content, r.error) for r in Q.fetch_pages(spark.createDataFrame([("http://a",), ("http://bad",)], "url string"), load).collect()}
    assert got == {"http://a": (True, "<title>http://a</title>", None), "http://bad": (False, None, "down")}


def test_integrity_of_empty_tables(spark):
    empty = {t: spark.createDataFrame([], s) for t, s in TABLES.items()}
    assert {r.status for r in W.data_integrity(empty["discovered_urls"], empty["articles"], empty["article_chunks"]).collect()} == {"OK"}
    progress = W.crawl_progress(empty["discovered_urls"], empty["articles"], empty["article_chunks"]).first()
    assert (progress.total_discovered, progress.avg_chunks_per_article, progress.progress_percentage) == (0, 0.0, 0.0)


def test_cosine_forms_agree(spark):
    from loomline.functions.vectors import cosine, cosine_to, literal

    rows = [(1, [1.0, 2.0]), (2, [0.0, 0.0]), (3, None), (4, [1.0]), (5, [-2.0, 1.0]), (6, [None, 1.0])]
    df = spark.createDataFrame(rows, "id int, e array<float>")
    got = {r.id: (r.a, r.b) for r in df.where("id < 6").select("id", cosine(F.col("e"), literal([2.0, 4.0])).alias("a"), cosine_to(F.col("e"), [2.0, 4.0]).alias("b")).collect()}
    assert got[2] == (0.0, 0.0) and got[3] == (None, None) and got[4] == (None, None)
    assert all(abs(got[i][0] - got[i][1]) < 1e-12 for i in (1, 5)) and abs(got[1][1] - 1) < 1e-12


def test_batches_are_appended_once(spark, tmp_path):
    store = Store(spark, f"file://{tmp_path}/w")
    rows = lambda *ids: spark.createDataFrame([(i, f"http://{i}") for i in ids], "id string, url string")
    assert store.append("articles", rows("a"), batch=("q", 0)) == 1 and store.append("articles", rows("a"), batch=("q", 0)) == 0
    assert store.append("articles", rows("b"), batch=("other", 0)) == 1
    assert store.append("articles", rows("a").limit(0), batch=("q", 1)) == 0 and store.append("articles", rows("c"), batch=("q", 1)) == 0
    store.compact("articles")
    assert store.append("articles", rows("a"), batch=("q", 0)) == 0 and store.append("articles", rows("d"), batch=("q", 2)) == 1
    assert sorted(r.id for r in store.read("articles").collect()) == ["a", "b", "d"]


def test_a_stream_that_dies_between_write_and_commit_adds_nothing_twice(spark, tmp_path):
    source, store = tmp_path / "in", Store(spark, f"file://{tmp_path}/w")
    source.mkdir()
    for i in range(3):
        (source / f"{i}.json").write_text("".join(f'{{"url": "http://h/{i}/{j}"}}\n' for j in range(5)))
    sink, died = Q.stored(store, "discovered_urls", "urls", lambda df: df.select(F.md5("url").alias("id"), "url")), []

    def dies(df, batch):
        sink(df, batch)
        if batch == 1 and not died:
            died.append(batch)
            raise RuntimeError("killed after the write, before the commit")

    for _ in range(2):
        stream = Q.consume(Q.url_stream(spark, str(source), files_per_batch=1), dies, str(tmp_path / "ck"))
        try:
            stream.awaitTermination()
        except Exception:  # noqa: BLE001
            assert died
    assert died and store.count("discovered_urls") == 15


def test_counts_come_from_footers(spark, tmp_path):
    from loomline.sources.work import footers

    spark.range(1000).write.parquet(str(tmp_path / "t"))
    rows = footers(spark, str(tmp_path / "t"))
    assert rows.first().row_count == 1000 and "PushedAggregation: [COUNT(*)]" in rows._jdf.queryExecution().executedPlan().toString()
    store = Store(spark, f"file://{tmp_path}/w")
    store.append("articles", spark.createDataFrame([("1", "x")], "id string, content string"))
    assert store.count("articles") == 1 and store.count("sitemaps") == -1


def test_table_functions_on_empty_tables(spark, tmp_path):
    from loomline.plans import table_functions

    empty = {t: spark.createDataFrame([], TABLES[t]) for t in ("articles", "article_chunks", "discovered_urls", "sitemaps")}
    table_functions.register(spark, sizes={"articles": 20_000}, **empty)
    call = lambda f: [tuple(r) for r in spark.sql(f"SELECT * FROM {f}").collect()]
    assert call("get_crawl_progress()") == [(0, 0, 0, 0, 0, 0, 0.0, 0.0)] == [tuple(r) for r in W.crawl_progress(empty["discovered_urls"], empty["articles"], empty["article_chunks"]).collect()]
    assert sorted(call("get_db_stats()")) == [("article_chunks", 0, None), ("articles", 0, "20 kB"), ("discovered_urls", 0, None), ("sitemaps", 0, None)]
    assert call("get_domain_stats()") == call("get_recent_errors(5)") == call("search_similar_content(array(1D))") == []
    assert [r[1:3] for r in call("check_data_integrity()")] == [("OK", 0)] * 4


def test_release_times_of_a_hot_host(spark):
    import random

    rng = random.Random(8)
    rows = [("hot" if i % 3 == 0 else f"h{i % 50}", rng.randrange(3000) * (1 + (i % 7 == 0)), i) for i in range(6000)] + [(None, 5, 1), (None, 5, 2), (None, 9, 3)]
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.createDataFrame(rows, "host string, at long, request_id long").repartition(8)
        got = {(r.host, r.request_id): r.release for r in C.release_times(df, F.when(F.col("host") == "hot", 3).otherwise(20)).collect()}
        ranged = df.repartitionByRange(F.col("host"), F.col("at"), F.col("request_id")).withColumn("p", F.spark_partition_id())
        assert ranged.where("host = 'hot'").select("p").distinct().count() >= 5  # one host, many tasks
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    last, want = {}, {}
    for host, at, i in sorted(rows, key=lambda r: (str(r[0]), r[1], r[2])):
        last[host] = max(at, last[host] + (3 if host == "hot" else 20)) if host in last else at
        want[host, i] = last[host]
    assert got == want


def test_inverted_file(spark, tmp_path):
    from loomline.plans import ivf

    e = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").select(F.col("vec_id").alias("id"), "embedding")
    odd = spark.createDataFrame([(-1, None), (-2, [1.0]), (-3, [0.0] * 64)], "id long, embedding array<float>")
    ivf.build(e.union(odd), str(tmp_path / "i"), 64)
    index = ivf.Index(spark, str(tmp_path / "i"))
    total = e.count()
    assert index.vectors.count() == total
    queries = e.where("id % 100 = 0")
    found = index.search(queries.union(odd)).collect()
    vectors = {r.id: np.array(r.embedding) for r in e.collect()}
    ids, m = list(vectors), np.array(list(vectors.values()))
    hits = compared = 0
    asked = [r.id for r in queries.collect()]
    for q in asked:
        best = {ids[j] for j in np.argsort(-(m @ vectors[q]) / np.linalg.norm(m, axis=1))[:10]}
        mine = [r for r in found if r.query_id == q]
        hits += len(best & {r.id for r in mine})
        compared += mine[0].compared
        assert all(abs(r.similarity - vectors[q] @ vectors[r.id]) < 1e-5 for r in mine) and sorted(r.rank for r in mine) == list(range(1, 11))
    assert hits / len(asked) / 10 >= 0.9 and compared / len(asked) / total < 0.15
    near = index.nearest([float(x) for x in vectors[asked[0]]], probe=3)
    plan = near._jdf.queryExecution().executedPlan().toString()
    assert near.first().id == asked[0] and "PartitionFilters: [cell" in plan.replace("isnotnull(cell#", "cell#") and near.where("id is not null").count() == 10
    read = index.vectors.where(F.col("cell").isin(index.cells_of(np.array([vectors[asked[0]]], np.float32), 3)[0].tolist())).count()
    assert read < total / 2
    ivf.build(odd, str(tmp_path / "none"), 64)
    empty = ivf.Index(spark, str(tmp_path / "none"))
    assert empty.search(queries).count() == 0 and empty.nearest([1.0] * 64).count() == 0
