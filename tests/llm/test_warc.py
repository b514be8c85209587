import hashlib
import random

import loomline.llm.warc as module
from loomline.llm.warc import LoserTree, archive_and_index, with_global_rank

SCHEMA = "page_id long, url string, html string, first long, n int"


def test_loser_tree_merges_any_number_of_runs():
    rng = random.Random(1)
    for k in (0, 1, 2, 3, 5, 8, 13):
        runs = [sorted(rng.randrange(20) for _ in range(rng.randrange(6))) for _ in range(k)]
        assert list(LoserTree([iter([(x, i) for x in r]) for i, r in enumerate(runs)])) == sorted((x, i) for i, r in enumerate(runs) for x in r)


def brute(rows):
    out = []
    for page_id, _, html, *_ in rows:
        raw = (html or "").encode()
        same = [r[0] for r in rows if (r[2] or "") == (html or "") and r[0] is not None]
        first = min(same) if same and len(raw) >= 100 else None
        revisit = first is not None and first != page_id
        out.append((page_id, len(raw), hashlib.sha256(raw).hexdigest(), "revisit" if revisit else "response", first if revisit else None))
    return sorted(out, key=str)


def test_round_trip(spark):
    big, odd = "é" * 60, "WARC/1.1\r\nX: 1\r\n\r\n" * 8
    rows = [
        (5, "http://b.example.com/x?q=1#f", big, 1, 1), (3, "https://user:p@A.example.com:80/y", big, 1, 1), (9, None, big, 1, 1), (None, "http://a.example.com/", big, 1, 1),
        (4, "no url\r\nInjected: x", odd, 1, 1), (6, "http://a.example.com/", odd, 1, 1), (7, "http://a.example.com/", None, 1, 1), (8, "", "short", 1, 1), (2, "", "short", 1, 1),
        (3, "https://user:p@A.example.com:80/y", big, 1, 1), (10, "http://z.example.org", "z" * 3_000_000, 1, 1), (None, None, None, None, None),
        (11, " http://x.org/a ", "a", 1, 1), (12, "\u00a0no url\u00a0\t", "b", 1, 1), (13, "\r", "c", 1, 1), (13, "\r", "c", 1, 1),
    ]
    got = archive_and_index(spark.createDataFrame(rows, SCHEMA).repartition(3)).collect()
    assert sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got), key=str) == brute(rows)
    order = [(r.url_key, r.captured, -1 if r.page_id is None else r.page_id) for r in sorted(got, key=lambda r: (r.merge_partition, r.merge_rank))]
    assert order == sorted(order)
    assert {r.url_key for r in got if r.page_id == 3} == {"com,example,a)/y"}
    assert {r.page_id: r.url_key for r in got if (r.page_id or 0) > 10} == {11: " http://x.org/a ", 12: "\u00a0no url\u00a0\t", 13: "%0D"}


def test_ranks_are_global(spark, monkeypatch):
    monkeypatch.setattr(module, "ENTRIES_PER_TASK", 7)
    rows = [(i, f"http://h{i % 13}.org/{i % 3}", "x" * i, 0, 0) for i in range(100)] + [(5, "http://h5.org/2", "x" * 5, 0, 0)] * 2
    for bound in (1000, 0):
        monkeypatch.setattr(module, "BROADCAST_ROWS", bound)
        got = with_global_rank(archive_and_index(spark.createDataFrame(rows, SCHEMA).repartition(3))).collect()
        assert len({r.merge_partition for r in got}) > 5 and sorted(r.capture_rank for r in got) == list(range(102))
        keys = [(r.url_key, r.captured, r.page_id) for r in sorted(got, key=lambda r: r.capture_rank)]
        assert keys == sorted(keys)


def test_empty(spark):
    assert archive_and_index(spark.createDataFrame([], SCHEMA)).count() == 0
