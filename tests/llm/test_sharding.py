import zlib
from collections import defaultdict

import numpy as np

import loomline.llm.sharding as module
from loomline.llm.sharding import assign_shards, jump_hash, op5_jump_hash_sharding
from loomline.llm.textkernel import mix64


def plain_jump(key, n):
    b, j = -1, 0
    while j < n:
        b = j
        key = (key * 2862933555777941757 + 1) % 2**64
        j = int((b + 1) * (float(1 << 31) / ((key >> 33) + 1)))
    return b


def test_jump_hash_equals_plain_form_and_moves_only_into_new_shard():
    keys = mix64(np.arange(3000, dtype=np.uint64))
    before = jump_hash(keys, 16)
    assert before.tolist() == [plain_jump(int(k), 16) for k in keys]
    after = jump_hash(keys, 17)
    assert set(after[after != before]) == {16}
    assert abs((after != before).mean() - 1 / 17) < 0.02
    assert np.bincount(before).min() > 140


def test_query_equals_plain_jump_hash(spark):
    out = op5_jump_hash_sharding(spark, "/root/testdata/sf0.01").collect()
    docs = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()}
    assert len(out) == 1000 and {r.doc_id for r in out} == set(docs)
    taken = defaultdict(list)
    for r in out:
        key = int(mix64(np.array([r.doc_id], np.int64).view(np.uint64))[0])
        raw = (docs[r.doc_id] or "").encode()
        assert (r.shard, r.grown_shard, r.size, r.text_crc32) == (plain_jump(key, 16), plain_jump(key, 17), len(raw) + 1, zlib.crc32(raw))
        taken[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in taken.values())


def test_many_copies_are_made_by_many_tasks(spark, monkeypatch):
    monkeypatch.setattr(module, "COPIES", 7)
    rows = [(i % 5, "same") for i in range(600)] + [(9, "x"), (None, None)]
    out = assign_shards(spark.createDataFrame(rows, "doc_id long, text string"))
    got = out.collect()
    assert sorted(str(r.doc_id) for r in got) == sorted(str(i) for i, _ in rows)
    assert sorted((r.shard, r.slot) for r in got) == [(s, n) for s in sorted({r.shard for r in got}) for n in range(sum(r.shard == s for r in got))]
    assert out.select(module.F.spark_partition_id().alias("p"), "doc_id").where("doc_id = 3").select("p").distinct().count() > 1


def test_slots_are_gapless_and_all_rows_kept(spark):
    rows = [(i, f"text {i}", 0, 0) for i in range(500)] + [(7, "text 7", 0, 0)] * 300 + [(None, None, 0, 0), (None, "", 0, 0), (1, None, 0, 0), (2, "é" * 50_000, 0, 0)]
    out = assign_shards(spark.createDataFrame(rows, "doc_id long, text string, shard int, slot int")).collect()
    assert sorted((str(r.doc_id), r.size, r.text_crc32) for r in out) == sorted((str(i), len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t, *_ in rows)
    slots = defaultdict(list)
    for r in out:
        slots[r.shard].append(r.slot)
        assert r.law == "key" and 0 <= r.shard < 16 and r.grown_shard in (r.shard, 16)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_empty(spark):
    assert assign_shards(spark.createDataFrame([], "doc_id long, text string")).count() == 0
