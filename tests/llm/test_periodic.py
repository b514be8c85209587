import hashlib
import re
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from loomline.llm import periodic
from loomline.llm.periodic import autocorrelation, collapse, found_runs, lag_counts, op12_periodic_runs, periodic_runs, repeated

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_runs(words, least=12):
    """By definition: every period, every maximal stretch, smallest period only."""
    out, n = {}, len(words)
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j > i and j - i + q >= max(least, 2 * q):
                out.setdefault((i, j - i + q), q)
            i = max(j, i + 1)
    return sorted(((s, length, q) for (s, length), q in out.items()), key=lambda x: (x[0], x[2]))


def runs_of(texts, least=12):
    codes = {}
    flat = np.array([codes.setdefault(w, len(codes)) for t in texts for w in t], np.int64)
    found = found_runs(flat, np.cumsum([0, *map(len, texts)]), least)
    return [found.get(r, []) for r in range(len(texts))]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.sampled_from("aab"), max_size=60), max_size=4))
def test_runs_of_few_words(texts):
    assert runs_of(texts) == [plain_runs(t) for t in texts]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.lists(st.sampled_from("abcd"), min_size=1, max_size=9), st.integers(1, 12)), max_size=8), st.integers(2, 14))
def test_runs_of_repeated_pieces(parts, least):
    text = [w for part, n in parts for w in part * n]
    assert runs_of([text], least) == [plain_runs(text, least)]


@pytest.mark.parametrize("heavy", [1, 4, 10**9])
def test_counts_do_not_depend_on_what_is_heavy(heavy, monkeypatch):
    rng = np.random.default_rng(3)
    texts = [rng.integers(0, k, n) for k, n in ((2, 500), (40, 300), (1, 77), (3, 0), (9, 1), (5, 13))]
    codes, first = np.concatenate(texts), np.cumsum([0, *map(len, texts)])
    monkeypatch.setattr(periodic, "HEAVY", heavy)
    counts = lag_counts(codes, first)
    for t, a in zip(texts, first):
        assert [int(counts[a + q]) for q in range(1, len(t) // 2 + 1)] == [int((t[q:] == t[:-q]).sum()) for q in range(1, len(t) // 2 + 1)]


@pytest.mark.parametrize("block", [7, 16, 100, 1000])
def test_transform_in_blocks(block):
    t = np.random.default_rng(5).integers(0, 3, 300)
    got = autocorrelation([np.flatnonzero(t == 0), np.flatnonzero(t == 2)], 300, 150, block)
    want = [int(((t[q:] == t[: 300 - q]) & (t[q:] != 1)).sum()) for q in range(1, 151)]
    assert got[1:].tolist() == want


def test_one_word_costs_one_scan(monkeypatch):
    calls, real = [], periodic.islands
    monkeypatch.setattr(periodic, "islands", lambda *a: calls.append(a[1]) or real(*a))
    assert runs_of([["a"] * 50_000]) == [[(0, 50_000, 1)]]
    assert calls == [1]


def bent(key, words):
    h = zlib.crc32(str(key).encode())
    g, n = h // 10, len(words)
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def expected(key, text):
    words = WORD.findall(text or "")
    words = words if key is None else bent(key, words)
    runs = plain_runs(words)
    drop = {i for s, n, q in runs for i in range(s + q, s + n)}
    best = max(runs, key=lambda r: (r[1], -r[0], -r[2])) if runs else (None, None, None)
    digest = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return (
        key, len(words), len(runs), *best, 1000 * best[1] // best[2] if runs else None,
        digest("".join(f"{s},{n},{q}\n" for s, n, q in runs)), digest(" ".join(w for i, w in enumerate(words) if i not in drop)),
    )


def test_query_against_brute_force(spark, tmp_path):
    words = ["na"] * 40 + ["x", "y", "z"] * 9 + ["end"]
    texts = ["", None, " \n\t ", " ".join(words), "one", " ".join(f"w{i % 17}" for i in range(400)), "Ähm\x0bähm x " * 30, "a b " * 6, "a b " * 5 + "a", " lead  " + "q " * 12]
    rows = [(i, texts[i % len(texts)], "de", i) for i in range(300)] + [(None, texts[3], "de", 1), (7, texts[3], "de", 1), (7, texts[3], "de", 1)]
    spark.createDataFrame(rows, "doc_id long, text string, runs string, period long").write.parquet(f"{tmp_path}/documents.parquet")
    got = [tuple(r) for r in op12_periodic_runs(spark, str(tmp_path)).collect()]
    key = lambda r: (r[0] is None, r[0] or 0, r[7])
    assert sorted(got, key=key) == sorted((expected(r[0], r[1]) for r in rows), key=key)


def test_documents_of_the_smallest_tables(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = {tuple(r) for r in op12_periodic_runs(spark, "/root/testdata/sf0.001").collect()}
    few = docs.where("length(text) < 6000").select("doc_id", "text").collect()
    assert got >= {expected(r.doc_id, r.text) for r in few} and len(few) > 100


def test_collapsing_keeps_other_texts_and_columns(spark):
    rows = [(1, "x", "a b " * 9 + "tail"), (2, None, None), (3, "", "  kept \n as  is"), (4, "y", "")]
    docs = spark.createDataFrame(rows, "collapsed int, period string, text string")
    assert sorted(map(tuple, collapse(docs).collect())) == [(1, "x", "a b tail"), (2, None, None), (3, "", "  kept \n as  is"), (4, "y", "")]
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert collapse(empty).count() == 0 and periodic_runs(repeated(empty)).count() == 0
