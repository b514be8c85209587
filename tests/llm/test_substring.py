import hashlib
import random
import re
from collections import Counter

import numpy as np

import loomline.llm.packing as packing
from loomline.llm.substring import least_of, remove_repeats


def brute(rows, k):
    words = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t, *_ in rows]
    seen = Counter(tuple(w[i : i + k]) for w in words for i in range(len(w) - k + 1))
    out = []
    for (doc_id, *_), w in zip(rows, words):
        gone = {i + j for i in range(len(w) - k + 1) if seen[tuple(w[i : i + k])] > 1 for j in range(k)}
        text = " ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((doc_id, len(w), len(gone), hashlib.sha256(text.encode()).hexdigest(), text))
    return sorted(out, key=str)


def test_least_of():
    rng = np.random.default_rng(0)
    v = rng.integers(0, 6, 50).astype(np.uint64)
    for span in (1, 2, 3, 5, 18):
        assert least_of(v, span).tolist() == [i + int(np.argmin(v[i : i + span])) for i in range(50 - span + 1)]


def check(spark, rows, k, parts=3):
    df = spark.createDataFrame(rows, "doc_id long, text string, places string, owner int").repartition(parts)
    got = remove_repeats(df, k, with_text=True).collect()
    assert sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_sha256, r.kept_text) for r in got), key=str) == brute(rows, k)
    for r in got:
        assert sum(x.stop - x.start for x in r.removed) == r.n_removed
        assert all(a.stop < b.start for a, b in zip(r.removed, r.removed[1:]))


def test_equals_brute_force(spark):
    rng = random.Random(4)
    for k, vocabulary in ((5, 3), (6, 30), (35, 400)):
        vocab = [f"w{i}é" for i in range(vocabulary)]
        passage = [rng.choice(vocab) for _ in range(k + 9)]
        rows = []
        for i in range(60):
            text = [rng.choice(vocab) for _ in range(rng.randrange(4 * k))]
            if i % 4 == 0:
                at = rng.randrange(len(text) + 1)
                cut = rng.randrange(10)
                text[at:at] = passage[cut : cut + k + rng.randrange(-1, 3)]
            rows.append((i, rng.choice([" ", "\n", "\t "]).join(text), "x", 1))
        rows += [(60, rows[3][1], "x", 1), (3, rows[3][1], "x", 1), (None, rows[8][1] + " tail", None, None), (61, None, None, 1), (62, " ", "", 1), (63, "a " * 5000, "", 1)]
        check(spark, rows, k)


def test_bounded_fan_out(spark, monkeypatch):
    monkeypatch.setattr(packing, "FAN_OUT", 2)
    rng = random.Random(9)
    vocab = [f"w{i}" for i in range(40)]
    passage = [rng.choice(vocab) for _ in range(14)]
    rows = [(i, " ".join([rng.choice(vocab) for _ in range(rng.randrange(30))] + passage * (i % 3 == 0)), "x", 1) for i in range(50)] + [(7, "a " * 30, "x", 1)] * 2
    check(spark, rows, 6, 5)
    assert packing.coarse(10) == 2


def test_empty(spark):
    assert remove_repeats(spark.createDataFrame([], "doc_id long, text string")).count() == 0
