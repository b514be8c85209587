import math
import random
import re
from collections import Counter

import numpy as np

import loomline.llm.quality as module
from loomline.llm.ngrams import char_grams
from loomline.llm.quality import features, fit, judge, op3_ngram_logistic_quality
from loomline.llm.textkernel import Words


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    grams = Counter(zip(words, words[1:], words[2:]))
    hit = {i + j for i in range(len(words) - 2) if grams[tuple(words[i : i + 3])] > 1 for j in range(3)}
    n, r = len(words), len(hit)
    return (n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), sum(x in lines[:i] for i, x in enumerate(lines)), r, n < 50 or 100 * r > 50 * n)


TEXTS = [None, "", " ", "a", "a b c a b c", "x\nx\n\n \nx ", "é 漢字　b c # * $ % & | < >", "a a a a a", "w " * 49, "w%d " * 3, "line one\nline two\nline one\n" * 30, "\x0b\x0c\r\tq"]


def test_counts_equal_brute_force(spark):
    rng = random.Random(2)
    texts = TEXTS + [" ".join(rng.choice("a b c d e".split()) + rng.choice(["", "\n", "\t"]) for _ in range(rng.randrange(200))) for _ in range(60)] + ["longword " * 60_000]
    rows = [(i, t, 0) for i, t in enumerate(texts)] + [(None, "a b", 0), (3, "a", 0)]
    got = judge(spark.createDataFrame(rows, "doc_id long, text string, kept int"), None).collect()
    want = sorted(((i, *brute(t)) for i, t, _ in rows), key=str)
    assert sorted(((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in got), key=str) == want
    assert all(r.kept == (not r.base_failed) for r in got)


def test_held_out_accuracy_and_calibration(spark):
    docs, labels = spark.read.parquet("/root/testdata/sf0.1/documents.parquet"), spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    model = fit(docs, labels.where("doc_id % 2 = 0"))
    rows = judge(docs, model).join(labels.where("doc_id % 2 = 1"), "doc_id").where("not base_failed").collect()
    y, p = np.array([r.quality for r in rows]), np.array([r.p_good for r in rows])
    assert ((p >= 0.5) == y).mean() > 0.97
    assert ((p >= 0.5) & (y == 1)).sum() / (y == 1).sum() > 0.98
    assert abs(p.mean() - y.mean()) < 0.05


def test_char_grams_are_of_characters():
    texts = ["aé€😀b", "", "äöüß", "abc", "x" * 9]
    raw = [t.encode() for t in texts]
    offsets = np.concatenate(([0], np.cumsum([len(r) for r in raw])))
    row, name = char_grams(np.frombuffer(b"".join(raw), np.uint8), offsets, 4)
    assert np.bincount(row, minlength=5).tolist() == [2, 0, 1, 0, 6]
    alone = [char_grams(np.frombuffer(t[i : i + 4].encode(), np.uint8), np.array([0, len(t[i : i + 4].encode())]), 4)[1][0] for t in texts for i in range(len(t) - 3)]
    assert alone == name.tolist() and len(set(alone)) == 4


def test_verdicts_equal_a_plain_version(spark):
    """Each n-gram looked up by itself, in Python."""
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.001/{t}.parquet") for t in ("documents", "labels"))
    model = fit(docs, labels)
    weights, cache = model.weights.value, {}

    def names(kind, gram):
        if (kind, gram) not in cache:
            raw = gram.encode()
            data, offsets = np.frombuffer(raw, np.uint8), np.array([0, len(raw)])
            found = [x for x in features(data, offsets, Words(data, offsets))][kind][1]
            assert len(found) == 1
            cache[kind, gram] = float(weights[found[0]])
        return cache[kind, gram]

    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in judge(docs, model).collect():
        text = texts[r.doc_id]
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        grams = [words, [f"{a} {b}" for a, b in zip(words, words[1:])], [text[i : i + 4] for i in range(len(text) - 3)]]
        z = sum(sum(names(k, g) for g in found) / max(1, len(found)) for k, found in enumerate(grams))
        p = 1 / (1 + math.exp(-max(-60, min(60, model.slope * z + model.offset))))
        assert abs(p - r.p_good) < 1e-6 and (abs(p - 0.5) < 1e-6 or r.kept == (not r.base_failed and p >= 0.5))


def test_training_takes_all_rows_whatever_their_length(spark, monkeypatch):
    rows = [(i, " ".join(f"{'ab'[i % 2]}{j % 900}" for j in range(3000 if i % 3 == 0 else 60)), i % 2) for i in range(120)]
    docs, labels = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string"), spark.createDataFrame([(r[0], r[2], 0) for r in rows], "doc_id long, quality int, toxic int")
    whole = {r.id: r for r in module.training_rows(docs, labels).collect()}
    monkeypatch.setattr(module, "TEXT_FEATURES", 500)
    some = {r.id: r for r in module.training_rows(docs, labels).collect()}
    assert len(some) == len(whole) == 120 and fit(docs, labels) is not None
    for i, r in some.items():
        name, value = np.frombuffer(r.name, np.uint32), np.frombuffer(r.value, np.float32)
        every, all_values = np.frombuffer(whole[i].name, np.uint32), np.frombuffer(whole[i].value, np.float32)
        order = np.argsort(module.mix64(every.astype(np.uint64)))[:500]
        assert set(name.tolist()) == set(every[order].tolist()) and abs(value.sum() - all_values.sum()) < 1e-3
    monkeypatch.setattr(module, "TEXT_FEATURES", 1)
    assert fit(docs, labels) is not None


def test_no_labels_or_rows(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert fit(docs, none) is None
    assert fit(docs, spark.createDataFrame([(1, 1, 0), (1, None, 0), (None, 0, 0)], none.schema)) is None
    assert judge(docs.limit(0), None).count() == 0


def test_query(spark):
    assert op3_ngram_logistic_quality(spark, "/root/testdata/sf0.001").count() == 200
