import math
import random
import re
from collections import Counter

import numpy as np

from loomline.llm.ngrams import CHUNK, count_tables
from loomline.llm.resample import kth_largest, op10_importance_resampling, resample, selection
from pyspark.sql import functions as F

LABELS = "doc_id long, quality int, toxic int"


def corpus(n=400):
    rng = random.Random(3)
    words = [f"w{i}" for i in range(60)]
    docs, labels, kind = [], [], {}
    for i in range(n):
        text = " ".join(rng.choice(words) for _ in range(rng.randrange(80, 200)))
        kind[i] = "clean" if i % 5 else ("junk", "toxic")[i // 5 % 2]
        if kind[i] == "junk":
            text = " ".join(w + "***" for w in text.split())
        if kind[i] == "toxic":
            text = text.replace("w7 ", "idiot ").replace("w9 ", "moron ") + " idiot moron idiot"
        docs.append((i, text, "x"))
        if i % 3 == 0:
            labels.append((i, int(kind[i] != "junk"), int(kind[i] == "toxic")))
    return docs, labels, kind


def test_rejects_junk_and_toxic_and_keeps_clean(spark):
    docs, labels, kind = corpus()
    rows = resample(spark.createDataFrame(docs, "doc_id long, text string, key string"), spark.createDataFrame(labels, LABELS)).collect()
    got = {r.doc_id for r in rows}
    assert {r.key for r in rows} == {"x"}
    clean = [i for i, k in kind.items() if k == "clean"]
    assert len(got & set(clean)) >= 0.97 * len(clean)
    assert len(got) - len(got & set(clean)) <= 3


def test_edge_rows(spark):
    docs, labels, _ = corpus(100)
    odd = [(None, "w1 w2 w3 w4 " * 30, "a"), (1000, None, "a"), (1001, "  \n ", "a"), (1002, "w1 w2 w5 " * 40_000, "a"), (1, docs[1][1], "a")]
    out = resample(spark.createDataFrame(docs + odd, "doc_id long, text string, quality string"), spark.createDataFrame([*labels, (None, 1, 0), (1, 1, None), (2, None, 0), (2, 1, 0)], LABELS))
    assert out.columns == ["doc_id", "text", "quality"]
    ids = [r.doc_id for r in out.collect()]
    assert 1000 not in ids and 1001 not in ids and ids.count(1) == 2
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert resample(empty, spark.createDataFrame([], LABELS)).count() == 0
    unlabelled = resample(spark.createDataFrame(docs, "doc_id long, text string, x string"), spark.createDataFrame([], LABELS))
    assert unlabelled.count() == len(docs)


def test_share_is_gumbel_top_k(spark):
    docs, labels, _ = corpus(200)
    _, least, keys = selection(spark.createDataFrame(docs, "doc_id long, text string, x string"), spark.createDataFrame(labels, LABELS), 0.25)
    rows = keys.collect()
    assert sum(r.key >= least for r in rows) == 50
    assert sorted((r.key for r in rows), reverse=True)[49] == least
    noise = [r.key - r.log_weight for r in rows]
    assert abs(np.mean(noise) - 0.5772) < 0.35


def test_kth_largest_is_exact(spark):
    rng = random.Random(5)
    values = [rng.gauss(0, 10) for _ in range(500)] + [1.5] * 40 + [-math.inf] * 5 + [1e-300, 2e-300]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    ranked = sorted((v for v in values if v > -math.inf), reverse=True)
    for k in (1, 2, 100, 250, len(ranked)):
        assert kth_largest(df, "v", k) == ranked[k - 1]
    assert kth_largest(df, "v", 0) == math.inf and kth_largest(df, "v", 10_000) == -math.inf


def test_counts_are_whole_over_many_parts(spark):
    docs = spark.createDataFrame([(f"a b c{i % 7}", i % 2 == 0) for i in range(300)], "text string, good boolean")
    one = count_tables(docs.coalesce(1), "good")
    many = count_tables(docs.repartition(130), "good")
    assert (one == many).all() and one[0].sum() == 300 * 5 and one[1].sum() == 150 * 5 and CHUNK
    assert one[2].sum() == 300 * 3 and one[3].sum() == 150 * 3


def plain_weights(docs, good):
    """The log weights by dictionaries of words and pairs."""
    def grams(text):
        w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        return w, w + list(zip(w, w[1:]))

    raw, target, raw_rows, target_rows = Counter(), Counter(), Counter(), Counter()
    for i, text, _ in docs:
        w, both = grams(text)
        raw.update(both)
        raw_rows.update(set(w))
        if i in good:
            target.update(both)
            target_rows.update(set(w))

    def ratio(t, r, g):
        c, e = t[g] + 1, r[g] * t.total() / r.total() + 1
        x = math.log(c / e)
        return math.copysign(max(0, abs(x) - math.sqrt(1 / c + 1 / e)), x)

    out = {}
    for i, text, _ in docs:
        w, both = grams(text)
        if w:
            out[i] = 200 * sum(ratio(target, raw, g) for g in both) / len(w) + sum(ratio(target_rows, raw_rows, g) for g in w)
    return out


def test_weights_and_selection_equal_a_plain_version(spark):
    docs, labels, _ = corpus(150)
    docs += [(1000, None, "x"), (1001, " ", "x"), (1002, "w1", "x"), (1003, "w2 " * 5000, "x")]
    _, least, keys = selection(spark.createDataFrame(docs, "doc_id long, text string, x string").repartition(3), spark.createDataFrame(labels, LABELS))
    want = plain_weights(docs, {i for i, q, t in labels if q == 1 and t == 0})
    rows = {r.doc_id: r for r in keys.collect()}
    assert {i for i, r in rows.items() if r.log_weight > -math.inf} == set(want)
    # of about 8,000 n-grams in 2^20 buckets some 30 clash, which only texts that hold them see
    assert sum(abs(rows[i].log_weight - w) > 1e-3 * (1 + abs(w)) for i, w in want.items()) <= 0.1 * len(want)
    assert all(abs(rows[i].log_weight - w) < 0.05 * (10 + abs(w)) for i, w in want.items())
    noisy = sorted((rows[i].log_weight + (rows[i].key - rows[i].log_weight) for i in want), reverse=True)
    k = round(len(want) * sum(q == 1 and t == 0 for _, q, t in labels) / len(labels))
    assert least == noisy[k - 1] and sum(r.key >= least for r in rows.values()) == k


def test_ties_at_the_kth_key_are_all_selected(spark):
    docs, labels, _ = corpus(60)
    docs = spark.createDataFrame(docs + [(None, docs[1][1], "x")] * 5 + [docs[1]] * 7, "doc_id long, text string, x string")
    for share in (0.02, 0.3, 0.9):
        _, least, keys = selection(docs, spark.createDataFrame(labels, LABELS), share)
        rows = [r.key for r in keys.collect()]
        chosen = resample(docs, spark.createDataFrame(labels, LABELS), share)
        assert chosen.count() == sum(k >= least for k in rows) >= round(72 * share) > sum(k > least for k in rows)
        copies = {r.doc_id: r["count"] for r in chosen.groupBy("doc_id").count().collect()}
        assert copies.get(1) in (None, 8) and copies.get(None) in (None, 5)


def test_query(spark):
    out = op10_importance_resampling(spark, "/root/testdata/sf0.001")
    assert out.columns == ["doc_id", "log_weight", "key"] and 0 < out.count() <= 200
    assert out.where(F.col("doc_id").isNull()).count() == 0
