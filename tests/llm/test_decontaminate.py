import random

from pyspark.sql import functions as F

import loomline.llm.decontaminate as module
from loomline.llm.decontaminate import FLANK, MASKS, SPAN, decontaminate, overlaps

DOCS, ITEMS = "doc_id long, text string, _bad string, at int, seed long", "item_id long, text string, near string"


def brute(docs, items):
    out = set()
    masks = [[i for i, b in enumerate(m) if b == "1"] for m in MASKS]
    split = lambda t: [w for w in "".join(c if c.isalnum() else " " for c in (t or "").lower()).split()]
    for doc_id, text, *_ in docs:
        d = split(text)
        for item_id, words, *_ in items:
            b = split(words)
            for p in range(len(d) - SPAN + 1):
                for q in range(len(b) - SPAN + 1):
                    if any(all(d[p + i] == b[q + i] for i in m) for m in masks):
                        span = range(-min(q, FLANK), min(len(b) - q, SPAN + FLANK))
                        same = sum(0 <= p + i < len(d) and d[p + i] == b[q + i] for i in span)
                        if same * 100 >= module.AGREE * len(span):
                            out.add((doc_id, item_id))
    return out


def fixture():
    rng = random.Random(6)
    vocab = [f"w{i}" for i in range(200)]
    items = [(i, " ".join(rng.choice(vocab) for _ in range(rng.choice([13, 20, 40, 60]))).capitalize() + ".") for i in range(8)] + [(8, None), (9, ""), (10, "too short"), (None, " ".join(vocab[:30])), (11, "É b ü " * 6)]
    docs = []
    for i in range(40):
        words = [rng.choice(vocab) for _ in range(rng.randrange(60))]
        if i % 2:
            leak = (rng.choice(items[:8])[1] + " ").split()
            for _ in range(rng.randrange(len(leak) // 3)):
                leak[rng.randrange(len(leak))] = "changed"
            cut = rng.randrange(6)
            at = rng.choice([0, len(words), rng.randrange(len(words) + 1)])
            words[at:at] = leak[cut:]
        docs.append((i, "; ".join(words)))
    return docs + [(40, None), (41, ""), (42, "x"), (None, items[0][1]), (43, "the " * 5000), (1, docs[1][1]), (44, "é,B ü " * 6)], items


def frames(spark, docs, items):
    return spark.createDataFrame([(*d, "x", 1, 2) for d in docs], DOCS), spark.createDataFrame([(*i, "x") for i in items], ITEMS)


def test_equals_brute_force_and_plan_has_no_python(spark):
    docs, items = fixture()
    d, b = frames(spark, docs, items)
    found = overlaps(d, b)
    assert "Python" not in found._jdf.queryExecution().toString() and "Arrow" not in found._jdf.queryExecution().toString()
    assert {(r.doc_id, r.item_id) for r in found.collect()} == brute(docs, items)
    kept = decontaminate(d, b)
    assert kept.columns == d.columns
    bad = {x for x, _ in brute(docs, items)}
    assert sorted((str(r.doc_id) for r in kept.collect())) == sorted(str(i) for i, _ in docs if i not in bad)


def test_benchmark_in_parts(spark, monkeypatch):
    docs, items = fixture()
    monkeypatch.setattr(module, "BROADCAST_SEEDS", 100)
    monkeypatch.setattr(module, "BROADCAST_ROWS", 0)
    d, b = frames(spark, docs, items)
    assert {(r.doc_id, r.item_id) for r in overlaps(d, b).collect()} == brute(docs, items)
    assert decontaminate(d, b).where(F.col("doc_id") == 1).count() == (0 if 1 in {x for x, _ in brute(docs, items)} else 2)


def test_empty(spark):
    docs, items = fixture()
    d, b = frames(spark, docs, items)
    assert overlaps(d.limit(0), b).count() == 0 and overlaps(d, b.limit(0)).count() == 0 and decontaminate(d, b.limit(0)).count() == len(docs)


def brute_passages(docs, items):
    out = brute(docs, items)
    masks = [[i for i, b in enumerate(m) if b == "1"] for m in MASKS]
    split = lambda t: "".join(c if c.isalnum() else " " for c in (t or "").lower()).split()
    for doc_id, text, *_ in docs:
        d = split(text)
        for item_id, words, *_ in items:
            b = split(words)
            for p in range(len(d) - SPAN + 1):
                for q in range(len(b) - SPAN + 1):
                    if not any(all(d[p + i] == b[q + i] for i in m) for m in masks):
                        continue
                    for x in range(min(p, q, FLANK) + 1):
                        for y in range(min(len(d) - p - SPAN, len(b) - q - SPAN, FLANK) + 1):
                            same = [d[p + i] == b[q + i] for i in range(-x, SPAN + y)]
                            if x + y and same[0] and same[-1] and sum(same) * 100 >= module.AGREE * len(same):
                                out.add((doc_id, item_id))
    return out


def test_passages_out_of_an_item(spark):
    words = [f"w{i}" for i in range(60)]
    items = [(0, " ".join(words))]
    docs = [(n * 100 + a, " ".join(["x"] * 20 + words[a : a + n] + ["y"] * 20)) for n in range(SPAN, 24) for a in range(0, 61 - n, 7)]
    docs += [(9000, " ".join(words[20:33])), (9001, " ".join(words[45:] + ["y"] * 9)), (9002, " ".join(["x"] * 9 + words[:14]))]
    d, b = frames(spark, docs, items)
    found = {r.doc_id: (r.first_word, r.last_word, r.agreeing) for r in overlaps(d, b, passages=True).collect()}
    assert set(found) == {i for i, t in docs if sum(w.startswith("w") for w in t.split()) > SPAN}
    assert found[1321] == (20, 33, 13) and found[9000] == (0, 13, 13)
    assert sorted(r.doc_id for r in decontaminate(d, b, passages=True).collect()) == [i for i, _ in docs if i // 100 == SPAN]


def test_passages_equal_brute_force_and_keep_what_was_found(spark):
    docs, items = fixture()
    d, b = frames(spark, docs, items)
    found = overlaps(d, b, passages=True)
    assert "Python" not in found._jdf.queryExecution().toString() and "Arrow" not in found._jdf.queryExecution().toString()
    rows = {tuple(r) for r in found.collect()}
    assert {r[1:3] for r in rows} == brute_passages(docs, items) > brute(docs, items)
    assert {tuple(r) for r in overlaps(d, b).collect()} <= rows


def test_short_items_are_found_whole(spark, monkeypatch):
    items = [(0, "Two words"), (1, "one two three four five six seven eight nine ten eleven"), (2, "学而时习之"), (3, ""), (4, None), (5, "...")]
    docs = [(0, "two, WORDS"), (1, "no two other words"), (2, "so: " + items[1][1]), (3, items[1][1].replace("six", "6")), (4, "曰：学而时习之。"), (5, ""), (6, None), (7, "x two words two words")]
    d, b = frames(spark, docs, items)
    for bound in (module.BROADCAST_SEEDS, 1):
        monkeypatch.setattr(module, "BROADCAST_SEEDS", bound)
        assert {tuple(r)[1:] for r in overlaps(d, b, passages=True).collect()} == {(0, 0, 0, 2, 2), (2, 1, 1, 12, 11), (4, 2, 1, 2, 1), (7, 0, 1, 5, 2)}
    assert sorted(r.doc_id for r in decontaminate(d, b, passages=True).collect()) == [1, 3, 5, 6]
