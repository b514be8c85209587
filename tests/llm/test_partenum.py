import random
import re
import string

import numpy as np
import pytest

import loomline.llm.partenum as module
from loomline.llm.components import components
import loomline.llm.packing as packing
from loomline.llm.partenum import bands, canopies, common, folded, forest, greatest_difference, jaccard_classes, one_of_each_class, signatures, sketches

LOW = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def shingles(text, k):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOW))
    return frozenset(tuple(w[i : i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)] if w else [])


def brute(rows, k, similarity):
    sets, parent = [shingles(r[1], k) for r in rows], list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    links = [0] * len(rows)
    for i in range(len(rows)):
        for j in range(i):
            inter = len(sets[i] & sets[j])
            if sets[i] and 100 * inter >= similarity * len(sets[i] | sets[j]):
                links[i] += 1
                links[j] += 1
                parent[find(i)] = find(j)
    out = []
    for i, r in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if find(j) == find(i) and rows[j][0] is not None]
        out.append((r[0], len(sets[i]), min(ids) if ids else None, links[i]))
    return sorted(out, key=str)


def corpus(seed, n=150):
    rng, rows = random.Random(seed), []
    for i in range(n):
        if rows and rng.random() < 0.6:
            words = (rng.choice(rows)[1] or "").split()
            for _ in range(rng.randrange(4)):
                if words:
                    words[rng.randrange(len(words))] = f"e{rng.randrange(5)}"
            if rng.random() < 0.3:
                words = words[rng.randrange(3) :]
            text = " ".join(w.upper() if rng.random() < 0.05 else w for w in words)
        else:
            text = " ".join(f"w{rng.randrange(400)}" for _ in range(rng.choice([0, 1, 2, 3, 9, 30, 90, 250])))
        rows.append((i, text, "x", 0))
    return rows + [(n, None, "x", 0), (None, rows[5][1], "x", 0), (None, "", None, 0), (7, rows[7][1], "x", 0), (n + 1, "É é É\x0b b  C", "", 1), (n + 2, "É é É b c", "", 1), (n + 3, "deep " * 3000, "", 1)]


@pytest.mark.parametrize(("k", "similarity"), [(3, 90), (5, 80), (2, 60)])
def test_equals_brute_force(spark, k, similarity):
    rows = corpus(k)
    got = jaccard_classes(spark.createDataFrame(rows, "doc_id long, text string, node string, component_id int").repartition(3), k, similarity).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id, r.n_links) for r in got), key=str) == brute(rows, k, similarity)


def test_large_clusters_are_cut_into_blocks(spark, monkeypatch):
    monkeypatch.setattr(module, "BLOCK", 600)
    monkeypatch.setattr(module, "BROADCAST_ROWS", 0)
    rows = corpus(11, 80)
    got = jaccard_classes(spark.createDataFrame(rows, "doc_id long, text string, x string, y int").repartition(2), 3, 90).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id, r.n_links) for r in got), key=str) == brute(rows, 3, 90)


@pytest.mark.parametrize(("k", "similarity"), [(3, 90), (5, 80)])
def test_common_signatures_and_large_groups_are_cut(spark, monkeypatch, k, similarity):
    for name, value in (("HOT", 2), ("GROUP", 3), ("GROUPS_SHINGLES", 500), ("ENTRIES", 4000), ("BROADCAST_ROWS", 0)):
        monkeypatch.setattr(module, name, value)
    monkeypatch.setattr(packing, "FAN_OUT", 2)
    rows = corpus(13, 120)
    got = jaccard_classes(spark.createDataFrame(rows, "doc_id long, text string, x string, y int").repartition(3), k, similarity).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id, r.n_links) for r in got), key=str) == brute(rows, k, similarity)


def test_forest_connects_the_same():
    rng = np.random.default_rng(6)
    for n in (1, 40, 90, 300):
        a, b = rng.integers(0, 100, n) * 7, rng.integers(0, 100, n) * 7
        got = forest(a, b)
        assert got.shape[1] < len(np.unique(np.concatenate((a, b))))

        def find(root, x):
            while root[x] != x:
                x = root[x]
            return x

        roots = []
        for pairs in (zip(a.tolist(), b.tolist()), got.T.tolist()):
            root = {x: x for x in range(0, 700, 7)}
            for x, y in pairs:
                low, high = sorted((find(root, x), find(root, y)))
                root[high] = low
            roots.append([find(root, x) for x in root])
        assert roots[0] == roots[1]


def test_sketches_differ_in_no_more_than_the_sets():
    rng = np.random.default_rng(4)
    sets = [np.unique(rng.integers(0, 1 << 60, int(n)).astype(np.uint64)) for n in rng.integers(1, 400, 40)]
    sets += [np.union1d(s[len(s) // 9 :], rng.integers(0, 1 << 60, 5).astype(np.uint64)) for s in sets]
    offsets = np.concatenate(([0], np.cumsum([len(s) for s in sets])))
    words, first = sketches(np.concatenate(sets), offsets)
    bits = folded(words, first, np.arange(len(sets)))
    for i, a in enumerate(sets):
        for j, b in enumerate(sets):
            alone = folded(words, first, np.array([i, j]))
            apart = [int(np.bitwise_count(x[p] ^ x[q]).sum()) for x, p, q in ((bits, i, j), (alone, 0, 1))]
            assert apart[0] <= apart[1] <= len(np.setxor1d(a, b))


def test_canopies_connect_all_that_are_near():
    rng = np.random.default_rng(5)
    bits = rng.integers(0, 1 << 63, (60, 4)).astype(np.uint64)
    for i in range(20, 60):
        bits[i] = bits[rng.integers(0, i)]
        for _ in range(rng.integers(0, 12)):
            bits[i, rng.integers(0, 4)] ^= np.uint64(1) << np.uint64(rng.integers(0, 63))
    apart = np.bitwise_count(bits[:, None] ^ bits[None]).sum(axis=2)
    for most in (0, 3, 9, 20):
        leader, ties = canopies(bits, most, 0)
        root = list(range(60))

        def find(x):
            while root[x] != x:
                x = root[x]
            return x

        for a, b in ties.T.tolist():
            root[find(a)] = find(b)
        assert all(find(i) == find(j) for i, j in np.argwhere(apart <= most).tolist())
        led = np.flatnonzero(leader >= 0)
        assert (leader[leader[led]] < 0).all() and (apart[led, leader[led]] <= most // 3).all()
        # what the leaders stand for meets among them
        alone = np.flatnonzero(leader < 0)
        _, more = canopies(bits[alone], most, most // 3)
        for a, b in alone[more].T.tolist():
            root[find(a)] = find(b)
    assert greatest_difference(90, 80) == 20


def test_blocks_without_sets_count_no_links(spark, monkeypatch):
    monkeypatch.setattr(module, "BLOCK", 20)
    rows = [(i, " ".join(f"w{i // 2}x{j}" for j in range(60 + i % 2))) for i in range(16)]
    got = jaccard_classes(spark.createDataFrame(rows, "doc_id long, text string"), 3, 90).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id, r.n_links) for r in got), key=str) == brute(rows, 3, 90)


def test_empty(spark):
    assert jaccard_classes(spark.createDataFrame([], "doc_id long, text string"), 3, 90).count() == 0


@pytest.mark.parametrize("similarity", [80, 90])
def test_similar_sets_share_a_signature(similarity):
    rng = np.random.default_rng(similarity)
    low, bound = bands(similarity)
    for _ in range(300):
        n = int(rng.integers(1, 300))
        base = rng.integers(1, 1 << 62, n + 60).astype(np.uint64)
        a, b = base[:n], base[int(rng.integers(0, 1 + n // 8)) : n + int(rng.integers(0, 1 + n // 8))]
        inter = len(np.intersect1d(a, b))
        if 100 * inter < similarity * (len(a) + len(b) - inter):
            continue
        sig, row = signatures(np.concatenate((np.sort(a), np.sort(b))), np.array([0, len(a), len(a) + len(b)]), similarity)
        assert set(sig[row == 0].tolist()) & set(sig[row == 1].tolist())


def test_common_counts():
    rng = np.random.default_rng(1)
    sets = [np.unique(rng.integers(0, 300, 60)).astype(np.uint64) for _ in range(90)]
    first = rng.integers(0, 90, 90)
    last = np.minimum(90, first + rng.integers(0, 60, 90))
    for i, got in common(sets, first, last):
        assert all(x == len(np.intersect1d(sets[i], s)) for j, (x, s) in enumerate(zip(got, sets[first[i] : last[i]]), first[i]) if j != i)


def test_one_of_each_class(spark):
    rows = corpus(21) + [(7, corpus(21)[7][1], "x", 0)] * 3
    classes = {(r[0], i): r[2] for i, r in enumerate(brute(rows, 5, 80))}
    kept = one_of_each_class(spark.createDataFrame(rows, "doc_id long, text string, _loser string, n int").repartition(3), 5, 80).collect()
    assert kept[0].__fields__ == ["doc_id", "text", "_loser", "n"]
    linked = {c for (_, i), c in classes.items() if c is not None}
    ids = sorted(str(r.doc_id) for r in kept)
    alone = [r for r in brute(rows, 5, 80) if r[3] == 0]
    groups = {r[2] for r in brute(rows, 5, 80) if r[3]}
    assert linked and ids == sorted([str(r[0]) for r in alone] + [str(g) for g in groups])


def test_one_of_each_class_without_ids(spark):
    words = [" ".join(f"{c}{i}" for i in range(80)) for c in "abc"]
    rows = [(None, words[0]), (None, words[0]), (None, words[0] + " more"), (None, words[1]), (None, words[1] + " more"), (None, words[2]), (5, words[2] + " more"), (None, None), (None, "")]
    kept = one_of_each_class(spark.createDataFrame(rows, "doc_id long, text string"), 5, 80).collect()
    assert sorted(((r.text or "")[:1] for r in kept)) == ["", "", "a", "b", "c"] and [r.doc_id for r in kept if (r.text or "").startswith("c")] == [5]
    # one doc_id in two classes names neither's rows duplicates of the other
    both = one_of_each_class(spark.createDataFrame([(1, words[0]), (2, words[0]), (1, words[1]), (3, words[1])], "doc_id long, text string"), 5, 80).collect()
    assert sorted((r.doc_id, r.text[:1]) for r in both) == [(1, "a"), (1, "b")]


@pytest.mark.parametrize("hub", [1, 5, 64])
def test_components(spark, monkeypatch, hub):
    import loomline.llm.components as module

    monkeypatch.setattr(module, "HUB", hub)
    monkeypatch.setattr(module, "SMALL", 0 if hub < 64 else 100)
    rng = random.Random(2)
    edges = [(i, i + 1) for i in range(60)] + [(100 + rng.randrange(50), 100 + rng.randrange(50)) for _ in range(40)] + [(-5, 300), (300, -5)] + [(1000, 1001 + i) for i in range(30)] + [(999 - i, 1000) for i in range(9)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    parent = {x: x for e in edges for x in e}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        parent[max(find(a), find(b))] = min(find(a), find(b))
    assert got == {x: find(x) for e in edges if e[0] != e[1] for x in e}
