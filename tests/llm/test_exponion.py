import hashlib

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from loomline.llm import exponion
from loomline.llm.exponion import OP13_SQL, Centroids, by_hash, first_search, kmeans, op13_exponion_kmeans, search, squared


def nearest(vectors, centroids):
    out = []
    for v in vectors:
        d = [sum((int(a) - int(b)) ** 2 for a, b in zip(v, c)) for c in centroids]
        out.append(d.index(min(d)))
    return out


@settings(max_examples=150, deadline=None)
@given(st.integers(1, 9), st.integers(0, 2**31), st.sampled_from([2, 4, 900, 1 << 25]))
def test_search_keeps_ties_and_bounds(k, seed, width):
    rng = np.random.default_rng(seed)
    vectors, first = rng.integers(-width, width, (60, 3)), rng.integers(-width, width, (k, 3))
    number, upper, lower = first_search(vectors, Centroids(first))
    assert number.tolist() == nearest(vectors, first)
    values = first
    for _ in range(4):
        new = values + rng.integers(-max(width // 8, 1), max(width // 8, 1) + 1, values.shape)
        moved = np.sqrt(((new - values) ** 2).sum(axis=1).astype(float)) * (1 + 1e-11)
        values = new
        number, upper, lower, _ = search(vectors, number, upper, lower, Centroids(values, moved))
        assert number.tolist() == nearest(vectors, values)
        d = np.array([[np.sqrt(float(sum((int(a) - int(b)) ** 2 for a, b in zip(v, c)))) for c in values] for v in vectors])
        assert (upper >= d[np.arange(60), number]).all()
        if k > 1:
            rest = d.copy()
            rest[np.arange(60), number] = np.inf
            assert (lower <= rest.min(axis=1)).all()


def test_far_centroids_are_not_compared():
    rng = np.random.default_rng(0)
    centres = rng.integers(-10**6, 10**6, (40, 8))
    vectors = np.repeat(centres, 100, axis=0) + rng.integers(-9, 9, (4000, 8))
    number, upper, lower = first_search(vectors, Centroids(centres))
    moved = np.full(40, 10.0)
    after = search(vectors, number, upper, lower, Centroids(centres, moved))
    assert after[3] == 0 and (after[0] == number).all()
    after = search(vectors, number, upper, np.zeros(4000), Centroids(centres, moved))
    assert after[3] < 4000 * 5 and (after[0] == number).all()


def test_distances_of_large_components_are_exact():
    a, b = np.full((1, 64), (1 << 26) - 1), np.full(64, 1 - (1 << 26))
    assert squared(a, b).tolist() == [64 * (2 * ((1 << 26) - 1)) ** 2]


def plain(rows, k=8, rounds=10, d=64):
    kept = [(i, [int(np.floor(1024 * float(x))) for x in v]) for i, v in rows if v is not None and len(v) == d and all(x is not None and np.isfinite(x) for x in v)]
    digest = lambda i: hashlib.sha256(f"3:{i}".encode()).hexdigest()
    centroids = [v for _, v in sorted(kept, key=lambda r: (r[0] is None, digest(r[0]), r[1]))[:k]]
    for _ in range(rounds):
        of = nearest([v for _, v in kept], centroids)
        for j in range(len(centroids)):
            mine = [v for (_, v), n in zip(kept, of) if n == j]
            if mine:
                centroids[j] = [sum(c) // len(mine) for c in zip(*mine)]
    of = nearest([v for _, v in kept], centroids)
    far = [sum((a - b) ** 2 for a, b in zip(v, centroids[n])) for (_, v), n in zip(kept, of)]
    per = {n: sum(x for x, m in zip(far, of) if m == n) for n in set(of)}
    return [(i, n, x, per[n], sum(far), hashlib.sha256(",".join(map(str, centroids[n])).encode()).hexdigest()) for (i, _), n, x in zip(kept, of, far)]


@pytest.mark.parametrize("kind", ["ties", "mixed", "few", "none"])
def test_query_against_brute_force(spark, tmp_path, kind, monkeypatch):
    rng = np.random.default_rng(2)
    if kind == "ties":  # few distinct vectors, on a grid, so that many distances are equal and clusters go empty
        rows = [(i, [float(x) / 1024 for x in rng.integers(-1, 2, 64) * (np.arange(64) < 3)]) for i in range(90)]
    else:
        rows = [(i, [float(np.float32(x)) for x in rng.normal(size=64)]) for i in range({"mixed": 150, "few": 3, "none": 0}[kind])]
        odd = [None, [], [1.0] * 63, [None] + [1.0] * 63, [float("nan")] * 64, [float("inf")] + [0.0] * 63]
        rows += [(1000 + i, v) for i, v in enumerate(odd)] + rows[:2] + ([(None, rows[0][1])] if rows else [])
    monkeypatch.setattr(exponion, "ROWS", 40)
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "vec_id long, embedding array<float>, cluster int, ids string").repartition(3)
    df.write.parquet(f"{tmp_path}/embeddings.parquet")
    got = [tuple(r) for r in op13_exponion_kmeans(spark, str(tmp_path)).collect()]
    key = lambda r: (r[0] is None, r[0] or 0)
    assert sorted(got, key=key) == sorted(plain(rows), key=key)


def test_query_equals_its_sql(spark):
    con = duckdb.connect()
    con.sql("CREATE VIEW embeddings AS SELECT * FROM '/root/testdata/sf0.001/embeddings.parquet'")
    want = con.sql(OP13_SQL)
    got = op13_exponion_kmeans(spark, "/root/testdata/sf0.001")
    assert got.columns == want.columns
    assert sorted(map(tuple, got.collect())) == sorted(want.fetchall())


def test_a_component_too_large_is_an_error(spark):
    df = spark.createDataFrame([(1, [1e30] * 64)], "vec_id long, embedding array<float>")
    with pytest.raises(ValueError, match="would not fit a long"):
        kmeans(df, by_hash)
