import random
import re

import numpy as np
import pytest

from loomline.functions import text as X
from loomline.operators import grouping
from loomline.operators.chunkers import CHUNKERS, Chunk, Config, chunk_documents, chunk_text, register, sentence_windows, word_windows
from loomline.operators.packing import fold
from plain_chunkers import _lexical_groups, plain_chunks
from pyspark.sql import functions as F

ZH = "第一句。第二句。第三句。第四句。"


def contents(spark, text, kind, **settings):
    return [c.content for c in chunk_text(spark, text, kind, Config(min_chunk_size=1, **settings))]


@pytest.mark.parametrize(("most", "want"), [(1, ["第一句", "第二句", "第三句", "第四句"]), (2, ["第一句第二句", "第三句第四句"])])
def test_sentences(spark, most, want):
    assert contents(spark, ZH, "sentence", max_sentences=most, min_sentences=1, sentence_overlap=0, paragraphs=False) == want


@pytest.mark.parametrize(("step", "want"), [(1, ["w1 w2 w3", "w2 w3 w4", "w3 w4 w5"]), (2, ["w1 w2 w3", "w3 w4 w5"])])
def test_sliding_words(spark, step, want):
    assert contents(spark, "w1 w2 w3 w4 w5", "sliding_window", window_size=3, step_size=step, use_sentences=False) == want


@pytest.mark.parametrize(("threshold", "want"), [(0, ["句子0 句子1 句子2 句子3"]), (1, ["句子0", "句子1", "句子2", "句子3"])])
def test_semantic(spark, threshold, want):
    assert contents(spark, ZH, "semantic", similarity=threshold, placeholder=True, chunk_size=1000) == want


def test_semantic_batches_give_equal_groups(spark):
    text = "今天天氣很好。我們去公園散步。接著去吃冰淇淋。回家後休息。"
    load = lambda: lambda texts: np.array([[float(len(t))] for t in texts])
    small, large = (chunk_text(spark, text, "semantic", Config(batch=b), load=load) for b in (2, 64))
    assert [c.metadata["sentence_indices"] for c in small] == [c.metadata["sentence_indices"] for c in large]


def test_configs_that_never_end_are_refused():
    for bad in ({"max_sentences": 1}, {"step_size": 0}, {"chunk_size": 0}, {"overlap_size": 1000}, {"min_chunk_size": 0}):
        with pytest.raises(ValueError):
            Config(**bad)


def test_fold_over_many_blocks(spark):
    df = spark.range(3).select(F.sequence(F.lit(1), F.col("id") * 500).alias("xs"))
    df = df.select(F.when(F.size("xs") == 2, F.array().cast("array<bigint>")).otherwise(F.col("xs")).alias("xs"))
    got = df.select("xs", fold(F.col("xs"), F.lit(0).cast("long"), lambda s, x: F.struct((s * 31 % 1009 + x).alias("state"), s.alias("out")), "bigint").alias("o")).collect()
    for r in got:
        state, want = 0, []
        for x in r.xs:
            want.append(state)
            state = state * 31 % 1009 + x
        assert r.o == want


def plain(v):
    return {True: "true", False: "false"}.get(v, str(v)) if isinstance(v, bool) else str(v)


def same_as_loops(spark, texts, kind, config, load=None):
    docs = spark.createDataFrame(list(enumerate(texts)), "id int, content string").repartition(4)
    got = {}
    made = chunk_documents(docs, kind, config, load=load)
    for r in made.collect():
        got.setdefault(r.id, []).append((r.chunk_index, r.content, r.start_pos, r.end_pos, dict(r.metadata)))
    for i, text in enumerate(texts):
        want = [(c.index, c.content, c.start, c.end, {k: plain(v) for k, v in c.metadata.items()}) for c in plain_chunks(text, kind, config, **({"encode": load()} if load else {}))]
        assert sorted(got.get(i, []), key=lambda c: c[0]) == want, (kind, config, text)
    return made


def some_texts(seed, zh=False):
    rng = random.Random(seed)
    ends, texts = ("。！？；" if zh else ".!?"), [None, "", " \n", "...", "。", "one", "One. Two", "a" * 200 + ". b", "\n\n . \n\n", "x.\n\n\n\ny. z."]
    for _ in range(40):
        parts = []
        for _ in range(rng.choice((1, 3, 12, 60))):
            parts.append(" ".join(rng.choice("abcdefgh") * rng.choice((1, 2, 9, 40)) for _ in range(rng.choice((0, 1, 3, 30)))) + rng.choice(ends) + rng.choice(("", "", ".", "\n\n", "\n", " \n\n ")))
        texts.append(rng.choice(("", "  ")) + " ".join(parts))
    return texts


@pytest.mark.parametrize("settings", [
    {"language": "en"}, {"language": "en", "paragraphs": False}, {}, {"language": "en", "paragraphs": False, "max_sentences": 4, "chunk_size": 60, "overlap_size": 10, "min_chunk_size": 20},
    {"language": "en", "max_sentences": 3, "min_sentences": 3, "sentence_overlap": 2, "min_chunk_size": 1}, {"language": "en", "min_sentences": 5, "max_sentences": 6, "sentence_overlap": 0, "chunk_size": 100, "overlap_size": 1},
])
def test_sentence_chunks_equal_loops(spark, settings):
    made = same_as_loops(spark, some_texts(7) + some_texts(8, zh=True), "sentence", Config(**settings))
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan.replace("Exchange RoundRobin", "")


@pytest.mark.parametrize("settings", [{}, {"window_size": 20, "step_size": 2}, {"use_sentences": False}, {"use_sentences": False, "window_size": 7, "step_size": 3, "min_chunk_size": 30, "chunk_size": 60, "overlap_size": 0}, {"use_sentences": False, "window_size": 4, "step_size": 9}])
def test_windows_equal_loops(spark, settings):
    made = same_as_loops(spark, some_texts(9), "sliding_window", Config(**settings))
    assert "Python" not in made._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize(("similarity", "room"), [(0.2, 1000), (0.7, 300), (1.0, 1000), (0.0, 100), (0.35, 40)])
def test_semantic_chunks_equal_loops(spark, similarity, room):
    config = Config(language="en", similarity=similarity, chunk_size=room, overlap_size=0)
    same_as_loops(spark, some_texts(10), "semantic", config)


def test_token_groups_equal_all_comparisons():
    rng = random.Random(4)
    for seed in range(60):
        vocabulary = [f"w{int(rng.paretovariate(0.7)) % 50}" for _ in range(40)]
        parts = [" ".join(rng.choice(vocabulary) for _ in range(rng.randrange(1, 12))) for _ in range(rng.randrange(1, 90))]
        config = Config(similarity=rng.choice((0.1, 0.2, 0.5, 0.8, 1.0)), chunk_size=rng.choice((20, 100, 1000)), overlap_size=0)
        assert list(grouping.token_groups(parts, config.similarity, config.chunk_size)) == list(_lexical_groups(parts, config)), seed


def test_vector_chunks_equal_loops(spark):
    from loomline.functions.vectors import hash_embed

    same_as_loops(spark, some_texts(11), "semantic", Config(language="en", similarity=0.3), load=lambda: lambda texts: hash_embed(texts, 32))


def test_a_long_text(spark):
    text = " ".join(f"Sentence {i} has some words{'.' * (1 + i % 3)}" for i in range(4000))
    for kind, config in (("sentence", Config(language="en", paragraphs=False)), ("sentence", Config(language="en")), ("sliding_window", Config()), ("sliding_window", Config(use_sentences=False))):
        same_as_loops(spark, [text.replace(". S", ".\n\nS")], kind, config)


def test_small_chunks_join_the_one_before_and_leave_gaps(spark):
    from loomline.operators.packing import chunk, merged, noted

    given = [("a" * 120, None), ("b", "1"), (" ", None), ("c" * 1500, None), ("d", None)]
    column = F.array(*(chunk(F.lit(i), F.lit(t), noted(("method", "extra"), method="m", **({"extra": e} if e else {}))) for i, (t, e) in enumerate(given)))
    got = spark.range(1).select(F.inline(merged(column, ("method", "extra"), 100, 1500))).collect()
    assert [(c.chunk_index, c.content[-1], c.notes) for c in got] == [(0, "b", ["m", "1"]), (3, "c", ["m", None]), (4, "d", ["m", None])]


def test_paragraphs_short_ones_are_combined_and_stand_again(spark):
    text = "One.\n\nTwo. Three.\n\n" + " ".join(f"S{i}." for i in range(25))
    got = [(c.metadata["chunk_method"], c.content) for c in chunk_text(spark, text, "sentence", Config(min_chunk_size=1, language="en"))]
    assert got[0] == ("paragraph_combined", "One.\n\nTwo. Three.") and got[1] == ("paragraph_complete", "Two. Three.")
    assert [m for m, _ in got[2:]] == ["paragraph_sentence_split"] * 3 and got[2][1].startswith("S0 S1") and got[3][1].startswith("S9 S10")


def test_documents_and_registry(spark):
    register("Halves", lambda text, config: [Chunk.of(text[: len(text) // 2], 0, "half"), Chunk.of(text[len(text) // 2 :], 1, "half")])
    docs = spark.createDataFrame([(1, "abcd"), (2, None), (3, " "), (4, "xy")], "id int, content string")
    got = chunk_documents(docs, "halves").collect()
    assert [(r.id, r.chunk_index, r.content, r.metadata["chunk_method"]) for r in got] == [(1, 0, "ab", "half"), (1, 1, "cd", "half"), (4, 0, "x", "half"), (4, 1, "y", "half")]
    del CHUNKERS["halves"]


def test_expressions_equal_chunkers(spark):
    rng = random.Random(3)
    texts = [" ".join(rng.choice("ab") for _ in range(n)) for n in (0, 1, 5, 9, 10, 11, 14, 23)] + ["a a a a a a a a a a a"]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, t string")
    got = {r.id: [w.content for w in r.w] for r in df.select("id", word_windows(X.words(F.col("t")), 5, 3).alias("w")).collect()}
    for i, t in enumerate(texts):
        want = [c.content for c in plain_chunks(t, "sliding_window", Config(window_size=5, step_size=3, use_sentences=False, min_chunk_size=1))]
        assert got[i] == (want or [""])
    with pytest.raises(ValueError):
        sentence_windows(F.col("t"), 1, 1)


def test_text_functions(spark):
    rows = [("a  b　c ", "https://u:p@H.example:8/x/y?q#f"), ("", "http://h"), (" \n", "nourl")]
    got = spark.createDataFrame(rows, "t string, u string").select(X.words(F.col("t")).alias("w"), X.word_count_sql(F.col("t")).alias("n"), X.domain(F.col("u")).alias("d"), X.url_path(F.col("u")).alias("p"), X.normalized_base(F.col("u")).alias("b")).collect()
    assert [tuple(r) for r in got] == [(["a", "b", "c"], 4, "u:p@H.example:8", "/x/y", rows[0][1]), ([], 1, "h", "/", "http://h"), ([], 2, "", "/", "https://nourl")]
    zh = spark.createDataFrame([(ZH + "！a b",)], "t string").select(X.sentences(F.col("t"), "zh").alias("s")).first().s
    assert zh == [x for x in re.split("[。！？；]+", ZH + "！a b") if x]


def test_semantic_equals_sql_on_short_texts(spark):
    import duckdb
    from loomline.operators.chunkers import chunk_documents
    from loomline.plans import chunk_sql

    texts = ["a b c. a b d! x y. a b. y x z? q", "a. b. c", "One two. One two. One two. Three", " ", None, "aa " * 40 + ". " + "aa bb " * 20 + ". bb cc. cc dd. aa cc " * 6]
    texts.append(". ".join(" ".join(f"{'abcde'[k % 5]}{(k * j) % 37}" for j in range(40)) for k in range(1, 16)))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    con = duckdb.connect()
    con.sql("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", [list(x) for x in enumerate(texts)])
    want = con.sql(f"SELECT doc_id, chunk_index, content, end_pos, sentence_indices FROM ({chunk_sql.SEMANTIC_SQL})").fetchall()
    made = chunk_documents(docs, "semantic", Config(language="en", similarity=0.2), "doc_id", "text").collect()
    assert sorted(want, key=str) == sorted([(r.doc_id, r.chunk_index, r.content, r.end_pos, r.metadata.get("sentence_indices")) for r in made], key=str) and len(made) > 6


def test_vector_groups_equal_a_plain_loop():
    import numpy as np
    from loomline.functions.vectors import hash_embed
    from loomline.operators.grouping import vector_groups

    rng = np.random.default_rng(5)
    parts = [" ".join(rng.choice(list("abcdefghij"), 4)) for _ in range(80)]
    encode = lambda texts: hash_embed(texts, 32)
    for size, bound in ((1000, 0.4), (100, 0.2), (1000, -1.0), (20, 0.1)):
        v, free, want = hash_embed(parts, 32).astype(float), list(range(80)), []
        while free:
            group = [free.pop(0)]
            for j in list(free):
                if sum(v[i] @ v[j] for i in group) >= bound * len(group):
                    group.append(j)
                    free.remove(j)
                    if 50 * len(group) > size:
                        break
            want.append(group)
        assert list(vector_groups(parts, bound, size, 64, encode)) == want


def test_failing_encoder_gives_way_to_words():
    def fails(texts):
        raise RuntimeError("no model")

    parts = ["a b", "a b c", "x y", "a b d", "q"]
    want = grouping.groups(parts, 0.5, 1000)
    assert grouping.groups(parts, 0.5, 1000, encode=fails) == grouping.groups(parts, 0.5, 1000, encode=lambda texts: [[1.0]]) == want


def test_chunkers_are_described():
    from loomline.operators.chunkers import described

    assert set(described()) >= {"semantic", "sentence", "sliding_window"} and all(described().values())


def test_numbered(spark):
    from loomline.operators.chunkers import numbered

    docs = spark.createDataFrame([(i, None if i % 2 else f"own{i}") for i in range(50)], "n int, document_id string").repartition(4)
    got = sorted((r.n, r.document_index, r.document_id) for r in numbered(docs, "n").collect())
    assert got == [(i, i, f"doc_{i}" if i % 2 else f"own{i}") for i in range(50)]
    assert numbered(docs.limit(0), "n").count() == 0


def test_table_function(spark):
    from loomline.plans import chunk_function

    chunk_function.register(spark)
    texts = [" ".join(random.Random(n).choice("ab") for _ in range(n)) for n in (0, 1, 5, 9, 10, 11, 14, 23)] + [None, "a. b! c? d. e", "a a a a a a a a a a a"]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, t string")
    call = lambda kind, size, step: {(r.id, r.first, r.content) for r in spark.sql(f"SELECT * FROM chunk(TABLE(SELECT * FROM {{df}}), '{kind}', {size}, {step})", df=df).collect()}
    text = F.coalesce("t", F.lit(""))
    shown = lambda w: {(r.id, r[1], r.content) for r in df.select("id", F.inline(w)).collect()}
    assert call("words", 5, 3) == shown(word_windows(X.words(text), 5, 3))
    assert call("sentences", 2, 1) == shown(sentence_windows(X.sentences(text), 2, 1))
    for bad in ("'words', 0, 1", "'lines', 1, 1", "'words', 1, 0"):
        with pytest.raises(Exception, match="windows of"):
            spark.sql(f"SELECT * FROM chunk(TABLE(SELECT * FROM {{df}}), {bad})", df=df)
    with pytest.raises(Exception, match="a key and a text"):
        spark.sql("SELECT * FROM chunk(TABLE(SELECT id FROM {df}), 'words', 1, 1)", df=df)


def c_calls(run):
    """Calls of built-in functions while run() is under way."""
    import sys

    found = 0

    def seen(frame, event, arg):
        nonlocal found
        found += event == "c_call"

    sys.setprofile(seen)
    try:
        run()
    finally:
        sys.setprofile(None)
    return found


def test_sentences_unlike_all_others_cost_no_search_each():
    parts = [f"a{i} b{i} c{i}" for i in range(600)]
    assert list(grouping.token_groups(parts, 0.2, 1000)) == [[i] for i in range(600)]
    assert c_calls(lambda: list(grouping.token_groups(parts, 0.2, 1000))) < 3 * 600


def test_token_groups_in_small_blocks_equal_all_comparisons(monkeypatch):
    rng = random.Random(5)
    monkeypatch.setattr(grouping, "CELLS", 60)
    for seed in range(60):
        vocabulary = [f"w{int(rng.paretovariate(0.7)) % 50}" for _ in range(40)]
        parts = [" ".join(rng.choice(vocabulary) for _ in range(rng.randrange(1, 12))) for _ in range(rng.randrange(1, 90))]
        config = Config(similarity=rng.choice((0.0, 0.1, 0.2, 0.5, 0.8, 1.0)), chunk_size=rng.choice((20, 100, 1000)), overlap_size=0)
        assert list(grouping.token_groups(parts, config.similarity, config.chunk_size)) == list(_lexical_groups(parts, config)), seed


def test_sentences_collapse_all_white_space(spark):
    texts = ["", None, " . ", "a\tb.\u3000c \n d  e!\u00a0?f\u2028", "\ta. \tb\r\n", "a\u0085 b . c\u0085", "  x   y  .", "a\x1cb"]
    got = [r.s for r in spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").orderBy("i").select(X.sentences(F.col("t"), "en").alias("s")).collect()]
    space = "[ \t\n\x0b\x0c\r\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+"
    assert got == [None if t is None else [p for p in (re.sub(space, " ", x).strip(" ") for x in re.split("[.!?]+", t)) if p] for t in texts]


def test_vectors_unlike_all_others_cost_no_search_each(monkeypatch):
    parts = [str(i) for i in range(300)]
    encode = lambda texts: np.eye(300)[[int(t) for t in texts]]
    for small in (512, 4):
        monkeypatch.setattr(grouping, "SMALL", small)
        assert list(grouping.vector_groups(parts, 0.2, 1000, 64, encode)) == [[i] for i in range(300)]
        assert c_calls(lambda: list(grouping.vector_groups(parts, 0.2, 1000, 64, encode))) < 300


def test_vector_groups_in_small_blocks_equal_large_ones(monkeypatch):
    rng = np.random.default_rng(6)
    for dense in (False, True):
        vectors = rng.normal(size=(200, 12)) * (dense or rng.random((200, 12)) < 0.3)
        vectors[::7] = vectors[0]
        vectors[50] = np.nan
        encode = lambda texts: vectors[[int(t) for t in texts]]
        parts = [str(i) for i in range(200)]
        want = list(grouping.vector_groups(parts, 0.5, 1000, 64, encode))
        with monkeypatch.context() as m:
            m.setattr(grouping, "CELLS", 900)
            m.setattr(grouping, "SMALL", 4)
            assert list(grouping.vector_groups(parts, 0.5, 1000, 64, encode)) == want and [50] in want and max(map(len, want)) > 5
