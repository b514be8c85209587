import base64
import hashlib

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from loomline.llm import scanbpe
from loomline.llm.scanbpe import COMPOSE, PACKED, ScanEncoder, RankBpe, boundaries, decode, encode, states
from loomline.llm.textkernel import flat

PATH = scanbpe.default_ranks()
RANKS = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(PATH, "rb"))}
REAL = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})
CODER = ScanEncoder(RankBpe(PATH))

TEXTS = [
    "", "a", "'s", "'store", "''s", "x's's", "it's 'tis we'll they've I'm you'd he're 'llama", " 's", "\n's", ".'s", "  's", "1's2't", "'", "' s", "'r", "'re", "'ve'", "'l l", "'ll", "don't!'s", "\t'm",
    "  two  spaces   three\n\n of\tit's naïve　x 1234567 !!", "<|endoftext|>", "  \u0085 x  y", "word " * 3000, "é ù ñ à", "x" * 5000, "漢字 かな 12三", "trailing  ", " ", "\n \n", "a b", "🙂 🙃 ok", "\x00\x1c\x1d a", "ab\U0001e5d0\U00010d40",
]
ALPHABET = st.one_of(st.characters(exclude_categories=["Cs"]), st.sampled_from(" \n\tathe'srvlmd12 é　.!"))


def ids_of(texts):
    ids, at = CODER(*flat(pa.array(texts, pa.string())))
    return [ids[at[i] : at[i + 1]].tolist() for i in range(len(texts))]


def test_same_ids_as_the_library():
    assert ids_of(TEXTS) == [REAL.encode_ordinary(t) for t in TEXTS]


@settings(max_examples=500, deadline=None)
@given(st.lists(st.text(alphabet=ALPHABET, max_size=40), max_size=5))
def test_same_ids_on_any_text(texts):
    assert ids_of(texts) == [REAL.encode_ordinary(t) for t in texts]


@pytest.mark.parametrize("window", [1, 2, 3, 7, 65])
def test_windows_hand_on_their_state(window, monkeypatch):
    data, offsets = flat(pa.array(TEXTS))
    whole = boundaries(data, offsets).tolist()
    monkeypatch.setattr(scanbpe, "WINDOW", window)
    assert boundaries(data, offsets).tolist() == whole


def test_every_code_point_has_the_class_of_the_library():
    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    texts = ["".join(f"a{chr(c)}1{chr(c)}{chr(c)}." for c in points[i : i + 4000]) for i in range(0, len(points), 4000)]
    assert ids_of(texts) == REAL.encode_ordinary_batch(texts, num_threads=4)


def test_scan_equals_a_loop():
    rng = np.random.default_rng(1)
    steps = PACKED[rng.integers(0, len(PACKED), 10_000)]
    state, want = 2, [2]
    for step in steps.tolist():
        state = step >> 2 * state & 3
        want.append(state)
    assert states(steps, 2).tolist() == want
    f, g, h = (int(x) for x in rng.integers(0, 256, 3))
    then = lambda a, b: int(COMPOSE[a << 8 | b])
    assert then(then(f, g), h) == then(f, then(g, h))


def test_rows_of_the_query(spark):
    rows = [(i, t, i) for i, t in enumerate(TEXTS)] + [(None, None, 1), (3, None, 1), (1, "a", 2), (1, "a", 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens long")
    out = encode(docs, with_ids=True).collect()
    shown = sorted((-1 if r.doc_id is None else r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in out)
    digest = lambda b: hashlib.sha256(b).hexdigest()
    want = []
    for key, text, _ in rows:
        ids = REAL.encode_ordinary(text or "")
        want.append((-1 if key is None else key, len(ids), digest(",".join(map(str, ids)).encode()), digest(REAL.decode_bytes(ids))))
    assert shown == sorted(want)
    texts = dict((k, t) for k, t, _ in rows[: len(TEXTS)])
    for r in out:
        if r.doc_id in texts and r.n_tokens and r.doc_id > 3:
            raw = texts[r.doc_id].encode()
            ends = [*r.starts[1:], len(raw)]
            assert [raw[a:b] for a, b in zip(r.starts, ends)] == [REAL.decode_single_token_bytes(i) for i in r.ids]
    back = decode(encode(docs, with_ids=True)).collect()
    assert {bytes(r.bytes) for r in back} >= {t.encode() for t in TEXTS}
    assert encode(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_very_long_slices():
    for text in ("a" * 300_000, " " * 300_000, "'s" * 100_000, "漢" * 100_000):
        ids = ids_of([text])[0]
        assert b"".join(map(REAL.decode_single_token_bytes, ids)) == text.encode()
    short = "ab" * 3000 + "\n" * 4000
    assert ids_of([short])[0] == REAL.encode_ordinary(short)
