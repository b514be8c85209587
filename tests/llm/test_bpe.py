import hashlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from loomline.llm.bpe import ByteBpe, Encoder, Lexicon, compile_lexicon, decode, encode
from loomline.llm.textkernel import flat

import pyarrow as pa

PATH = public_tokenizers.path("byte_bpe_50k.json")
BPE = ByteBpe(PATH)
REAL = Tokenizer.from_file(PATH)
REAL.no_truncation()
REAL.no_padding()
WORDS = [" the", "the", " there", "there", " of", "ing", " naïve", "!!", "1234", " then"]
LEX = compile_lexicon((w, BPE.merge(w)) for w in sorted(w.encode() for w in WORDS))
CODER = Encoder(BPE, Lexicon(LEX))


def ids_of(texts):
    ids, at = CODER(*flat(pa.array(texts, pa.string())))
    return [ids[at[i] : at[i + 1]].tolist() for i in range(len(texts))]


def test_lexicon_ranks_and_shares_suffixes():
    words = sorted(w.encode() for w in WORDS)
    offs = np.cumsum([0, *map(len, words)])
    assert Lexicon(LEX).ranks(np.frombuffer(b"".join(words), np.uint8), offs).tolist() == list(range(len(words)))
    assert len(LEX["final"]) < sum(map(len, words)) * 0.8
    other = [b" th", b"x", b"", b"therefore"]
    offs = np.cumsum([0, *map(len, other)])
    assert (Lexicon(LEX).ranks(np.frombuffer(b"".join(other), np.uint8), offs) == -1).all()


TEXTS = ["", "a", " the  there\n\n of\tit's naïve　x 1234567 !!", "<|endoftext|>x <|endoftext|><|endoftext|>", "  \u0085 x  y", "word " * 3000, "é ù ñ à", "x" * 5000, "ab" * 900 + " 漢字 かな", " leading", "trailing ", "don't we'll I'd", "a  b", "Â  é", "🙂 🙃 ok"]


def test_same_as_library():
    assert ids_of(TEXTS) == [e.ids for e in REAL.encode_batch(TEXTS, add_special_tokens=False)]


@settings(max_examples=400, deadline=None)
@given(st.lists(st.text(alphabet=st.one_of(st.characters(exclude_categories=["Cs"]), st.sampled_from(" \n\tathe'sñé 　.!1")), max_size=40), max_size=4))
def test_same_as_library_on_any_text(texts):
    ours = ids_of(texts)
    assert ours == [e.ids for e in REAL.encode_batch(texts, add_special_tokens=False)]
    for ids in ours:
        assert decode(BPE, np.array(ids, np.int64)).decode() == REAL.decode(ids, skip_special_tokens=False)


def test_query_shape(spark):
    rows = [(i, t, i) for i, t in enumerate(TEXTS)] + [(None, None, 1), (3, None, 1), (1, "a", 2)]
    out = encode(spark.createDataFrame(rows, "doc_id long, text string, n_tokens long"), PATH).collect()
    assert len(out) == len(rows)
    for r in out:
        if r.doc_id is not None and r.n_tokens and r.doc_id < len(TEXTS):
            want = REAL.encode(TEXTS[r.doc_id], add_special_tokens=False).ids
            assert r.ids_sha256 == hashlib.sha256(np.array(want, "<u4").tobytes()).hexdigest()
            assert r.decoded_sha256 == hashlib.sha256(REAL.decode(want, skip_special_tokens=False).encode()).hexdigest()
    assert encode(spark.createDataFrame([], "doc_id long, text string"), PATH).count() == 0


@pytest.mark.parametrize("word", [b"\xff\xfe", b"a" * 200, b" \n" * 100])
def test_heap_merge_equals_plain_merge(word, monkeypatch):
    import loomline.llm.bpe as module

    heap = BPE.merge(word)
    monkeypatch.setattr(module, "LONGEST_WORD", 10_000)
    assert BPE.merge(word) == heap
