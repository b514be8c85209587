"""Operator 8: byte-level BPE encoding and decoding through a word transducer.

The most frequent pre-tokens of the corpus are compiled, with the ids that
they encode to, into a minimal acyclic transducer: an automaton whose equal
suffixes are shared and whose transitions carry the numbers that add up to a
word's rank (so each accepted word yields its own output although states are
shared).  The arrays are saved as .npy files, shipped with SparkContext.addFile
and memory-mapped by the workers.  A pre-token that the automaton does not
accept is merged exactly, by the lowest-ranked adjacent pair.

The lexicon is bounded (LEXICON_WORDS), only makes encoding faster, and is
chosen from counts over all texts; results do not depend on it.

Defined results: a null or empty text encodes to no ids (digest of no bytes)
and decodes to the empty text; texts of any length are taken whole; the
literal text of a special token becomes that token's id, as the tokenizers
library does by default; repeated rows are kept; an empty table gives an
empty result; of the input only the id and text columns are used.
"""

from __future__ import annotations

import atexit
import hashlib
import heapq
import json
import os
import shutil
import tempfile
import uuid
from collections import Counter
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .resample import kth_largest
from .shared import staged, table
from .textkernel import flat, gather, slices, strings

#: Words that the lexicon holds at most; its size is then bounded by their bytes.
LEXICON_WORDS = 150_000
#: Longer pre-tokens, in characters or bytes, are merged anew each time and not put in the lexicon.
LONGEST_WORD = 64
#: Merged words that a worker remembers; then it forgets all and starts anew.
REMEMBERED = 300_000
SLICE_BYTES = 4 << 20
NEVER = 1 << 60
#: Pieces that are one pre-token: a space and letters that every Unicode version has.
ONE_TOKEN = r"^ ?[A-Za-z\x{C0}-\x{D6}\x{D8}-\x{F6}\x{F8}-\x{24F}]+$"
PRETOKEN = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")


def byte_alphabet() -> list[str]:
    """The printable stand-in of each byte in byte-level BPE vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out, extra = {b: chr(b) for b in plain}, 256
    for b in range(256):
        if b not in out:
            out[b], extra = chr(extra), extra + 1
    return [out[b] for b in range(256)]


def refuse_other_kinds(spec: dict) -> None:
    """Raises ValueError for a file that asks for what is not done here."""
    model, pre = spec["model"], spec.get("pre_tokenizer") or {}
    odd = [k for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges") if model.get(k)]
    odd += ["normalizer"] * bool(spec.get("normalizer")) + ["model"] * (model.get("type", "BPE") != "BPE")
    if pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or not pre.get("use_regex", True):
        odd.append("pre_tokenizer")
    odd += [f"added token {t['content']!r}" for t in spec["added_tokens"] if t.get("single_word") or t.get("lstrip") or t.get("rstrip")]
    if odd:
        raise ValueError(f"not a plain byte-level BPE vocabulary: {', '.join(odd)}")


class ByteBpe:
    """A byte-level BPE vocabulary read from a tokenizers JSON file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        refuse_other_kinds(spec)
        alphabet = byte_alphabet()
        back = {c: b for b, c in enumerate(alphabet)}
        vocab = spec["model"]["vocab"]
        size = max([*vocab.values(), *(t["id"] for t in spec["added_tokens"])]) + 1
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.token_bytes = [b""] * size
        for text, i in vocab.items():
            if text not in self.special:
                self.token_bytes[i] = bytes(back[c] for c in text)
        for text, i in self.special.items():
            self.token_bytes[i] = text.encode()
        self.byte_id = [vocab[c] for c in alphabet]
        self.rank: dict[tuple[int, int], int] = {}
        self.made: list[int] = []  # the token that each merge makes
        for r, pair in enumerate(spec["model"]["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            self.rank[vocab[a], vocab[b]] = r
            self.made.append(vocab[a + b])
        parts = sorted(self.special, key=len, reverse=True)
        self.split = regex.compile("|".join(map(regex.escape, parts))) if parts else None
        self.byte_len = np.array([len(b) for b in self.token_bytes], np.int64)
        self.byte_at = np.concatenate(([0], np.cumsum(self.byte_len)[:-1]))
        self.bytes = np.frombuffer(b"".join(self.token_bytes), np.uint8)

    def merge(self, word: bytes) -> list[int]:
        """Ids of one pre-token: lowest rank first, leftmost on ties.

        A heap over a linked list keeps very long words at n log n."""
        ids = [self.byte_id[b] for b in word]
        n, rank = len(ids), self.rank
        if n < 2:
            return ids
        if n <= LONGEST_WORD:
            ranks = [rank.get(p, NEVER) for p in zip(ids, ids[1:], strict=False)]
            while (best := min(ranks)) < NEVER:
                i = ranks.index(best)
                ids[i : i + 2] = [self.made[best]]
                del ranks[i]
                if not ranks:
                    break
                if i:
                    ranks[i - 1] = rank.get((ids[i - 1], ids[i]), NEVER)
                if i < len(ranks):
                    ranks[i] = rank.get((ids[i], ids[i + 1]), NEVER)
            return ids
        left, right, alive = [*range(-1, n - 1)], [*range(1, n + 1)], [True] * n
        heap = [(r, i, ids[i], ids[i + 1]) for i in range(n - 1) if (r := rank.get((ids[i], ids[i + 1]))) is not None]
        heapq.heapify(heap)
        while heap:
            r, i, a, b = heapq.heappop(heap)
            new = self.made[r]
            j = right[i] if alive[i] else n
            if j >= n or ids[i] != a or ids[j] != b:
                continue
            ids[i], alive[j], right[i] = new, False, right[j]
            if right[i] < n:
                left[right[i]] = i
                if (r := rank.get((new, ids[right[i]]))) is not None:
                    heapq.heappush(heap, (r, i, new, ids[right[i]]))
            if left[i] >= 0 and (r := rank.get((ids[left[i]], new))) is not None:
                heapq.heappush(heap, (r, left[i], ids[left[i]], new))
        return [x for x, keep in zip(ids, alive, strict=True) if keep]

    def pretokens(self, text: str) -> list[tuple[str, int]]:
        """(pre-token, -1) or (special text, id), in order."""
        if self.split is None or not self.split.search(text):
            return [(w, -1) for w in PRETOKEN.findall(text)]
        out, at = [], 0
        for m in self.split.finditer(text):
            out += [(w, -1) for w in PRETOKEN.findall(text[at : m.start()])]
            out.append((m.group(), self.special[m.group()]))
            at = m.end()
        return out + [(w, -1) for w in PRETOKEN.findall(text[at:])]


def compile_lexicon(entries: Iterable[tuple[bytes, list[int]]]) -> dict[str, np.ndarray]:
    """The minimal acyclic transducer of sorted distinct words.

    Built incrementally (Daciuk et al., 2000): after each word the part of the
    previous word's path that it leaves is frozen, each state being replaced by
    an equal one if there is any.  A transition's output is the number of words
    that sort before those below it, so outputs along a path sum to the rank.
    """
    register: dict[tuple, int] = {}
    frozen: list[tuple[bool, tuple]] = []
    below: list[int] = []

    def freeze(node: list) -> int:
        key = (node[0], tuple(node[1]))
        if key not in register:
            register[key] = len(frozen)
            frozen.append(key)
            below.append(int(node[0]) + sum(below[t] for _, t in node[1]))
        return register[key]

    path: list[list] = [[False, []]]
    last, ids = b"", []
    for word, out in entries:
        common = 0
        while common < min(len(word), len(last)) and word[common] == last[common]:
            common += 1
        while len(path) > common + 1:
            child = freeze(path.pop())
            path[-1][1].append((last[len(path) - 1], child))
        for _ in word[common:]:
            path.append([False, []])
        path[-1][0] = True
        ids.append(out)
        last = word
    while len(path) > 1:
        child = freeze(path.pop())
        path[-1][1].append((last[len(path) - 1], child))
    root = freeze(path[0])
    keys, targets, outputs = [], [], []
    for state, (final, edges) in enumerate(frozen):
        seen = int(final)
        for label, target in edges:
            keys.append(state << 8 | label)
            targets.append(target)
            outputs.append(seen)
            seen += below[target]
    lengths = np.array([len(x) for x in ids], np.int64)
    return {
        "keys": np.array(keys, np.int64), "targets": np.array(targets, np.int64), "outputs": np.array(outputs, np.int64),
        "final": np.array([f for f, _ in frozen], bool), "root": np.array([root], np.int64),
        "id_at": np.concatenate(([0], np.cumsum(lengths))).astype(np.int64), "ids": np.array([i for x in ids for i in x], np.uint32),
    }


class Lexicon:
    """Looks words up in a compiled transducer, all words one byte at a time."""

    def __init__(self, arrays: dict[str, np.ndarray]):
        self.a = arrays

    def ranks(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """The rank of each word, -1 if it is not in the lexicon."""
        keys, targets, outputs = self.a["keys"], self.a["targets"], self.a["outputs"]
        n = len(offsets) - 1
        out = np.full(n, -1, np.int64)
        live = np.arange(n) if len(keys) else np.arange(0)
        state, total, depth = np.full(len(live), self.a["root"][0]), np.zeros(len(live), np.int64), 0
        length = np.diff(offsets)
        while len(live):
            done = length[live] == depth
            ends = live[done]
            hit = self.a["final"][state[done]]
            out[ends[hit]] = total[done][hit]
            live, state, total = live[~done], state[~done], total[~done]
            if not len(live):
                break
            want = (state << 8 | data[offsets[live] + depth]).astype(keys.dtype)
            at = np.minimum(np.searchsorted(keys, want), len(keys) - 1)
            ok = keys[at] == want
            live, state, total = live[ok], targets[at[ok]], total[ok] + outputs[at[ok]]
            depth += 1
        return out


def pieces(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Start of each piece: rows cut before every single space between other characters.

    No pre-token reaches over such a space except by starting with it, so
    pieces can be split into pre-tokens on their own."""
    n = len(data)
    cut = np.zeros(n, bool)
    if n > 2:
        # neighbours must plainly be no white space: visible ASCII, or a letter
        # of the two-byte range that begins with 0xC3 to 0xCF
        before = ((data > 32) & (data < 127)) | ((data >= 0x80) & (data < 0xC0))
        before[1:] &= (data[1:] < 0x80) | ((data[:-1] >= 0xC3) & (data[:-1] <= 0xCF))
        after = ((data > 32) & (data < 127)) | ((data >= 0xC3) & (data <= 0xCF))
        cut[1:-1] = (data[1:-1] == 32) & before[:-2] & after[2:]
    cut[offsets[:-1][offsets[:-1] < n]] = True
    return np.flatnonzero(cut)


class Encoder:
    """Encodes Arrow text columns; keeps a bounded memory of words that it merged."""

    def __init__(self, bpe: ByteBpe, lexicon: Lexicon):
        self.bpe, self.lexicon = bpe, lexicon
        self.merged: dict[bytes, list[int]] = {}

    def words(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of distinct pre-tokens: flat ids, first index and count of each."""
        data, offsets = flat(column)
        rank = self.lexicon.ranks(data, offsets)
        known, at = self.lexicon.a["ids"], self.lexicon.a["id_at"]
        begin, count = at[rank].astype(np.int64), (at[np.minimum(rank + 1, len(at) - 1)] - at[rank]).astype(np.int64)
        new: list[int] = []
        unseen, raw = np.flatnonzero(rank < 0), data.tobytes()
        counts, merged = [], self.merged
        for a, b in zip(offsets[unseen].tolist(), offsets[unseen + 1].tolist(), strict=True):
            word = raw[a:b]
            ids = merged.get(word)
            if ids is None:
                ids = self.bpe.merge(word)
                if b - a <= LONGEST_WORD:
                    if len(merged) >= REMEMBERED:
                        merged.clear()
                    merged[word] = ids
            counts.append(len(ids))
            new += ids
        if len(unseen):
            count[unseen] = counts
            begin[unseen] = len(known) + np.concatenate(([0], np.cumsum(counts)[:-1]))
        return np.concatenate((known, np.array(new, np.uint32))), begin, count

    def __call__(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids of all rows, and n + 1 offsets into them."""
        starts = pieces(data, offsets)
        if not len(starts):
            return np.zeros(0, np.uint32), np.zeros(len(offsets), np.int64)
        column = strings(data, np.append(starts, len(data)), pa.large_string()).dictionary_encode()
        distinct, which = column.dictionary, column.indices.to_numpy()
        single = pc.match_substring_regex(distinct, ONE_TOKEN)
        number: dict[str, int] = {}
        first = pc.sum(single).as_py() or 0
        tokens, special, lengths = [], {}, []
        for piece in distinct.filter(pc.invert(single)).to_pylist():
            found = self.bpe.pretokens(piece)
            for word, sid in found:
                k = number.setdefault(word if sid < 0 else f"\0special{sid}", len(number))
                if sid >= 0:
                    special[first + k] = sid
                tokens.append(first + k)
            lengths.append(len(found))
        ids, begin, count = self.words(pa.concat_arrays([distinct.filter(single), pa.array(list(number), pa.large_string())]))
        if special:
            ids = np.concatenate((ids, np.array([*special.values()], np.uint32)))
            for j, k in enumerate(special):
                begin[k], count[k] = len(ids) - len(special) + j, 1
        # tokens of each distinct piece, ids of each distinct piece, then of each piece in place
        single = single.to_numpy(zero_copy_only=False)
        per_piece = np.ones(len(distinct), np.int64)
        per_piece[~single] = lengths
        of_single = np.repeat(single, per_piece)
        words = np.empty(len(of_single), np.int64)
        words[of_single] = np.arange(first)
        words[~of_single] = tokens
        sums = np.concatenate(([0], np.cumsum(count[words])))
        piece_at = sums[np.concatenate(([0], np.cumsum(per_piece)))]
        piece_count = np.diff(piece_at)
        piece_ids = gather(ids, begin[words], count[words])
        out = gather(piece_ids, piece_at[which], piece_count[which])
        ends = np.concatenate(([0], np.cumsum(piece_count[which])))
        return out, ends[np.searchsorted(starts, offsets)]


def decode(bpe: ByteBpe, ids: np.ndarray) -> bytes:
    """UTF-8 of the text that ids decode to; broken sequences become U+FFFD."""
    raw = gather(bpe.bytes, bpe.byte_at[ids], bpe.byte_len[ids]).tobytes()
    return raw.decode("utf-8", "replace").encode()


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Frequencies of pieces' pre-tokens in this partition."""
    total: Counter = Counter()

    def out() -> pa.RecordBatch:
        rows = [(w, c) for w, c in total.items() if len(w) <= LONGEST_WORD]
        total.clear()
        return pa.RecordBatch.from_arrays([pa.array([w for w, _ in rows], pa.string()), pa.array([c for _, c in rows], pa.int64())], ["word", "n"])

    for batch in batches:
        data, offsets = flat(batch.column(0))
        for a, b in slices(offsets, SLICE_BYTES):
            part, offs = data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
            starts = pieces(part, offs)
            if not len(starts):
                continue
            counts = strings(part, np.append(starts, len(part)), pa.large_string()).value_counts()
            single = pc.match_substring_regex(counts.field(0), ONE_TOKEN)
            for piece, n in zip(counts.field(0).filter(single).to_pylist(), counts.field(1).filter(single).to_pylist(), strict=True):
                total[piece] += n
            for piece, n in zip(counts.field(0).filter(pc.invert(single)).to_pylist(), counts.field(1).filter(pc.invert(single)).to_pylist(), strict=True):
                for word in PRETOKEN.findall(piece):
                    total[word] += n
            if len(total) > 2 * REMEMBERED:  # memory stays bounded; Spark adds the parts up
                yield out()
    yield out()


def frequent_words(texts: DataFrame, words: int = LEXICON_WORDS) -> list[str]:
    """The most frequent pre-tokens over all texts, at most `words` of them."""
    counts = staged(texts.mapInArrow(_counted, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")))
    # a bound found by counting: what reaches the driver has fewer than `words` rows, from all tasks together
    least = kth_largest(counts.select(F.col("n").cast("double").alias("n")), "n", words)
    return [r.word for r in counts.where(F.col("n") > least).select("word").collect()]


def publish_lexicon(spark: SparkSession, bpe: ByteBpe, words: Iterable[str]) -> str:
    """Compile, save, and hand to all executors; returns the file's name."""
    arrays = compile_lexicon((w, bpe.merge(w)) for w in sorted({w.encode() for w in words}))
    # the driver's own copy, which executors fetch from it as long as it runs
    folder = tempfile.mkdtemp()
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    name = f"lexicon-{uuid.uuid4().hex}.npy"  # added files are known by name, for good
    # one flat int32 file, so that it can be mapped: a table of lengths, then the arrays
    parts = [arrays[k].astype(np.int32) for k in sorted(arrays)]
    np.save(os.path.join(folder, name), np.concatenate([np.array([len(parts), *map(len, parts)], np.int32), *parts]))
    spark.sparkContext.addFile(os.path.join(folder, name))
    return name


def map_lexicon(path: str) -> Lexicon:
    raw = np.load(path, mmap_mode="r")
    lengths = raw[1 : 1 + int(raw[0])]
    ends = 1 + int(raw[0]) + np.cumsum(lengths, dtype=np.int64)
    arrays = {k: raw[e - n : e] for k, e, n in zip(sorted(["keys", "targets", "outputs", "final", "root", "id_at", "ids"]), ends, lengths, strict=True)}
    return Lexicon(arrays | {"final": arrays["final"].astype(bool), "ids": arrays["ids"].view(np.uint32)})


@lru_cache(2)
def _encoder(vocabulary: str, lexicon: str) -> Encoder:
    return Encoder(ByteBpe(vocabulary), map_lexicon(SparkFiles.get(lexicon)))


def encode(docs: DataFrame, vocabulary: str, key: str = "doc_id", text: str = "text", with_ids: bool = False, lexicon_words: int = LEXICON_WORDS) -> DataFrame:
    """Encode every whole text and decode it again.

    vocabulary is the path of a tokenizers JSON file that each worker has.
    with_ids adds the ids themselves as array<int>."""
    spark = docs.sparkSession
    lexicon = publish_lexicon(spark, ByteBpe(vocabulary), frequent_words(docs.select(F.col(text)), lexicon_words))
    schema = f"{key} {dict(docs.dtypes)[key]}, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * with_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _encoder(vocabulary, lexicon)
        for batch in batches:
            data, offsets = flat(batch.column(1))
            for a, b in slices(offsets, SLICE_BYTES):
                part, offs = data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
                ids, at = coder(part, offs)
                rows = [ids[at[i] : at[i + 1]] for i in range(b - a)]
                columns = [
                    batch.column(0).slice(a, b - a), pa.array([len(r) for r in rows], pa.int64()),
                    pa.array([hashlib.sha256(r.astype("<u4").tobytes()).hexdigest() for r in rows], pa.string()),
                    pa.array([hashlib.sha256(decode(coder.bpe, r)).hexdigest() for r in rows], pa.string()),
                ]
                if with_ids:
                    columns.append(pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(ids.astype(np.int32), pa.int32())))
                yield pa.RecordBatch.from_arrays(columns, [key, "n_tokens", "ids_sha256", "decoded_sha256", *["ids"] * with_ids])

    return docs.select(F.col(key), F.col(text)).mapInArrow(run, schema)


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op8_transducer_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode(table(spark, sf_dir, "documents"), default_vocabulary())
