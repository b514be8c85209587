"""Operator 11: byte-level BPE whose pre-tokens are found by an associative scan.

Pre-tokenisation follows public_tokenizers.PATTERN without any regular
expression.  An array gives every code point its class (letter, number, other
white space, space, symbol); what a character needs to know of its neighbours
(is the one before of its class, does white space follow, does a contraction
begin) is compared at once for all characters.  Each character then is a
function on the four states of a small automaton, packed in one byte (two bits
a state).  Composition is associative and is one lookup in a 256 x 256 table, so
a prefix scan in blocks gives the state before every character, and with it
whether a token begins there.  The first character of a row is a constant
function, so that all rows of an Arrow column are scanned as one; a window ends
with a state that the next one starts from, so that a very long text needs no
more temporaries than a short one.

The slices between boundaries are made distinct; each distinct one is taken whole
if the vocabulary has it, else looked up in a bounded memory of merged slices,
else merged by the lowest rank: slices of one length are merged together, one
merge of each in a step, long ones by operator 8's heap.
Token and row offsets are kept: decoding is one gather of the tokens' bytes, cut
at these offsets, and `with_ids` hands out, for each id, the byte at which its
text begins.

Classes are those of the tiktoken library's own Unicode tables, which are newer
than Python's: it is asked once, in each worker, about every code point.

Defined results: a null or empty text encodes to no ids (digests of no bytes);
texts of any length are taken whole, a slice of any length (white space, digits)
is merged in n log n; a decoding that is cut inside a character is bytes, hence
the digest of bytes; repeated rows and null ids are kept; an empty table gives an
empty result; only the id and text columns of the input are used.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .bpe import LONGEST_WORD, NEVER, REMEMBERED, ByteBpe
from .shared import table
from .textkernel import flat, gather, slices, strings

SLICE_BYTES = 4 << 20
#: Code points that are scanned at a time; temporaries are about 20 bytes for each.
WINDOW = 1 << 20
#: Slices of one length that are merged together.
TOGETHER = 1 << 14
#: Characters of one block of the scan.
BLOCK = 64

SYMBOL, LETTER, NUMBER, WHITE, SPACE = range(5)
#: States: nothing to go on with; a run of one class; a space that waits for its word; inside a contraction.
FRESH, RUN, PREFIX, INSIDE = range(4)
#: What follows the apostrophe of a contraction.
SUFFIXES = ["s", "t", "re", "ve", "m", "ll", "d"]
#: What a character is to the automaton, and (a token begins, next state) from each state.
OTHER, SAME, APOSTROPHE, SAME_APOSTROPHE, LAST_SPACE, LAST_WHITE, FIRST_OF_TWO = range(7)
STEPS = {
    OTHER: [(1, RUN), (1, RUN), (0, RUN), (0, FRESH)],
    SAME: [(1, RUN), (0, RUN), (0, RUN), (0, FRESH)],
    APOSTROPHE: [(1, INSIDE), (1, INSIDE), (0, RUN), (0, FRESH)],
    SAME_APOSTROPHE: [(1, INSIDE), (0, RUN), (0, RUN), (0, FRESH)],
    LAST_SPACE: [(1, PREFIX)] * 4,
    LAST_WHITE: [(1, FRESH)] * 4,
    FIRST_OF_TWO: [(1, RUN), (1, RUN), (0, RUN), (0, INSIDE)],
}
BEGINS = np.array([[begins for begins, _ in STEPS[k]] for k in range(len(STEPS))], bool).ravel()
#: The packed function of each kind, and after them those of a row's first character, which forget the state.
PACKED = np.array([sum(to << 2 * s for s, (_, to) in enumerate(STEPS[k])) for k in range(len(STEPS))] + [STEPS[k][FRESH][1] * 0b01010101 for k in range(len(STEPS))], np.uint8)
IDENTITY = sum(s << 2 * s for s in range(4))


def _compositions() -> np.ndarray:
    """[first << 8 | second]: the packed function that applies first, then second."""
    first, second = np.divmod(np.arange(1 << 16), 256)
    return sum(((second >> 2 * ((first >> 2 * s) & 3)) & 3) << 2 * s for s in range(4)).astype(np.uint8)


COMPOSE = _compositions()


@lru_cache(1)
def classes() -> np.ndarray:
    """The class of every code point."""
    import tiktoken

    everything = "".join(map(chr, chain(range(0xD800), range(0xE000, 0x110000))))
    found = np.full(0x110000, SYMBOL, np.uint8)
    for pattern, kind in ((r"\p{L}", LETTER), (r"\p{N}", NUMBER), (r"\s", WHITE)):
        one = tiktoken.Encoding("class", pat_str=pattern, mergeable_ranks={bytes([b]): b for b in range(256)}, special_tokens={})
        members = bytes(one.encode_ordinary(everything)).decode()  # what does not match is left out
        found[np.frombuffer(members.encode("utf-32-le"), np.uint32)] = kind
    found[32] = SPACE
    return found


def states(steps: np.ndarray, state: int) -> np.ndarray:
    """The state before each of the packed functions, and after the last one."""
    n = len(steps)
    out = np.empty(n + 1, np.uint8)
    out[0] = state
    if n <= BLOCK:
        for i, step in enumerate(steps.tolist()):
            state = step >> 2 * state & 3
            out[i + 1] = state
        return out
    blocks = -(-n // BLOCK)
    padded = np.full(blocks * BLOCK, IDENTITY, np.uint8)
    padded[:n] = steps
    by_place = padded.reshape(blocks, BLOCK).T.copy()  # row j: the j-th character of every block
    for j in range(1, BLOCK):
        by_place[j] = COMPOSE.take(by_place[j - 1].astype(np.uint16) << 8 | by_place[j])
    before = states(by_place[-1], state)[:-1]
    out[1:] = (by_place >> (2 * before) & 3).T.reshape(-1)[:n]
    return out


def kinds(points: np.ndarray, a: int, b: int, first: np.ndarray) -> np.ndarray:
    """What characters a to b are to the automaton; first are those that begin a row.

    Looks one character back and two ahead, never over a row's end (0 stands there)."""
    table, n = classes(), len(points)
    around = np.zeros(b - a + 3, np.int64)
    lead, tail = min(a, 1), min(n - b, 2)
    around[1 - lead : b - a + 1 + tail] = points[a - lead : b + tail]
    begins = np.ones(b - a + 3, bool)  # as if another row stood on either side
    begins[1 - lead : b - a + 1 + tail] = first[a - lead : b + tail]
    past, here, one, two = around[:-3], around[1:-2], around[2:-1].copy(), around[3:].copy()
    one[begins[2:-1]] = 0
    two[begins[2:-1] | begins[3:]] = 0
    kind = table[here]
    same = (np.minimum(kind, WHITE) == np.minimum(table[past], WHITE)) & ~begins[1:-2]
    out = same.astype(np.uint8)  # OTHER or SAME
    final = (kind >= WHITE) & (table[one] < WHITE) & ~begins[2:-1]
    out[final] = np.where(kind[final] == SPACE, LAST_SPACE, LAST_WHITE)
    contraction = np.zeros(b - a, bool)
    for suffix in SUFFIXES:
        found = one == ord(suffix[0])
        if len(suffix) == 2:
            found &= two == ord(suffix[1])
            # its first letter, after any apostrophe: only from INSIDE does it differ from another letter
            out[(past == 39) & (here == ord(suffix[0])) & (one == ord(suffix[1])) & ~begins[1:-2]] = FIRST_OF_TWO
        contraction |= found
    out[(here == 39) & contraction] += APOSTROPHE
    return out


def boundaries(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Byte position of the first character of every pre-token of these rows of UTF-8."""
    if not len(data):
        return np.zeros(0, np.int64)
    character = (data & 0xC0) != 0x80
    points = data if character.all() else np.frombuffer(data.tobytes().decode().encode("utf-32-le"), np.uint32)
    starts = offsets[:-1][np.diff(offsets) > 0]
    rows = starts if len(points) == len(data) else np.concatenate(([0], np.cumsum(character)))[starts]
    first = np.zeros(len(points), bool)
    first[rows] = True
    begins, state = np.empty(len(points), bool), FRESH
    for a in range(0, len(points), WINDOW):
        b = min(a + WINDOW, len(points))
        kind = kinds(points, a, b, first)
        found = states(PACKED[kind + first[a:b] * np.uint8(len(STEPS))], state)
        begins[a:b] = BEGINS[kind * np.uint8(4) + found[:-1]] | first[a:b]
        state = int(found[-1])
    mask = np.zeros(len(data), bool)
    mask[character] = begins
    return np.flatnonzero(mask)


class RankBpe(ByteBpe):
    """A byte-level BPE vocabulary read from a file of tokens and ranks; a token's rank is its id."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, filter(bytes.strip, f))}
        self.token_bytes = [b""] * (max(self.ranks.values()) + 1)
        for token, i in self.ranks.items():
            self.token_bytes[i] = token
        self.byte_id = [self.ranks[bytes([b])] for b in range(256)]
        self.made = range(len(self.token_bytes))
        # every way to make a token of two others; a pair's rank is that of what it makes
        self.rank = {(self.ranks[t[:k]], self.ranks[t[k:]]): i for t, i in self.ranks.items() for k in range(1, len(t)) if t[:k] in self.ranks and t[k:] in self.ranks}
        pairs = np.array([[a << 32 | b, i] for (a, b), i in self.rank.items()], np.int64)
        self.pair_keys, self.pair_ranks = pairs[order := np.argsort(pairs[:, 0]), 0], pairs[order, 1]
        self.id_of_byte = np.array(self.byte_id, np.int64)
        self.byte_len = np.array([len(b) for b in self.token_bytes], np.int64)
        self.byte_at = np.concatenate(([0], np.cumsum(self.byte_len)[:-1]))
        self.bytes = np.frombuffer(b"".join(self.token_bytes), np.uint8)
        shown = [b"%d," % i for i in range(len(self.token_bytes))]
        self.shown_len = np.array([len(s) for s in shown], np.int64)
        self.shown_at = np.concatenate(([0], np.cumsum(self.shown_len)[:-1]))
        self.shown = np.frombuffer(b"".join(shown), np.uint8)


    def ranks_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """What pairs of tokens make, NEVER where they make none."""
        keys = left << 32 | right
        at = np.minimum(np.searchsorted(self.pair_keys, keys), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[at] == keys, self.pair_ranks[at], NEVER)

    def merge_alike(self, words: list[bytes]) -> list[list[int]]:
        """Ids of words of one length: every word is merged once a step, the leftmost of its lowest ranks, until none is left."""
        out: list[list[int]] = [[]] * len(words)
        ids, rows = self.id_of_byte[np.frombuffer(b"".join(words), np.uint8).reshape(len(words), -1)], np.arange(len(words))
        ranks = self.ranks_of(ids[:, :-1], ids[:, 1:])
        while ids.shape[1] > 1 and len(rows):
            best = ranks.argmin(axis=1)
            made = ranks[np.arange(len(rows)), best]
            more = made < NEVER
            for row, found in zip(rows[~more].tolist(), ids[~more].tolist(), strict=True):
                out[row] = found
            ids, ranks, rows, best, made = ids[more], ranks[more], rows[more], best[more], made[more]
            at, place = np.arange(len(rows)), np.arange(ids.shape[1] - 1)
            ids = np.where(place <= best[:, None], ids[:, :-1], ids[:, 1:])
            ids[at, best] = made
            ranks = np.where(place[:-1] < best[:, None], ranks[:, :-1], ranks[:, 1:])
            inner = best > 0
            ranks[at[inner], best[inner] - 1] = self.ranks_of(ids[at[inner], best[inner] - 1], made[inner])
            inner = best < ids.shape[1] - 1
            ranks[at[inner], best[inner]] = self.ranks_of(made[inner], ids[at[inner], best[inner] + 1])
        for row, found in zip(rows.tolist(), ids.tolist(), strict=True):
            out[row] = found
        return out

    def merge_all(self, words: list[bytes]) -> list[list[int]]:
        """Ids of words that are no tokens: those of a length together, long or lone ones by themselves."""
        out: list[list[int]] = [[]] * len(words)
        by_length: dict[int, list[int]] = {}
        for i, word in enumerate(words):
            by_length.setdefault(len(word), []).append(i)
        for length, which in by_length.items():
            for k in range(0, len(which), TOGETHER):
                part = which[k : k + TOGETHER]
                some = [words[i] for i in part]
                for i, ids in zip(part, self.merge_alike(some) if length <= LONGEST_WORD and len(part) > 8 else map(self.merge, some), strict=True):
                    out[i] = ids
        return out


class ScanEncoder:
    """Encodes flat text columns; remembers a bounded number of merged slices."""

    def __init__(self, bpe: RankBpe):
        self.bpe = bpe
        self.merged: dict[bytes, list[int]] = {}

    def __call__(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids of all rows, and n + 1 offsets into them."""
        starts = boundaries(data, offsets)
        if not len(starts):
            return np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
        column = strings(data, np.append(starts, len(data))).dictionary_encode()
        words, merged, ranks = column.dictionary.to_pylist(), self.merged, self.bpe.ranks
        distinct = [[rank] if (rank := ranks.get(w)) is not None else merged.get(w) for w in words]
        unseen = [i for i, ids in enumerate(distinct) if ids is None]
        for i, ids in zip(unseen, self.bpe.merge_all([words[i] for i in unseen]), strict=True):
            distinct[i] = ids
            if len(words[i]) <= LONGEST_WORD:
                if len(merged) >= REMEMBERED:
                    merged.clear()
                merged[words[i]] = ids
        count = np.fromiter(map(len, distinct), np.int64, len(distinct))
        pool = np.fromiter(chain.from_iterable(distinct), np.int64, int(count.sum()))
        begin = np.concatenate(([0], np.cumsum(count)[:-1]))
        which = column.indices.to_numpy()
        each = count[which]
        ends = np.concatenate(([0], np.cumsum(each)))
        return gather(pool, begin[which], each), ends[np.searchsorted(starts, offsets)]


def decoded(bpe: RankBpe, ids: np.ndarray, at: np.ndarray) -> tuple[bytes, np.ndarray]:
    """The bytes of all rows' ids, and n + 1 offsets of rows in them."""
    lengths = bpe.byte_len[ids]
    return gather(bpe.bytes, bpe.byte_at[ids], lengths).tobytes(), np.concatenate(([0], np.cumsum(lengths)))[at]


def shown(bpe: RankBpe, ids: np.ndarray, at: np.ndarray) -> tuple[bytes, np.ndarray]:
    """All rows' ids in decimal, each with a comma after it, and n + 1 offsets of rows in them."""
    lengths = bpe.shown_len[ids]
    return gather(bpe.shown, bpe.shown_at[ids], lengths).tobytes(), np.concatenate(([0], np.cumsum(lengths)))[at]


def default_ranks() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@lru_cache(2)
def coder(path: str) -> ScanEncoder:
    return ScanEncoder(RankBpe(path))


def encode(docs: DataFrame, ranks: str | None = None, key: str = "doc_id", text: str = "text", with_ids: bool = False) -> DataFrame:
    """Encode every whole text and decode it again: key, n_tokens, ids_sha256, decoded_sha256.

    ranks is the path of a file of tokens and ranks that each worker has.  with_ids
    adds ids array<int> and starts array<long>, the byte of the text at which each begins."""
    path = ranks or default_ranks()
    fields = [T.StructField(key, docs.schema[key].dataType), T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType())]
    if with_ids:
        fields += [T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("starts", T.ArrayType(T.LongType()))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = coder(path)
        for batch in batches:
            data, offsets = flat(batch.column(1))
            for a, b in slices(offsets, SLICE_BYTES):
                ids, at = encoder(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                back, back_at = decoded(encoder.bpe, ids, at)
                names, names_at = shown(encoder.bpe, ids, at)
                columns = [
                    batch.column(0).slice(a, b - a), pa.array(np.diff(at)),
                    pa.array([hashlib.sha256(names[i : max(i, j - 1)]).hexdigest() for i, j in zip(names_at[:-1].tolist(), names_at[1:].tolist(), strict=True)], pa.string()),
                    pa.array([hashlib.sha256(back[i:j]).hexdigest() for i, j in zip(back_at[:-1].tolist(), back_at[1:].tolist(), strict=True)], pa.string()),
                ]
                if with_ids:
                    begin = np.cumsum(encoder.bpe.byte_len[ids]) - encoder.bpe.byte_len[ids] - np.repeat(back_at[:-1], np.diff(at))
                    columns += [pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(ids, pa.int32())), pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(begin, pa.int64()))]
                yield pa.RecordBatch.from_arrays(columns, [f.name for f in fields])

    return docs.select(F.col(f"`{key}`"), F.col(f"`{text}`")).mapInArrow(run, T.StructType(fields))


def decode(encoded: DataFrame, ranks: str | None = None, ids: str = "ids", into: str = "bytes") -> DataFrame:
    """encoded with the bytes that its ids (array<int>) decode to; null for null."""
    path = ranks or default_ranks()

    @F.arrow_udf("binary")
    def back(lists: pa.Array) -> pa.Array:
        at = lists.offsets.to_numpy().astype(np.int64)
        values = lists.values.to_numpy(zero_copy_only=False).astype(np.int64)[at[0] : at[-1]] if len(lists) else np.zeros(0, np.int64)
        raw, ends = decoded(coder(path).bpe, values, at - at[0] if len(at) else np.zeros(1, np.int64))
        missing = lists.is_null().to_pylist()
        return pa.array([None if gone else raw[i:j] for i, j, gone in zip(ends[:-1].tolist(), ends[1:].tolist(), missing, strict=True)], pa.binary())

    return encoded.withColumn(into, back(F.col(f"`{ids}`")))


def op11_scan_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode(table(spark, sf_dir, "documents"))
