"""Operator 7: removal of repeated passages by Rabin-Karp window hashes.

A window of WINDOW consecutive words is repeated if its word sequence starts
anywhere else, in the same document or another.  Every window is hashed by
rolling (prefix-sum) Rabin-Karp; hashes are counted in Spark; the windows that
are repeated merge into maximal intervals, which are cut out.

Counting all windows would shuffle one hash a word.  So windows are first
represented by the least hash among the shorter windows (WINDOW // 2 + 1 words)
inside them, which depends on their words alone: equal windows have equal
representatives, and about one word in nine is the place of one.
Representatives are counted first, and a window whose representative occurs
once cannot be repeated; full window hashes are then counted for all others.

Counting is the same both times.  Each task sorts its hashes, settles those
that it holds twice by itself, and sends every hash once, packed by hash range;
a hash that a third of all rows hold is one entry a task.  A range's task finds
the hashes that came from two tasks, and answers with document keys and places.

Defined results: null and empty texts have no words; texts under WINDOW words
lose none; windows are judged on the input; rows that are equal in doc_id and
text are separate rows and repeat each other; a null doc_id is allowed; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .packing import coarse, ranges_for, spread
from .shared import table
from .textkernel import Words, flat, gather, slices, window_hash, window_starts

WINDOW = 35
#: Hashes that a task holds before it packs and sends them.
ENTRIES = 3_000_000
PACKED = "range int, hash binary, owner binary, place binary, twice binary, hit_owner binary, hit_place binary"
DEALT = "slot int, owner binary, place binary"
FOUND = "owner long, places array<int>"
Emit = Callable[[pa.RecordBatch], Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]]


def least_of(values: np.ndarray, span: int) -> np.ndarray:
    """Index of the leftmost least value in values[i : i + span], for each i."""
    index, width = np.arange(len(values)), 1
    while width < span:
        step = min(width, span - width)
        a, b = index[: len(index) - step], index[step:]
        index = np.where(values[a] <= values[b], a, b)
        width += step
    return index


def representatives(words: Words, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start of each k-word window, its representative's word, hash of each word's short window)."""
    short = k // 2 + 1
    starts = window_starts(words.first, k)
    if not len(starts):
        return starts, starts, np.zeros(0, np.uint64)
    # short windows may run over the end of a row here, but never inside a k-word window
    every = np.arange(len(words) - short + 1)
    hashes = window_hash(words.hash, every, short)
    return starts, least_of(hashes, k - short + 1)[starts], hashes


def pack(hashes: np.ndarray, owner: np.ndarray, place: np.ndarray, ranges: int) -> Iterator[pa.RecordBatch]:
    """Settles repeats among these entries, and packs one entry a hash by hash range."""
    order = np.argsort(hashes, kind="stable")
    h, o, p = hashes[order], owner[order], place[order]
    same = h[1:] == h[:-1]
    twice = np.zeros(len(h), bool)
    twice[1:] |= same
    twice[:-1] |= same
    first = np.concatenate((np.ones(min(1, len(h)), bool), ~same))
    single, repeat = first & ~twice, first & twice
    bound = np.array([(i << 64) // ranges for i in range(ranges)], np.uint64)
    cut, cut2 = (np.append(np.searchsorted(x, bound), len(x)) for x in (h[single], h[repeat]))
    hit = np.unique(np.stack([o[twice].view(np.int64), p[twice].astype(np.int64)]), axis=1) if twice.any() else np.zeros((2, 0), np.int64)
    # entries of a range in the order of owners, so that their keys compress
    s_h, s_o, s_p, r_h = h[single], o[single], p[single], h[repeat]
    rows = []
    for i in range(ranges):
        if cut[i] < cut[i + 1] or cut2[i] < cut2[i + 1]:
            mine = slice(cut[i], cut[i + 1])
            by = np.argsort(s_o[mine], kind="stable")
            rows.append((i, s_h[mine][by].tobytes(), s_o[mine][by].tobytes(), s_p[mine][by].astype(np.int32).tobytes(), r_h[cut2[i] : cut2[i + 1]].tobytes(), b"", b""))
    rows += [(i, b"", b"", b"", b"", o.tobytes(), p.tobytes()) for i, o, p in dealt(hit[0], hit[1].astype(np.int32), ranges)]
    if rows:
        columns = list(zip(*rows, strict=True))
        yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int32()), *(pa.array(c, pa.binary()) for c in columns[1:])], [x.split()[0] for x in PACKED.split(", ")])


def dealt(by: np.ndarray, place: np.ndarray, slots: int, owner: np.ndarray | None = None) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(slot, owners, places), dealt by owner, or by another number of each."""
    slot, owner = by % slots, by if owner is None else owner
    order = np.argsort(slot, kind="stable")
    cut = np.searchsorted(slot[order], np.arange(slots + 1))
    for i in range(slots):
        if cut[i] < cut[i + 1]:
            mine = order[cut[i] : cut[i + 1]]
            yield i, owner[mine], place[mine]


def _joined(group: pa.Table, name: str, kind: type) -> np.ndarray:
    return np.frombuffer(b"".join(x.as_py() for x in group.column(name)), kind)


def _recut(group: pa.Table, slots: int, ranges: int) -> pa.Table:
    """Rows of a coarse range of hashes, cut into the fine ranges inside it."""
    hashes, owner, place, twice = (_joined(group, n, k) for n, k in (("hash", np.uint64), ("owner", np.int64), ("place", np.int32), ("twice", np.uint64)))
    share = ranges // slots
    first = int(group.column("range")[0].as_py()) * share
    bound = np.array([(i << 64) // ranges for i in range(first, first + share)], np.uint64)
    order = np.argsort(hashes, kind="stable")
    hashes, owner, place, twice = hashes[order], owner[order], place[order], np.sort(twice)
    cut, cut2 = (np.append(np.searchsorted(x, bound), len(x)) for x in (hashes, twice))
    rows = [(first + i, hashes[cut[i] : cut[i + 1]].tobytes(), owner[cut[i] : cut[i + 1]].tobytes(), place[cut[i] : cut[i + 1]].tobytes(), twice[cut2[i] : cut2[i + 1]].tobytes(), b"", b"") for i in range(share) if cut[i] < cut[i + 1] or cut2[i] < cut2[i + 1]]
    rows += [(first + i, b"", b"", b"", b"", o.tobytes(), p.tobytes()) for i, o, p in dealt(_joined(group, "hit_owner", np.int64), _joined(group, "hit_place", np.int32), share)]
    columns = list(zip(*rows, strict=True)) if rows else [()] * 7
    return pa.Table.from_arrays([pa.array(columns[0], pa.int32()), *(pa.array(c, pa.binary()) for c in columns[1:])], [x.split()[0] for x in PACKED.split(", ")])


def _redeal(group: pa.Table, slots: int, ranges: int) -> pa.Table:
    """Rows of a coarse slot of owners, dealt to the fine slots inside it."""
    first = int(group.column("slot")[0].as_py())
    share = ranges // slots
    owner, place = _joined(group, "owner", np.int64), _joined(group, "place", np.int32)
    rows = [(first + i * slots, o.tobytes(), p.tobytes()) for i, o, p in dealt(owner // slots, place, share, owner)]
    columns = list(zip(*rows, strict=True)) if rows else [()] * 3
    return pa.Table.from_arrays([pa.array(columns[0], pa.int32()), pa.array(columns[1], pa.binary()), pa.array(columns[2], pa.binary())], ["slot", "owner", "place"])


def _settle(slots: int) -> Callable[[pa.Table], pa.Table]:
    def run(group: pa.Table) -> pa.Table:
        """Owners and places of the hashes of one range that are repeated, packed by owner."""
        hashes, owner, place, twice = _joined(group, "hash", np.uint64), _joined(group, "owner", np.int64), _joined(group, "place", np.int32), _joined(group, "twice", np.uint64)
        _, inverse, counts = np.unique(np.concatenate((hashes, twice, twice)), return_inverse=True, return_counts=True)
        found = counts[inverse[: len(hashes)]] > 1
        owner, place = np.concatenate((owner[found], _joined(group, "hit_owner", np.int64))), np.concatenate((place[found], _joined(group, "hit_place", np.int32)))
        rows = [(i, o.tobytes(), p.tobytes()) for i, o, p in dealt(owner, place, slots)]
        columns = list(zip(*rows, strict=True)) if rows else ((), (), ())
        return pa.Table.from_arrays([pa.array(columns[0], pa.int32()), pa.array(columns[1], pa.binary()), pa.array(columns[2], pa.binary())], ["slot", "owner", "place"])

    return run


def _unpack(group: pa.Table) -> pa.Table:
    owner, place = _joined(group, "owner", np.int64), _joined(group, "place", np.int32)
    order = np.argsort(owner, kind="stable")
    owner, place = owner[order], place[order]
    first = np.flatnonzero(np.concatenate((np.ones(min(1, len(owner)), bool), owner[1:] != owner[:-1])))
    lists = pa.ListArray.from_arrays(pa.array(np.append(first, len(owner)), pa.int32()), pa.array(place, pa.int32()))
    return pa.Table.from_arrays([pa.array(owner[first], pa.int64()), lists], ["owner", "places"])


def repeated(rows: DataFrame, emit: Emit, ranges: int) -> DataFrame:
    """(owner, places) of all hashes that emit() yields twice or more over all rows."""
    slots = coarse(ranges)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        size = 0
        for batch in batches:
            for entry in emit(batch):
                held.append(entry)
                size += len(entry[0])
                if size >= ENTRIES:
                    yield from pack(*(np.concatenate(x) for x in zip(*held, strict=True)), slots)
                    held, size = [], 0
        if held:
            yield from pack(*(np.concatenate(x) for x in zip(*held, strict=True)), slots)

    packed = spread(rows.mapInArrow(run, PACKED), PACKED, slots, ranges, _recut)
    found = packed.groupBy("range").applyInArrow(_settle(slots), DEALT)
    return spread(found, DEALT, slots, ranges, _redeal).groupBy("slot").applyInArrow(_unpack, FOUND)


def _word_slices(batch: pa.RecordBatch) -> Iterator[tuple[int, int, Words]]:
    data, offsets = flat(batch.column(1))
    for a, b in slices(offsets):
        yield a, b, Words(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])


def _marks(batch: pa.RecordBatch, a: int, b: int, words: Words) -> np.ndarray:
    """Words of the slice that the batch's list column names."""
    lists = batch.column(2).slice(a, b - a)
    count = np.diff(np.asarray(lists.offsets)) if not lists.null_count else np.array([len(x) if x.is_valid else 0 for x in lists])
    place = np.asarray(lists.flatten())
    # two rows whose names clash have each other's places, which may lie outside
    inside = place < np.repeat(words.counts, count)
    marks = np.zeros(len(words), bool)
    marks[(np.repeat(words.first[:-1], count) + place)[inside]] = True
    return marks


def repeated_windows(docs: DataFrame, k: int = WINDOW) -> DataFrame:
    """(owner, places): first words of the repeated k-word windows of each _owner of docs(doc_id, text, _owner).

    doc_id goes along unused, so that the shuffle of docs by _owner is the one
    that remove_repeats needs as well, and Spark makes it once."""
    ranges = ranges_for(docs)

    def short_hashes(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        owner = batch.column(0).to_numpy()
        for a, b, words in _word_slices(batch):
            _, least, hashes = representatives(words, k)
            least = np.unique(least)
            row = words.row()[least]
            yield hashes[least], owner[a:b][row], least - words.first[row]

    def window_hashes(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        owner = batch.column(0).to_numpy()
        for a, b, words in _word_slices(batch):
            starts, least, _ = representatives(words, k)
            starts = starts[_marks(batch, a, b, words)[least]]
            row = words.row()[starts]
            yield window_hash(words.hash, starts, k), owner[a:b][row], starts - words.first[row]

    short = repeated(docs.select("_owner", "text"), short_hashes, ranges)
    marked = docs.join(short, docs["_owner"] == short["owner"]).select("_owner", "text", "places", "doc_id")
    return repeated(marked, window_hashes, ranges)


def remove_repeats(docs: DataFrame, k: int = WINDOW, with_text: bool = False) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256, intervals of removed words, and the kept text if asked for."""
    keyed = docs.select("doc_id", "text", F.xxhash64("doc_id", "text").alias("_owner"))
    found = repeated_windows(keyed, k)
    joined = keyed.join(found, keyed["_owner"] == found["owner"], "left").select("doc_id", "text", "places")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, words in _word_slices(batch):
                edge = np.zeros(len(words) + k + 1, np.int32)
                starts = np.flatnonzero(_marks(batch, a, b, words))
                stops = np.minimum(starts + k, words.first[1:][words.row()[starts]])
                np.add.at(edge, starts, 1)
                np.add.at(edge, stops, -1)
                gone = np.cumsum(edge[: len(words)]) > 0
                row = words.row()
                n, removed = words.counts, np.bincount(row[gone], minlength=b - a)
                # kept words, each with a space after it, then cut by row
                kept = ~gone
                length = (words.end - words.start)[kept] + 1
                spaced = np.append(words.data, np.uint8(32))
                out = gather(spaced, words.start[kept], length)
                ends = np.cumsum(length)
                out[ends - 1] = 32
                cut = np.concatenate(([0], ends))[np.concatenate(([0], np.cumsum(n - removed)))]
                raw = out.tobytes()
                texts = [raw[x : max(x, y - 1)] for x, y in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True)]
                # maximal intervals [first, last + 1) of removed words, as word numbers of the row
                new_row = np.zeros(len(words) + 1, bool)
                new_row[words.first] = True
                rise = gone & ~np.concatenate(([False], gone))[:-1] | gone & new_row[:-1]
                fall = gone & ~np.concatenate((gone, [False]))[1:] | gone & new_row[1:]
                first, last = np.flatnonzero(rise), np.flatnonzero(fall) + 1
                base = words.first[row[first]]
                per = np.concatenate(([0], np.cumsum(np.bincount(row[first], minlength=b - a))))
                pairs = pa.StructArray.from_arrays([pa.array(first - base, pa.int64()), pa.array(last - base, pa.int64())], ["start", "stop"])
                columns = [batch.column(0).slice(a, b - a), pa.array(n, pa.int64()), pa.array(removed, pa.int64()), pa.array([hashlib.sha256(t).hexdigest() for t in texts], pa.string()), pa.ListArray.from_arrays(pa.array(per, pa.int32()), pairs)]
                yield pa.RecordBatch.from_arrays([*columns, *[pa.array(texts, pa.binary()).cast(pa.string())] * with_text], ["doc_id", "n_words", "n_removed", "kept_sha256", "removed", *["kept_text"] * with_text])

    return joined.mapInArrow(run, f"doc_id {dict(docs.dtypes)['doc_id']}, n_words long, n_removed long, kept_sha256 string, removed array<struct<start:long,stop:long>>" + ", kept_text string" * with_text)


def op7_rabin_karp_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents")).drop("removed")


OP7_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
win AS (SELECT rid, i, array_to_string(list_slice(w, i, i + 34), ' ') AS s FROM (SELECT rid, w, unnest(range(1, len(w) - 33)) AS i FROM d)),
rep AS (SELECT rid, i FROM win WHERE s IN (SELECT s FROM win GROUP BY s HAVING count(*) > 1)),
gone AS (SELECT DISTINCT rid, i + unnest(range(0, 35)) AS p FROM rep),
word AS (SELECT rid, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS p FROM d),
kept AS (SELECT word.rid, string_agg(x, ' ' ORDER BY word.p) AS t, count(*) AS n FROM word LEFT JOIN gone ON gone.rid = word.rid AND gone.p = word.p WHERE gone.p IS NULL GROUP BY word.rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept ON kept.rid = d.rid
"""
