"""Operator 6: exact Jaccard join of word-shingle sets by PartEnum signatures.

Documents with equal sets are one node.  Every node's signatures (see
`signatures`) are packed by range; any two similar nodes share one.  The nodes
of a signature are compared by parity sketches: a set's sketch has a bit for
each of about four buckets an element, the parity of the elements that hash
there, so two sketches differ in at most as many bits as their sets differ in
elements, and the comparison never loses a similar pair.  It is made around
leaders (`canopies`), which ties what can be similar, in a number of comparisons
that follows the unlike members of a group, not the copies; leaders stand for
what is near them when a task sends its entries on.  Signatures that are common
in one task, and groups of more than GROUP members, are cut into blocks.

Components of these ties are clusters of sets that are all but similar.  A
cluster's sets are brought together, cut into blocks of BLOCK shingles so that
no task holds more than two blocks however large the cluster, and every pair in
it is verified exactly inside the task by counting common shingles; only a
spanning forest of the links and the number of links of each node leave it.
Components of these are the classes.

Defined results: a document of fewer words than a shingle has its whole
sequence as its one shingle; one without words has none and links with nothing
(its component is its own doc_id); null text is no text; repeated rows are
equal sets; a null doc_id never names a component unless it stands alone; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .components import components
from .packing import coarse, ranges_for, spread
from .shared import staged, table
from .textkernel import Words, flat, gather, mix64, slices, window_hash, window_starts

#: Shingles that a verifying task holds of each side.
BLOCK = 200_000
#: Nodes whose keys are broadcast to fetch their texts; with more, the join is shuffled.
BROADCAST_ROWS = 200_000
#: Signatures that a task holds before it packs and sends them.
ENTRIES = 1_000_000
#: Columns with at least so many sets are compared as bits, others by their pairs.
DENSE = 8
#: Sets of fewer elements are allowed two differences a part, for signatures of more elements.
SMALL = 64
#: Leaders of one signature in one task beyond which their entries do not travel together.
HOT = 512
#: Members, and shingles of members, of one group of nodes with a common signature that a task holds of each side; larger groups are cut.
GROUP, GROUP_SHINGLES = 8_192, 20_000_000
#: Shingles of the members of all small groups that one task compares; a shingle is half a byte of a sketch.
GROUPS_SHINGLES = 60_000_000
PACKED = "range int, signature binary, node binary, a binary, b binary, hot binary, hot_node binary"


def shingle_sets(words: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct k-word shingles of each row, sorted: (flat hashes, n + 1 offsets).

    A row of fewer than k words has its whole sequence as one shingle; a row
    without words has none."""
    rows, row = len(words.offsets) - 1, words.row()
    starts = window_starts(words.first, k)
    values, owner = window_hash(words.hash, starts, k), row[starts]
    few = np.flatnonzero((words.counts > 0) & (words.counts < k))
    for n in range(1, k):
        short = few[words.counts[few] == n]
        if len(short):
            values = np.concatenate((values, mix64(window_hash(words.hash, words.first[short], n) + np.uint64(n))))
            owner = np.concatenate((owner, short))
    order = np.lexsort((values, owner))
    values, owner = values[order], owner[order]
    new = np.ones(len(values), bool)
    new[1:] = (values[1:] != values[:-1]) | (owner[1:] != owner[:-1])
    values, owner = values[new], owner[new]
    return values, np.searchsorted(owner, np.arange(rows + 1))


@lru_cache
def bands(similarity: int) -> tuple[np.ndarray, np.ndarray]:
    """Least set size of each band, and the greatest symmetric difference that two
    similar sets can have if the larger lies in the band (similarity in hundredths)."""
    low, k = [1], []
    while low[-1] < 1 << 40:
        top = low[-1] * 100 // similarity
        k.append((100 - similarity) * 2 * top // (100 + similarity))
        low.append(top + 1)
    return np.array(low), np.array(k)


@lru_cache
def plan(similarity: int, small: bool) -> tuple[int, int, int]:
    """(subparts of a part, differences that a part may have, one in how many parts is slack)."""
    return (5, 2, 0) if small else ((2, 1, 16) if similarity >= 90 else (3, 1, 8))


@lru_cache
def choices(subs: int, differ: int) -> np.ndarray:
    """Columns of 0 and 1: every choice of all subparts but `differ`."""
    out = [[int(i not in left) for i in range(subs)] for left in combinations(range(subs), differ)]
    return np.array(out, np.uint64).T


def signatures(values: np.ndarray, offsets: np.ndarray, similarity: int) -> tuple[np.ndarray, np.ndarray]:
    """(signature, row) of every set, by PartEnum (Arasu, Ganti, Kaushik 2006).

    A set takes part in its own size band and, as the smaller of a pair, in the
    next.  In a band with difference bound k the domain is dealt into parts, each
    part into subparts, and every choice of all subparts but d is a signature:
    where similar sets differ in at most d elements of a part, they share one.
    At most k // (d + 1) parts differ in more.

    Slack: with k // (d + 1) + 1 + 2t parts, 2t + 1 or more parts agree so.  Each
    set then leaves out the t parts whose signatures hold the fewest elements
    (these would tie sets that share next to nothing): what the two leave out
    are 2t parts at most, and one that agrees remains.  No pair is missed."""
    low, _ = bands(similarity)
    sizes = np.diff(offsets)
    own = np.searchsorted(low, sizes, "right") - 1
    out_s, out_r = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    for step in (0, 1):
        for small in (False, True):
            # the band decides, so that both sets of a pair are dealt alike
            have = np.flatnonzero((sizes > 0) & ((low[own + step] < SMALL) == small))
            if len(have):
                sig, row = _of_band(values, offsets, have, own[have] + step, similarity, *plan(similarity, small))
                out_s.append(sig)
                out_r.append(row)
    return np.concatenate(out_s), np.concatenate(out_r)


def _of_band(values: np.ndarray, offsets: np.ndarray, have: np.ndarray, band: np.ndarray, similarity: int, subs: int, differ: int, slack: int) -> tuple[np.ndarray, np.ndarray]:
    sizes = np.diff(offsets)[have]
    least = bands(similarity)[1][band] // (differ + 1) + 1
    left_out = least // slack if slack else np.zeros(len(least), np.int64)
    parts = least + 2 * left_out
    first = np.concatenate(([0], np.cumsum(parts)))
    set_of = np.repeat(np.arange(len(have)), sizes)
    mine = gather(values, offsets[have], sizes)
    h = mix64(mine + np.uint64(0x632BE59BD9B4E019) * band[set_of].astype(np.uint64))
    cell = (h >> np.uint64(32)) % (parts * subs)[set_of].astype(np.uint64)
    at = first[set_of] * subs + cell.astype(np.int64)
    e, cells = mix64(h), int(first[-1]) * subs
    lo = np.bincount(at, (e & np.uint64(0xFFFFFFFF)).astype(np.float64), minlength=cells).astype(np.uint64)
    hi = np.bincount(at, (e >> np.uint64(32)).astype(np.float64), minlength=cells).astype(np.uint64)
    chosen = choices(subs, differ)
    total = (lo + (hi << np.uint64(32))).reshape(-1, subs) @ chosen
    owner = np.repeat(np.arange(len(have)), parts)
    place = (np.arange(len(owner)) - first[owner]).astype(np.uint64)[:, None] * np.uint64(16) + np.arange(chosen.shape[1], dtype=np.uint64)
    sig = mix64(total + mix64(place + (band[owner].astype(np.uint64) << np.uint64(44))[:, None]))
    if left_out.any():
        fewest = (np.bincount(at, minlength=cells).astype(np.uint64).reshape(-1, subs) @ chosen).min(axis=1)
        rank = np.empty(len(owner), np.int64)
        rank[np.lexsort((fewest, owner))] = np.arange(len(owner)) - first[owner]
        keep = rank >= left_out[owner]
        sig, owner = sig[keep], owner[keep]
    return sig.ravel(), np.repeat(have[owner], chosen.shape[1])


def sketches(values: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Parity sketches of the sets: (flat 64-bit words, n + 1 offsets); a power of two of words each."""
    sizes = np.diff(offsets)
    width = 1 << np.ceil(np.log2(np.maximum(1, sizes / 16))).astype(np.int64)
    first = np.concatenate(([0], np.cumsum(width)))
    row = np.repeat(np.arange(len(sizes)), sizes)
    bit = (mix64(values ^ np.uint64(0x5851F42D4C957F2D)) & (width[row] * 64 - 1).astype(np.uint64)).astype(np.int64)
    odd = (np.bincount(first[row] * 64 + bit, minlength=int(first[-1]) * 64) & 1).astype(np.uint8)
    return np.packbits(odd, bitorder="little").view(np.uint64), first


def folded(words: np.ndarray, first: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Sketches of these rows as a matrix, the longer ones folded to the shortest."""
    width = first[rows + 1] - first[rows]
    least = int(width.min())
    out = np.zeros((len(rows), least), np.uint64)
    for w in np.unique(width):
        mine = np.flatnonzero(width == w)
        full = words[first[rows[mine]][:, None] + np.arange(w)]
        out[mine] = np.bitwise_xor.reduce(full.reshape(len(mine), -1, least), axis=1)
    return out


def canopies(bits: np.ndarray, most: int, reach: int) -> tuple[np.ndarray, np.ndarray]:
    """(leader of each sketch or -1, ties as 2 x n indices).

    most: bits by which similar sets differ; reach: by which members may differ
    from what they stand for.  The first sketch that is left leads: what differs
    by at most most // 3 is its own and leaves; what differs by as much more as a
    similar pair of what the two stand for can, is tied to it and stays.  If two
    similar sets are in the group, one of them leaves first, or both at once; by
    the triangle inequality the other is then tied to the same leader."""
    near = most // 3
    far = near + most + 2 * reach
    leader, ties = np.full(len(bits), -1), []
    left = np.arange(len(bits))
    while len(left) > 1:
        apart = np.bitwise_count(bits[left] ^ bits[left[0]]).sum(axis=1, dtype=np.int64)
        tied = left[1:][apart[1:] <= far]
        ties.append(np.stack([np.full(len(tied), left[0]), tied]))
        own = apart <= near
        own[0] = False
        leader[left[own]] = left[0]
        left = left[1:][~own[1:]]
    return leader, np.concatenate(ties, axis=1) if ties else np.zeros((2, 0), np.int64)


def greatest_difference(size: np.ndarray | int, similarity: int) -> np.ndarray | int:
    """The most elements in which two similar sets of at most `size` elements differ."""
    return (100 - similarity) * 2 * size // (100 + similarity)


def labels(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The least of 0 .. n - 1 that each is connected to by ties (a, b)."""
    label = np.arange(n)
    while len(a):
        np.minimum.at(label, a, label[b])
        np.minimum.at(label, b, label[a])
        while (label[label] != label).any():
            label = label[label]
        open_ = label[a] != label[b]
        a, b = label[a[open_]], label[b[open_]]
    return label


def forest(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Ties (a, b) that connect the same as these, fewer than there are nodes."""
    nodes, index = np.unique(np.concatenate((a, b)), return_inverse=True)
    label = labels(len(nodes), index[: len(a)], index[len(a) :])
    tied = np.flatnonzero(label != np.arange(len(nodes)))
    return np.stack([nodes[tied], nodes[label[tied]]])


def groups_of(sig: np.ndarray, node: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start of each run of equal sig, its length, a name of its nodes whatever their sig); sorted by (sig, node)."""
    start = np.flatnonzero(np.concatenate((np.ones(min(1, len(sig)), bool), sig[1:] != sig[:-1])))
    return start, np.diff(np.append(start, len(sig))), np.add.reduceat(mix64(node.view(np.uint64)), start) if len(sig) else np.zeros(0, np.uint64)


def set_node(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """A 64-bit name of each set; 0 for the empty set."""
    sizes = np.diff(offsets)
    have = sizes > 0
    out = np.zeros(len(sizes), np.uint64)
    if have.any():
        first = offsets[:-1][have]
        one, two = np.add.reduceat(mix64(values), first), np.add.reduceat(mix64(values ^ np.uint64(0xA5A5A5A5A5A5A5A5)), first)
        out[have] = mix64(one ^ mix64(two + sizes[have].astype(np.uint64))) | np.uint64(1)
    return out.view(np.int64)


def _sets(batch: pa.RecordBatch, column: int, k: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    data, offsets = flat(batch.column(column))
    for a, b in slices(offsets):
        yield a, b, *shingle_sets(Words(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], lower=True), k)


def _binary(words: np.ndarray, first: np.ndarray) -> pa.Array:
    return pa.Array.from_buffers(pa.large_binary(), len(first) - 1, [None, pa.py_buffer((first * 8).astype(np.int64)), pa.py_buffer(np.ascontiguousarray(words))]).cast(pa.binary())


def profile(keyed: DataFrame, k: int) -> DataFrame:
    """_owner, doc_id, node, n_shingles, sketch of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, values, offsets in _sets(batch, 2, k):
                made = [pa.array(set_node(values, offsets)), pa.array(np.diff(offsets)), _binary(*sketches(values, offsets))]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), batch.column(1).slice(a, b - a), *made], ["_owner", "doc_id", "node", "n_shingles", "sketch"])

    return keyed.select("_owner", "doc_id", "text").mapInArrow(run, f"_owner long, doc_id {dict(keyed.dtypes)['doc_id']}, node long, n_shingles long, sketch binary")


class Chunk:
    """Nodes of a task, their signatures and sketches, until they are packed and sent."""

    def __init__(self, similarity: int):
        self.similarity = similarity
        self.clear()

    def clear(self) -> None:
        self.held: list[tuple[np.ndarray, ...]] = []
        self.entries, self.nodes, self.seen = 0, 0, np.zeros(0, np.int64)

    def add(self, values: np.ndarray, offsets: np.ndarray) -> None:
        node = set_node(values, offsets)
        fresh = np.zeros(len(node), bool)
        fresh[np.unique(node, return_index=True)[1]] = True
        fresh &= (node != 0) & ~np.isin(node, self.seen)
        if not fresh.any():
            return
        sizes = np.diff(offsets)
        values, offsets, node = values[np.repeat(fresh, sizes)], np.concatenate(([0], np.cumsum(sizes[fresh]))), node[fresh]
        self.seen = np.concatenate((self.seen, node))
        sig, row = signatures(values, offsets, self.similarity)
        words, first = sketches(values, offsets)
        self.held.append((sig, row + self.nodes, node, np.diff(offsets), words, np.diff(first)))
        self.entries += len(sig)
        self.nodes += len(node)

    def pack(self, ranges: int) -> Iterator[pa.RecordBatch]:
        """Ties among the nodes held, and the entries of leaders by range of signature."""
        if not self.held:
            return
        sig, row, node, size, words, width = (np.concatenate(x) for x in zip(*self.held, strict=True))
        self.clear()
        first = np.concatenate(([0], np.cumsum(width)))
        order = np.lexsort((node[row], sig))
        sig, row = sig[order], row[order]
        start, length, name = groups_of(sig, node[row])
        ties, lead = [], np.ones(len(sig), bool)
        many = np.flatnonzero(length > 1)
        _, one, same = np.unique(name[many], return_index=True, return_inverse=True)
        masks = []
        for g in many[one].tolist():
            members = row[start[g] : start[g] + length[g]]
            leader, tied = canopies(folded(words, first, members), int(greatest_difference(size[members].max(), self.similarity)), 0)
            # the least and the greatest set go along, so that later comparisons know of all sizes
            leader[[size[members].argmin(), size[members].argmax()]] = -1
            masks.append(leader < 0)
            ties.append(np.stack([node[members[tied[0]]], node[members[tied[1]]]]))
        for g, m in zip(many.tolist(), same.tolist(), strict=True):
            lead[start[g] : start[g] + length[g]] = masks[m]
        sig, owner = sig[lead], node[row[lead]]
        start, length, _ = groups_of(sig, owner)
        common = np.repeat(length > HOT, length)
        marks = sig[start[length > HOT]]
        yield _rows(ranges, np.concatenate((sig[~common], marks)), np.concatenate((owner[~common], np.zeros(len(marks), np.int64))), ties, sig[common], owner[common])


def _rows(ranges: int, sig: np.ndarray, node: np.ndarray, ties: list[np.ndarray], hot: np.ndarray, hot_node: np.ndarray, first: int = 0, last: int | None = None) -> pa.RecordBatch:
    """Entries by range of signature (all of them in ranges first to last); ties and the entries of common signatures, which need no range, dealt evenly."""
    mine = range(first, ranges if last is None else last)
    order = np.lexsort((node, sig))
    sig, node = sig[order], node[order]
    cut = np.append(np.searchsorted(sig, np.array([(i << 64) // ranges for i in mine], np.uint64)), len(sig))
    rows = [(i, sig[a:b].tobytes(), node[a:b].tobytes(), b"", b"", b"", b"") for i, a, b in zip(mine, cut[:-1], cut[1:], strict=True) if a < b]
    tied = forest(*np.concatenate(ties, axis=1)) if ties else np.zeros((2, 0), np.int64)
    for x in np.array_split(np.arange(tied.shape[1]), -(-tied.shape[1] // HOT)) if tied.shape[1] else []:
        rows.append((int(tied[0, x[0]] % ranges), b"", b"", tied[0, x].tobytes(), tied[1, x].tobytes(), b"", b""))
    for x in np.array_split(np.arange(len(hot)), -(-len(hot) // HOT)) if len(hot) else []:
        rows.append((int(hot_node[x[0]] % ranges), b"", b"", b"", b"", hot[x].tobytes(), hot_node[x].tobytes()))
    columns = list(zip(*rows, strict=True)) if rows else [()] * 7
    return pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int32()), *(pa.array(c, pa.binary()) for c in columns[1:])], [x.split()[0] for x in PACKED.split(", ")])


MET = "tie boolean, a long, b long"


def _joined(group: pa.Table, name: str, kind: type) -> np.ndarray:
    return np.frombuffer(b"".join(x.as_py() for x in group.column(name)), kind)


def _meet(group: pa.Table) -> pa.Table:
    """Ties as they came, and (group, node) of the nodes that share a signature of this range."""
    sig, node = _joined(group, "signature", np.uint64), _joined(group, "node", np.int64)
    order = np.lexsort((node, sig))
    sig, node = sig[order], node[order]
    new = np.ones(len(sig), bool)
    new[1:] = (sig[1:] != sig[:-1]) | (node[1:] != node[:-1])
    sig, node = sig[new], node[new]
    start, length, name = groups_of(sig, node)
    run = np.repeat(np.arange(len(start)), length)
    marked = np.zeros(len(start), bool)
    marked[run[node == 0]] = True  # common in some task, so its nodes are found all over
    one = np.zeros(len(start), bool)  # of signatures with the same nodes, one
    one[np.unique(name, return_index=True)[1]] = True
    use = (((length > 1) & one & ~marked) | marked)[run] & (node != 0)
    names = np.where(marked, sig[start], name)[run] if len(start) else sig
    hot, hot_node = _joined(group, "hot", np.int64), _joined(group, "hot_node", np.int64)
    a, b = _joined(group, "a", np.int64), _joined(group, "b", np.int64)
    left, right = np.concatenate((a, names[use].view(np.int64), hot)), np.concatenate((b, node[use], hot_node))
    return pa.Table.from_arrays([pa.array(np.arange(len(left)) < len(a)), pa.array(left), pa.array(right)], ["tie", "a", "b"])


def _resplit(group: pa.Table, slots: int, ranges: int) -> pa.Table:
    """Rows of a coarse range, cut into fine ones."""
    sig, node = _joined(group, "signature", np.uint64), _joined(group, "node", np.int64)
    ties = np.stack([_joined(group, "a", np.int64), _joined(group, "b", np.int64)])
    share = ranges // slots
    first = int(group.column("range")[0].as_py()) * share
    return pa.Table.from_batches([_rows(ranges, sig, node, [ties], _joined(group, "hot", np.int64).view(np.uint64), _joined(group, "hot_node", np.int64), first, first + share)])


def _compare(similarity: int):
    def run(group: pa.Table) -> pa.Table:
        part, node, size = (group.column(c).to_numpy() for c in ("part", "node", "n_shingles"))
        order = np.lexsort((node, part))
        part, node, size = part[order], node[order], size[order]
        blobs = group.column("sketch").combine_chunks().take(pa.array(order))
        data, offsets = flat(blobs)
        words, first = np.frombuffer(data.tobytes(), np.uint64), offsets // 8
        cut = np.append(np.flatnonzero(np.concatenate((np.ones(min(1, len(part)), bool), part[1:] != part[:-1]))), len(part))
        names, index = np.unique(node, return_inverse=True)
        label = np.arange(len(names))
        for i, j in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True):
            here = label[index[i:j]]
            if (here == here[0]).all():  # connected by other groups of this task
                continue
            most = int(greatest_difference(size[i:j].max(), similarity))
            _, ties = canopies(folded(words, first, np.arange(i, j)), most, most // 3)
            if ties.shape[1]:
                label = labels(len(names), label[index[i + ties[0]]], label[index[i + ties[1]]])[label]
        tied = np.flatnonzero(label != np.arange(len(names)))
        a, b = names[tied], names[label[tied]]
        return pa.Table.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    return run


def candidate_ties(docs: DataFrame, rows: DataFrame, nodes: DataFrame, k: int, similarity: int) -> DataFrame:
    """(a, b): ties that connect all similar nodes.  rows: _owner, sketch; nodes: node, rep, n_shingles."""
    spark = docs.sparkSession
    ranges = ranges_for(docs)
    slots = coarse(ranges)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk = Chunk(similarity)
        for batch in batches:
            for _, _, values, offsets in _sets(batch, 0, k):
                chunk.add(values, offsets)
                if chunk.entries >= ENTRIES:
                    yield from chunk.pack(slots)
        yield from chunk.pack(slots)

    packed = spread(docs.select("text").mapInArrow(run, PACKED), PACKED, slots, ranges, _resplit)
    met = staged(packed.groupBy("range").applyInArrow(_meet, MET))
    shared = met.where("not tie").select(F.col("a").alias("g"), F.col("b").alias("node")).distinct()
    entries = staged(shared.join(nodes.select("node", "rep", "n_shingles"), "node"))
    counted = entries.groupBy("g").agg(F.greatest(F.ceil(F.count(F.lit(1)) / GROUP), F.ceil(F.sum("n_shingles") / GROUP_SHINGLES)).cast("int").alias("_blocks"))
    large = staged(counted.where("_blocks > 1").withColumnRenamed("g", "_g"))
    cut = large.count()
    count, shingles = entries.select(F.count(F.lit(1)), F.coalesce(F.sum("n_shingles"), F.lit(0))).first()
    tasks = int(max(shingles // GROUPS_SHINGLES + 1, spark.sparkContext.defaultParallelism))
    # every pair of the blocks of a cut group is compared
    whole, others = F.xxhash64("g"), F.filter(F.sequence(F.lit(0), F.col("blocks") - 1), lambda o: o != F.col("mine"))
    parts = F.when(F.col("blocks") <= 1, F.array(whole)).otherwise(F.transform(others, lambda o: F.xxhash64("g", F.least("mine", o), F.greatest("mine", o))))
    sized = entries.join(F.broadcast(large) if cut <= BROADCAST_ROWS else large, F.col("g") == F.col("_g"), "left") if cut else entries.withColumn("_blocks", F.lit(1))
    placed = sized.withColumn("blocks", F.coalesce("_blocks", F.lit(1))).withColumn("mine", F.pmod(F.xxhash64("node", "g"), F.col("blocks")).cast("int"))
    dealt = placed.select("node", "n_shingles", "blocks", F.explode(parts).alias("part"))
    wanted = entries.select(F.col("rep").alias("_rep"), F.col("node").alias("_node")).distinct()
    found = rows.select("_owner", "sketch").join(F.broadcast(wanted) if count <= BROADCAST_ROWS else wanted, F.col("_owner") == F.col("_rep")).select("_node", "sketch")
    # a repeated row has its copies' _owner
    seen = dealt.join(found.dropDuplicates(["_node"]), F.col("node") == F.col("_node"))
    task = F.when(F.col("blocks") <= 1, F.pmod("part", F.lit(tasks))).otherwise(F.col("part"))
    compared = seen.select(task.alias("task"), "part", "node", "n_shingles", "sketch").groupBy("task").applyInArrow(_compare(similarity), "a long, b long")
    return met.where("tie").select("a", "b").union(compared)


def common(sets: list[np.ndarray], first: np.ndarray, last: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(i, shingles in common with sets[first[i] : last[i]]) for every i whose range is not empty."""
    m = len(sets)
    row = np.repeat(np.arange(m), [len(s) for s in sets])
    _, column, df = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    row = row[np.argsort(column, kind="stable")]
    column = np.sort(column)
    start = np.concatenate(([0], np.cumsum(df)[:-1]))
    dense = np.flatnonzero(df >= DENSE)
    bits = np.zeros((m, (len(dense) + 63) // 64), np.uint64)
    place = np.full(len(df), -1)
    place[dense] = np.arange(len(dense))
    at = place[column]
    hit = at >= 0
    np.bitwise_or.at(bits, (row[hit], at[hit] // 64), np.uint64(1) << (at[hit] % 64).astype(np.uint64))
    pairs = []
    for d in range(2, DENSE):  # sparse columns: their pairs, all columns of equal degree at once
        mine = start[df == d]
        if len(mine):
            block = row[mine[:, None] + np.arange(d)]
            i, j = np.triu_indices(d, 1)
            pairs.append((block[:, i].ravel().astype(np.int64) * m + block[:, j].ravel()))
    keys, counts = np.unique(np.concatenate(pairs), return_counts=True) if pairs else (np.zeros(0, np.int64), np.zeros(0, np.int64))
    low, high = keys // m, keys % m
    both = np.concatenate((low, high)), np.concatenate((high, low)), np.concatenate((counts, counts))
    order = np.argsort(both[0], kind="stable")
    cut = np.searchsorted(both[0][order], np.arange(m + 1))
    other, extra = both[1][order], both[2][order]
    for i in np.flatnonzero(first < last).tolist():
        a, b = first[i], last[i]
        out = np.bitwise_count(bits[a:b] & bits[i]).sum(axis=1).astype(np.int64)
        near = other[cut[i] : cut[i + 1]]
        inside = (near >= a) & (near < b)
        out[near[inside] - a] += extra[cut[i] : cut[i + 1]][inside]
        yield i, out


def _verify(similarity: int):
    def run(group: pa.Table) -> pa.Table:
        cluster, side = group.column("cluster").to_numpy(), group.column("side").to_numpy()
        node, weight = group.column("node").to_numpy(), group.column("weight").to_numpy()
        blobs, between = group.column("members"), group.column("between").to_numpy(zero_copy_only=False)
        order = np.lexsort((node, side, cluster))
        out: list[tuple[int, int, int]] = []
        ends = np.flatnonzero(np.diff(np.append(cluster[order], cluster[order][-1] + 1 if len(order) else 0))) + 1
        for part in np.split(order, ends[:-1]) if len(order) else []:
            # a repeated row may bring a node twice
            part = part[np.concatenate(([True], node[part][1:] != node[part][:-1]))]  # equal nodes are on one side
            two = bool(between[part[0]])  # told, not seen: a block may hold no set
            sets = [np.frombuffer(blobs[i].as_py(), np.uint64) for i in part.tolist()]
            size = np.array([len(s) for s in sets])
            # by size, so that the sets that can be similar to one are a range; one side after the other
            by_size = np.lexsort((size, side[part]))
            part, sets, size = part[by_size], [sets[i] for i in by_size.tolist()], size[by_size]
            name, copies, left = node[part], weight[part], int((side[part] == 0).sum())
            if len(part) < 2 or two and left in (0, len(part)):
                continue
            root = np.arange(len(part))  # of each set's component so far
            most = size * 100 // similarity
            if two:
                least = -(-size * similarity // 100)
                first, last = (left + np.searchsorted(size[left:], x, how) for x, how in ((least, "left"), (most, "right")))
                last[left:] = 0
            else:
                first, last = np.arange(len(part)) + 1, np.searchsorted(size, most, "right")
            links = np.zeros(len(part), np.int64)
            for i, inter in common(sets, first, last):
                found = first[i] + np.flatnonzero(100 * inter >= similarity * (size[i] + size[first[i] : last[i]] - inter))
                links[i] += copies[found].sum()
                links[found] += copies[i]
                for other in np.setdiff1d(root[found], root[i]).tolist():
                    low, high = sorted((other, int(root[i])))
                    root[root == high] = low
            out += [(int(name[i]), int(name[root[i]]), int(links[i])) for i in np.flatnonzero(links).tolist()]
        columns = list(zip(*out, strict=True)) if out else ((), (), ())
        return pa.Table.from_arrays([pa.array(c, pa.int64()) for c in columns], ["a", "b", "links"])

    return run


def verified_links(keyed: DataFrame, nodes: DataFrame, clusters: DataFrame, k: int, similarity: int) -> DataFrame:
    """(a, b, links): a spanning forest of exact links, and each node's linked documents, block by block."""
    # small clusters share a task; a cluster of more than BLOCK shingles is cut, and every pair of its blocks is a task
    sized = staged(clusters.join(nodes, "node"))
    large = staged(sized.groupBy("root").agg(F.sum("n_shingles").alias("total")).where(F.col("total") > BLOCK).select(F.col("root").alias("_root"), F.ceil(F.col("total") / BLOCK).cast("int").alias("_blocks")))
    cut = large.count()
    side = F.broadcast(large) if cut <= BROADCAST_ROWS else large
    placed = staged(sized.join(side, sized["root"] == large["_root"], "left").withColumn("blocks", F.coalesce("_blocks", F.lit(1))).drop("_root", "_blocks")) if cut else sized.withColumn("blocks", F.lit(1))
    weight = placed.select(F.coalesce(F.sum("n_shingles"), F.lit(0)), F.count(F.lit(1))).first()
    tasks = max(1, int(weight[0] // BLOCK) + 1, keyed.sparkSession.sparkContext.defaultParallelism)
    wanted = placed.select(F.col("rep").alias("_rep"), "node", F.col("root").alias("cluster"), F.col("copies").alias("weight"), "blocks")
    if weight[1] <= BROADCAST_ROWS:
        wanted = F.broadcast(wanted)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, values, offsets in _sets(batch, 0, k):
                members = pa.array([values[offsets[i] : offsets[i + 1]].tobytes() for i in range(b - a)], pa.binary())
                yield pa.RecordBatch.from_arrays([*(batch.column(i).slice(a, b - a) for i in range(1, 5)), members], ["node", "cluster", "weight", "blocks", "members"])

    fetched = keyed.join(wanted, F.col("_owner") == F.col("_rep")).select("text", "node", "cluster", "weight", "blocks")
    sets = fetched.mapInArrow(run, "node long, cluster long, weight long, blocks int, members binary")
    mine = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    pairs = F.when(F.col("blocks") <= 1, F.array(F.struct(F.lit(0).alias("i"), F.lit(0).alias("j"), F.lit(0).alias("side")))).otherwise(
        F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda o: F.struct(F.least(mine, o).alias("i"), F.greatest(mine, o).alias("j"), F.when(mine <= o, 0).otherwise(1).alias("side")))
    )
    dealt = sets.withColumn("p", F.explode(pairs)).withColumn("task", F.when(F.col("blocks") <= 1, F.pmod(F.xxhash64("cluster"), F.lit(tasks))).otherwise(F.xxhash64("cluster", "p.i", "p.j")))
    return dealt.select("task", F.when(F.col("blocks") <= 1, F.col("cluster")).otherwise(F.xxhash64("cluster", "p.i", "p.j")).alias("cluster"), "p.side", (F.col("p.i") != F.col("p.j")).alias("between"), "node", "weight", "members").groupBy("task").applyInArrow(_verify(similarity), "a long, b long, links long")


def jaccard_classes(docs: DataFrame, k: int, similarity: int) -> DataFrame:
    """_owner, doc_id, n_shingles, component_id, n_links of every row of docs, and
    _class, a name of the row's class that is null only where it is alone.

    similarity in hundredths: sets link when 100 * common >= similarity * union."""
    keyed = docs.select("doc_id", "text", F.xxhash64("doc_id", "text").alias("_owner"))
    rows = staged(profile(keyed, k))
    filled = rows.where("node <> 0")
    nodes = staged(filled.groupBy("node").agg(F.min("_owner").alias("rep"), F.min("doc_id").alias("low"), F.count(F.lit(1)).alias("copies"), F.first("n_shingles").alias("n_shingles")))
    clusters = components(candidate_ties(docs, rows, nodes, k, similarity))
    links = staged(verified_links(keyed, nodes, clusters, k, similarity))
    classes = components(links.select("a", "b"))
    # nodes that are one of several copies or linked; all others are alone
    known = nodes.join(classes, "node", "left").join(links.groupBy("a").agg(F.sum("links").alias("linked")).withColumnRenamed("a", "node"), "node", "left")
    lows = known.where("root is not null").groupBy("root").agg(F.min("low").alias("least"))
    named = staged(known.where("copies > 1 or root is not null").join(lows, "root", "left").select(F.col("node").alias("_node"), F.coalesce("root", "node").alias("_class"), F.coalesce("least", "low").alias("component"), (F.coalesce("linked", F.lit(0)) + F.col("copies") - 1).alias("links")))
    if named.count() <= BROADCAST_ROWS:
        named = F.broadcast(named)
    return rows.join(named, rows["node"] == named["_node"], "left").select("_owner", "doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"), F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), "_class")


def op6_partenum_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_classes(table(spark, sf_dir, "documents"), k=3, similarity=90).drop("_owner", "_class")


def one_of_each_class(docs: DataFrame, k: int, similarity: int) -> DataFrame:
    """docs with one document of each class: that of the smallest doc_id (then of the smallest row hash)."""
    rows = staged(jaccard_classes(docs, k, similarity).where("n_links > 0"))
    winner = rows.groupBy("_class").agg(F.min_by("_owner", F.struct(F.coalesce(F.col("doc_id") != F.col("component_id"), F.lit(True)), "doc_id", "_owner")).alias("_winner"))
    losers = staged(rows.select("_class", "_owner").distinct().join(winner, ["_class"]).where("_owner <> _winner").select(F.col("_owner").alias("_loser")))
    # rows that are equal as a whole cannot be told apart by their hash
    repeated = staged(rows.groupBy("_owner").count().where("count > 1").select(F.col("_owner").alias("_twice")))
    name = F.xxhash64(docs["doc_id"], docs["text"])
    kept = docs.join(F.broadcast(losers) if losers.count() <= BROADCAST_ROWS else losers, name == losers["_loser"], "left_anti")
    if not repeated.limit(1).count():
        return kept
    side = F.broadcast(repeated) if repeated.count() <= BROADCAST_ROWS else repeated
    twice = kept.join(side, name == repeated["_twice"], "left_semi").dropDuplicates(["doc_id", "text"])
    return kept.join(side, name == repeated["_twice"], "left_anti").union(twice)


#: Shingles are lists of words, so that no separator can make two alike; equal sets are one node, as above.
OP6_SQL = r"""
WITH RECURSIVE d AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT rid, doc_id, list_sort(list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [w] ELSE list_transform(range(1, len(w) - 1), lambda i: w[i : i + 2]) END)) AS v FROM d),
n AS (SELECT v, min(rid) AS node, min(doc_id) AS low, count(*) AS copies, len(v) AS size FROM s WHERE len(v) > 0 GROUP BY v),
x AS (SELECT node, size, unnest(v) AS g FROM n),
p AS (SELECT a.node AS a, b.node AS b FROM x AS a JOIN x AS b ON a.g = b.g AND a.node <> b.node AND 100 * least(a.size, b.size) >= 90 * greatest(a.size, b.size)
      GROUP BY a.node, b.node, a.size, b.size HAVING 100 * count(*) >= 90 * (a.size + b.size - count(*))),
r(a, b) AS (SELECT node, node FROM n UNION SELECT r.a, p.b FROM r JOIN p ON r.b = p.a),
c AS (SELECT r.a AS node, min(n.low) AS component FROM r JOIN n ON n.node = r.b GROUP BY r.a),
l AS (SELECT p.a AS node, sum(n.copies) AS links FROM p JOIN n ON n.node = p.b GROUP BY p.a)
SELECT s.doc_id, CAST(len(s.v) AS BIGINT) AS n_shingles, coalesce(c.component, s.doc_id) AS component_id, CAST(coalesce(l.links, 0) + coalesce(n.copies, 1) - 1 AS BIGINT) AS n_links
FROM s LEFT JOIN n ON n.v = s.v LEFT JOIN c ON c.node = n.node LEFT JOIN l ON l.node = n.node
"""
