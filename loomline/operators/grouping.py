"""Greedy groups of similar sentences of one text.

The first free sentence leads a group; those after it join, in order, while they
are similar enough to what the group then is, until it is full.  A join moves the
group's words (or its sum of vectors), so the order matters and each text is done
in one go; texts are independent of each other.
"""

from __future__ import annotations

import logging
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

log = logging.getLogger(__name__)


#: Likenesses of pairs that are held at once.
CELLS = 1 << 20
#: Up to so many sentences all products are held as they are.
SMALL = 512
#: A word is common if more than one in so many sentences has it: counted by a matrix product, others by postings.
COMMON = 16


def token_groups(parts: list[str], similarity: float, room: int) -> Iterator[list[int]]:
    """Groups by Jaccard similarity of blank-separated words with the group's words; full beyond `room` characters.

    The words that sentences share are counted for blocks of leaders at a time.  A leader without a similar
    sentence, as most are, is a group by itself; for others a join adds the postings of its new words to the counts."""
    n, words = len(parts), pc.split_pattern(pa.array(parts, pa.string()), " ")
    named = words.flatten().dictionary_encode()
    # (sentence, word), each once
    own = np.repeat(np.arange(n), pc.list_value_length(words).to_numpy()) * len(named.dictionary)
    owner, flat = np.divmod(np.unique(own + named.indices.to_numpy()), len(named.dictionary))
    size = np.bincount(owner, minlength=n)
    first = np.cumsum(size) - size
    often = np.bincount(flat)
    begin = np.cumsum(often) - often
    postings = owner[np.argsort(flat, kind="stable")]
    # a word of one sentence is shared with none
    common, rare = (often > 1) & (often * COMMON > n), (often > 1) & (often * COMMON <= n)
    dense = np.zeros((n, int(common.sum())), np.float32)
    held = common[flat]
    dense[owner[held], (np.cumsum(common) - 1)[flat[held]]] = 1
    few = rare[flat]
    lengths, free, bound = [len(p) for p in parts], np.ones(n, bool), (similarity * (1 - 1e-5) * size).astype(np.float32)
    rows = max(1, CELLS // n)
    for low in range(0, n, rows):
        high = min(low + rows, n)
        shared = dense[low:high] @ dense[low:].T
        some = np.arange(first[low], first[high - 1] + size[high - 1])
        some = some[few[some]]
        if len(some):
            each = often[flat[some]]
            there = _items(postings, begin[flat[some]], each)
            cell = ((owner[some] - low) * (n - low)).repeat(each) + there - low
            np.add.at(shared.reshape(-1), cell[there >= low], np.float32(1))
        # single precision: a leader may be looked at in vain, none is left out
        left = shared * np.float32(1 + similarity)
        left -= bound[None, low:]
        near = left >= bound[low:high, None]
        near[np.arange(high - low), np.arange(high - low)] = False
        looked = near.any(axis=1).tolist()
        for leader in range(low, high):
            if not free[leader]:
                continue
            free[leader] = False
            group = [leader]
            if looked[leader - low]:
                total, both, of_group = lengths[leader], shared[leader - low].astype(np.int64), set(flat[first[leader] : first[leader] + size[leader]].tolist())
                after, more = leader + 1, True
                while more and after < n:
                    tail, more = both[after - low :], False
                    fits = (tail >= similarity * (len(of_group) + size[after:] - tail)) & free[after:]
                    for at in (np.flatnonzero(fits) + after).tolist():
                        free[at] = False
                        group.append(at)
                        total += lengths[at]
                        if total > room:
                            break
                        new = [w for w in flat[first[at] : first[at] + size[at]].tolist() if w not in of_group]
                        if new:  # others fit the group that it now is
                            of_group.update(new)
                            there = np.concatenate([postings[begin[w] : begin[w] + often[w]] for w in new])
                            both += np.bincount(there[there >= low] - low, minlength=n - low)
                            after, more = at + 1, True
                            break
            yield group


def _items(values: np.ndarray, begin: np.ndarray, each: np.ndarray) -> np.ndarray:
    """values[begin : begin + each] of all ranges, one after another; none is empty."""
    ends = each.cumsum()
    return values[(begin - ends + each).repeat(each) + np.arange(ends[-1])]


def vector_groups(parts: list[str], similarity: float, room: int, batch: int, encode: Callable[[list[str]], np.ndarray]) -> Iterator[list[int]]:
    """As token_groups, by the mean inner product with the members; full at 50 x members > room.

    Products in single precision, for blocks of leaders at a time, rule out leaders without a similar sentence;
    for others the products with each member, over its components that are not 0, are added up."""
    vectors = np.vstack([np.asarray(encode(parts[i : i + batch]), np.float64) for i in range(0, len(parts), batch)])
    if len(vectors) != len(parts):
        raise ValueError(f"{len(vectors)} vectors of {len(parts)} sentences")
    n, across = len(parts), np.ascontiguousarray(vectors.T)
    with np.errstate(all="ignore"):
        single = vectors if len(parts) <= SMALL else vectors.astype(np.float32)
        off = vectors.shape[1] * 2.0**-22 * float((vectors * vectors).sum(axis=1).max())  # what a product may be off by
    free, rows, finite = np.ones(n, bool), max(1, CELLS // n), bool(np.isfinite(vectors).all())

    def products(at: int, start: int) -> np.ndarray:
        if n <= SMALL:
            return all_[at, start:]
        some = np.flatnonzero(vectors[at])
        if 2 * len(some) > vectors.shape[1] or not finite:
            return vectors[at] @ across[:, start:]
        return vectors[at, some] @ across[some, start:]

    for low in range(0, n, rows):
        high = min(low + rows, n)
        with np.errstate(all="ignore"):
            all_ = single[low:high] @ single[low:].T
            near = ~(all_ < similarity - off)  # what is not a number is looked at
        near &= np.arange(low, n)[None, :] > np.arange(low, high)[:, None]
        looked = near.any(axis=1).tolist()
        for leader in range(low, high):
            if not free[leader]:
                continue
            free[leader] = False
            group = [leader]
            if looked[leader - low]:
                at, likeness = leader, products(leader, leader + 1)
                while at + 1 < n and (50 * len(group) <= room or len(group) == 1):
                    fits = (likeness >= similarity * len(group)) & free[at + 1 :]
                    place = int(fits.argmax())
                    if not fits[place]:
                        break
                    at += 1 + place
                    free[at] = False
                    group.append(at)
                    likeness = likeness[place + 1 :] + products(at, at + 1)
            yield group


def groups(parts: list[str], similarity: float, room: int, batch: int = 64, encode: Callable[[list[str]], np.ndarray] | None = None) -> list[list[int]]:
    """Groups by vectors; by words where there is no encoder or it fails."""
    if encode:
        try:
            return list(vector_groups(parts, similarity, room, batch, encode))
        except Exception:  # noqa: BLE001 - whatever a model raises
            log.warning("encoder failed, grouping by words", exc_info=True)
    return list(token_groups(parts, similarity, room))
