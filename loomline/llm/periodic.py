"""Operator 12: runs of repeating words, found by counting lags first.

A run is a stretch of words with smallest period q (words q apart are equal),
LEAST words and two periods long at least, that no neighbour extends.  At lag q
it has its length less q matches in a row, so lags with fewer matches in the
whole text than max(LEAST - q, q) need not be looked at.  Matches are counted
exactly for all lags up to half the text:

- heavy words, whose pairs would cost more than a transform, by FFT
  autocorrelation (spectra of all heavy words of a text are summed and
  transformed back once; counts are whole numbers far below 2^50, so rounding is
  exact; texts over BLOCK words are transformed block by block);
- light words by differences of their positions, for all words of all texts of an
  Arrow slice at once, the k-th next occurrence in step k.

Lags with enough matches get a scan for islands of consecutive matches, in
ascending order.  A run of period p is an island of its own at every multiple
of p: these matches are taken off the counts when the run is found, so that a
text of one word costs one scan, not one for each lag.

Words are compared by value (dictionary codes), not by hash.  A text is one row,
so one task holds it; memory is about 150 bytes a word of the longest text.  A
text of long near-repetitions (many lags with enough matches, none of them in a
row) costs a scan for each such lag.

Defined results: null and empty texts have no runs and collapse to the empty
text; texts of any length are taken whole; equal starts are told apart by period;
repeated rows and null ids are kept; an empty table gives an empty result; other
columns are not read by `periodic_runs` and pass through `collapse`.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shared import table
from .textkernel import Words, flat, gather, slices, strings

LEAST = 12
SLICE_BYTES = 4 << 20
#: Words of a text that are transformed at a time.
BLOCK = 1 << 20
#: A word is heavy if it occurs this often at least, and its pairs outnumber the steps of a transform.
HEAVY = 32

RUNS = T.ArrayType(T.StructType([T.StructField(name, T.LongType()) for name in ("start", "length", "period")]))


def word_codes(words: Words) -> np.ndarray:
    """Equal numbers for equal words."""
    lengths = words.end - words.start
    column = strings(gather(words.data, words.start, lengths), np.concatenate(([0], np.cumsum(lengths))))
    return column.dictionary_encode().indices.to_numpy().astype(np.int64)


def _padded(n: int) -> int:
    """A length for the transform: the least power of two, or three times one, from n."""
    two = 1 << max(n - 1, 1).bit_length()
    return two // 4 * 3 if two // 4 * 3 >= n else two


def autocorrelation(places: list[np.ndarray], n: int, lags: int, block: int = BLOCK) -> np.ndarray:
    """[q] for q up to `lags`: pairs q apart of equal words, of words at these places of a text of n words."""
    size = min(n, block)
    width, out = _padded(2 * size), np.zeros(lags + 1, np.int64)

    def spectrum(at: np.ndarray, k: int) -> np.ndarray:
        marks = np.zeros(width)
        marks[at[np.searchsorted(at, k * size) : np.searchsorted(at, (k + 1) * size)] - k * size] = 1
        return np.fft.rfft(marks)

    blocks = -(-n // size)
    for apart in range(lags // size + 2):
        total = np.zeros(width // 2 + 1, complex)
        for at in places:
            for k in range(blocks - apart):
                early = spectrum(at, k)
                total += np.conj(early) * (spectrum(at, k + apart) if apart else early)
        counts = np.rint(np.fft.irfft(total, width)).astype(np.int64)
        # block k + apart is behind by apart * size: index j is that lag plus j, or less width - j
        for j, found in ((apart * size, counts[:size]), (apart * size - size + 1, counts[width - size + 1 :])):
            first, last = max(j, 0), min(j + len(found), lags + 1)
            if first < last and (apart or j >= 0):
                out[first:last] += found[first - j : last - j]
    return out


def lag_counts(codes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """[first[row] + q]: matches at lag q, for each q up to half of the row's words."""
    n = np.diff(first)
    total, row = len(codes), np.repeat(np.arange(len(n)), n)
    counts = np.zeros(total + 1, np.int64)
    if not total:
        return counts
    order = np.argsort(row * (int(codes.max()) + 1) + codes, kind="stable")
    of, code = row[order], codes[order]
    new = np.flatnonzero(np.concatenate(([True], (of[1:] != of[:-1]) | (code[1:] != code[:-1]))))
    often = np.diff(np.append(new, total))
    words = n[of[new]]
    heavy = (often >= HEAVY) & (often.astype(float) ** 2 > words * np.log2(2 * words + 1))
    places: dict[int, list[np.ndarray]] = {}
    for k in np.flatnonzero(heavy).tolist():
        r = int(of[new[k]])
        places.setdefault(r, []).append(order[new[k] : new[k] + often[k]] - first[r])
    for r, at in places.items():
        half = int(n[r]) // 2
        counts[first[r] + 1 : first[r] + half + 1] += autocorrelation(at, int(n[r]), half)[1:]
    ends = np.repeat(new + often, often)
    left = np.flatnonzero(np.repeat(~heavy, often))
    k = 1
    while len(left := left[left + k < ends[left]]):
        apart = order[left + k] - order[left]
        near = apart <= n[of[left]] // 2  # the next occurrences are further away still
        left, apart = left[near], apart[near]
        np.add.at(counts, first[of[left]] + apart, 1)
        k += 1
    return counts


def islands(codes: np.ndarray, q: int, least: int) -> list[tuple[int, int]]:
    """(start, length) of the maximal stretches of `least` or more places that equal the one q further on."""
    breaks = np.flatnonzero(codes[q:] != codes[:-q])
    edges = np.concatenate(([-1], breaks, [len(codes) - q]))
    lengths = np.diff(edges) - 1
    long = np.flatnonzero(lengths >= least)
    return list(zip((edges[long] + 1).tolist(), lengths[long].tolist(), strict=True))


def found_runs(codes: np.ndarray, first: np.ndarray, least: int = LEAST) -> dict[int, list[tuple[int, int, int]]]:
    """(start, length, period) of the runs of each row that has any, by start, then period."""
    counts, n = lag_counts(codes, first), np.diff(first)
    lag = np.arange(len(codes)) - np.repeat(first[:-1], n)
    enough = np.flatnonzero((lag > 0) & (lag <= np.repeat(n // 2, n)) & (counts[:-1] >= np.maximum(least - lag, lag)))
    rows = np.searchsorted(first, enough, "right") - 1
    out: dict[int, list[tuple[int, int, int]]] = {}
    for at, q, r in zip(enough.tolist(), lag[enough].tolist(), rows.tolist(), strict=True):
        need = max(least - q, q)
        if counts[at] < need:  # what is left are matches of runs that are known
            continue
        seen = out.setdefault(r, [])
        known = {(s, length) for s, length, p in seen if q % p == 0}
        for s, matches in islands(codes[first[r] : first[r + 1]], q, need):
            length = matches + q
            if (s, length) in known:
                continue
            seen.append((s, length, q))
            later = np.arange(2 * q, min(length - 1, int(n[r]) // 2) + 1, q)
            counts[first[r] + later] -= length - later
    return {r: sorted(runs, key=lambda x: (x[0], x[2])) for r, runs in out.items() if runs}


def kept_words(words: Words, runs: dict[int, list[tuple[int, int, int]]]) -> np.ndarray:
    """Whether no run holds a word beyond its first period."""
    change = np.zeros(len(words) + 1, np.int64)
    for r, found in runs.items():
        for start, length, period in found:
            change[words.first[r] + start + period] += 1
            change[words.first[r] + start + length] -= 1
    return np.cumsum(change[:-1]) == 0


def joined(words: Words, keep: np.ndarray) -> pa.Array:
    """The kept words of every row with one space between them."""
    lengths = np.where(keep, words.end - words.start + 1, 0)
    ends = np.cumsum(lengths)
    raw = gather(np.append(words.data, np.uint8(32)), words.start[keep], lengths[keep])
    raw[ends[keep] - 1] = 32
    at = np.concatenate(([0], ends))[words.first]
    begin, stop = at[:-1], np.maximum(at[1:] - 1, at[:-1])  # without the last space
    return strings(gather(raw, begin, stop - begin), np.concatenate(([0], np.cumsum(stop - begin))), pa.large_string())


def periodic_runs(docs: DataFrame, key: str = "doc_id", text: str = "text", least: int = LEAST) -> DataFrame:
    """key, n_words, runs (start, length, period, by start and period; words are numbered from 0), collapsed.

    collapsed are the words that no run holds beyond its first period, joined by one space."""
    schema = T.StructType([T.StructField(key, docs.schema[key].dataType), T.StructField("n_words", T.LongType()), T.StructField("runs", RUNS), T.StructField("collapsed", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = flat(batch.column(1))
            for a, b in slices(offsets, SLICE_BYTES):
                words = Words(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], hashed=False)
                runs = found_runs(word_codes(words), words.first, least)
                each = [[{"start": s, "length": n, "period": p} for s, n, p in runs.get(r, [])] for r in range(b - a)]
                text = joined(words, kept_words(words, runs)).cast(pa.string())
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array(words.counts, pa.int64()), pa.array(each, pa.list_(pa.struct([(x, pa.int64()) for x in ("start", "length", "period")]))), text], schema.names)

    return docs.select(F.col(f"`{key}`"), F.col(f"`{text}`")).mapInArrow(run, schema)


def collapse(docs: DataFrame, text: str = "text") -> DataFrame:
    """docs, each run of a text cut to its first period; texts without a run stay as they are, to the byte."""

    @F.arrow_udf("string")
    def cut(column: pa.Array) -> pa.Array:
        data, offsets = flat(column)
        parts = []
        for a, b in slices(offsets, SLICE_BYTES):
            words = Words(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], hashed=False)
            runs = found_runs(word_codes(words), words.first)
            new = joined(words, kept_words(words, runs))
            parts += [new[r].as_py() if r in runs else column[a + r].as_py() for r in range(b - a)]
        return pa.array(parts, pa.string())

    return docs.withColumn(text, cut(F.col(f"`{text}`")))


def repeated(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key and text, where the words of a tenth of all texts, chosen and cut by a checksum of the key, repeat from some place on.

    With h the CRC-32 of the key in decimal, g = h / 10 and n words: if h % 10 is 0, word i is word
    a + (i - a) % p from i = a on, a = g % n, p = 1 + (n - a) / (3 + g % 8)."""
    h = F.crc32(F.col(f"`{key}`").cast("string"))
    g = F.floor(h / 10)

    def let(value: Column, body) -> Column:
        return F.transform(F.array(value), body)[0]

    def again(words: Column) -> Column:
        n = F.size(words).cast("long")
        bent = lambda a, p: F.array_join(F.transform(words, lambda w, i: F.when(i < a, w).otherwise(F.get(words, a + (i - a) % p))), " ")
        return let((g % n).cast("int"), lambda a: let((1 + F.floor((n - a) / (3 + g % 8))).cast("int"), lambda p: bent(a, p)))

    words = F.filter(F.split(F.col(f"`{text}`"), r"[ \t-\r]+"), lambda w: w != "")
    bent = let(words, lambda w: F.when(F.size(w) > 0, again(w)).otherwise(F.lit("")))
    return docs.select(F.col(f"`{key}`"), F.when(h % 10 == 0, bent).otherwise(F.col(f"`{text}`")).alias(text))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs(repeated(table(spark, sf_dir, "documents")))
    run = F.col("best")
    longest = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    lines = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")
    return found.withColumn("best", longest).select(
        "doc_id", "n_words", F.size("runs").cast("long").alias("n_runs"), (-run["start"]).alias("start"), run["length"].alias("length"), (-run["period"]).alias("period"),
        F.floor(run["length"] * 1000 / -run["period"]).alias("exponent_milli"), F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
