"""Operator 4 (native): benchmark decontamination by spaced-seed hashing.

A seed is the hash of the words that a fixed mask selects out of SPAN
consecutive words, so words at ignored positions may differ.  Seeds of every
position of every document meet the benchmark's seeds in one hash join, whose
build side is the benchmark, broadcast up to BROADCAST_SEEDS seeds.  Beyond that
positions and seeds are shuffled by seed, in one pass over the documents however
large the benchmark is; what meets is joined to the words of its document again.
Around each hit the aligned words of document and item are compared: FLANK
words on both sides, as far as the item goes.  The overlap counts if at least
AGREE percent of the item's words there are equal, so substitutions are
tolerated at any position.  OP4_SQL ends there.  The query and the pipeline also
count a passage out of an item (passages=True): an overlap of more than SPAN
words that holds the seed, begins and ends with equal words and has AGREE percent
of its own words equal, whatever the document has around it.  Pairs that the
first rule finds keep its figures, so every row of OP4_SQL is a row of the query.

Everything is DataFrame functions: words are hashed once a document; positions
are exploded, hashed and probed inside one code-generated stage, in which the
document's words stay a reference, and (up to that bound) nothing is shuffled
but verified hits.

Defined results: text is lower-cased and words are runs of letters and digits;
null or empty texts match nothing; an item under SPAN words (SQL: not searched
for) is found where all its words stand in a row, however few they are; in a
script without spaces a word is all that stands between other characters, and is
found only as a whole; repeated rows
are each reported once an item; a null doc_id or item_id is reported as null;
an empty table on either side gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import staged, table

#: Fixed masks: 1 marks a selected word.
MASKS = ("110101110011", "111010010111", "101101101101")
SPAN = 12
FLANK = 8
AGREE = 80
#: Seeds, of about 300 bytes, that one broadcast holds.
BROADCAST_SEEDS = 200_000
BROADCAST_ROWS = 200_000


def word_hashes(text: Column) -> Column:
    words = F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != "")
    return F.transform(words, lambda w: F.xxhash64(w))


def positions(df: DataFrame) -> DataFrame:
    """A row for each position and mask: df's columns, at, seed."""
    at = df.withColumn("at", F.explode(F.when(F.size("h") >= SPAN, F.sequence(F.lit(0), F.size("h") - SPAN))))
    seeds = [F.xxhash64(F.lit(n), *(F.col("h")[F.col("at") + i] for i, bit in enumerate(mask) if bit == "1")) for n, mask in enumerate(MASKS)]
    return at.withColumn("seed", F.explode(F.array(*seeds)))


def item_seeds(benchmark: DataFrame) -> DataFrame:
    """seed, item_id, item_at, and the item's words from left_words before the seed on."""
    items = benchmark.where("text is not null").select("item_id", word_hashes(F.col("text")).alias("h")).distinct()
    left = F.least(F.col("at"), F.lit(FLANK))
    return positions(items).select(
        "seed", "item_id", F.col("at").alias("item_at"), left.alias("left_words"), F.slice("h", F.col("at") - left + 1, left + SPAN + FLANK).alias("near")
    )


def _met(words: DataFrame, at: DataFrame, seeds: DataFrame, few: bool) -> DataFrame:
    """Rows of at (words' columns, at, seed) with those of seeds of the same seed."""
    if few:
        return at.join(F.broadcast(seeds), "seed")
    # the words of a document are not shuffled with each of its positions
    places = at.select("_owner", "at", "seed").join(seeds.select("seed").distinct().hint("shuffle_merge"), "seed").distinct()
    return places.join(words.dropDuplicates(["_owner"]), "_owner").join(seeds, "seed")


def _hits(docs: DataFrame, seeds: DataFrame, passages: bool, few: bool) -> DataFrame:
    words = docs.select("_owner", "doc_id", word_hashes(F.col("text")).alias("h"))
    met = _met(words, positions(words), seeds, few)
    # the document may begin or end inside the item's surroundings: what is missing does not agree
    left = F.least("left_words", "at")
    there = F.slice("h", F.col("at") - left + 1, left + F.size("near") - F.col("left_words"))
    hit = met.select("_owner", "doc_id", "item_id", "at", "left_words", left.alias("left"), F.size("near").alias("wanted"), there.alias("there"), "near")
    equal = F.zip_with("there", F.slice("near", F.col("left_words") - F.col("left") + 1, F.greatest(F.size("there"), F.lit(1))), lambda x, y: x == y)
    # generated, so that the comparison is not drawn into the join, which would leave generated code
    compared = hit.withColumn("equal", F.explode(F.array(equal))).withColumn("agreeing", _count(F.col("equal")))
    around = F.when(F.col("agreeing") * 100 >= F.lit(AGREE) * F.col("wanted"), F.struct((F.col("at") - F.col("left")).alias("start"), (F.col("at") - F.col("left") + F.size("there")).alias("stop"), F.col("agreeing"), F.lit(True).alias("around")))
    judged = compared.withColumn("o", F.explode(F.array(F.coalesce(around, _passage(F.col("equal"), F.col("left"), F.col("at"))) if passages else around)))
    return judged.where("o is not null").select("_owner", "doc_id", "item_id", "o.*")


def _count(equal: Column) -> Column:
    return F.size(F.filter(equal, lambda same: same))


def _passage(equal: Column, left: Column, at: Column) -> Column:
    """The overlap of more than SPAN words around the seed, beginning and ending with equal words, that exceeds AGREE percent most; null if none reaches it."""
    gain = lambda words: _count(words) * 100 - F.size(words) * AGREE

    def best(room: Column, words: Callable[[Column], Column], end: Callable[[Column], Column]) -> Column:
        return F.array_max(F.transform(F.when(room > 0, F.sequence(F.lit(1), room)), lambda n: F.when(end(n), F.struct(gain(words(n)).alias("gain"), n.alias("n")))))

    stop = left + SPAN
    before = best(left, lambda n: F.slice(equal, left - n + 1, n), lambda n: equal[left - n])
    after = best(F.size(equal) - stop, lambda n: F.slice(equal, stop + 1, n), lambda n: equal[stop + n - 1])
    none = F.struct(F.lit(0).alias("gain"), F.lit(0).alias("n"))
    pair = lambda x, y: F.when(x.isNotNull() & y.isNotNull(), F.struct((x["gain"] + y["gain"]).alias("gain"), (x["n"] + y["n"]).alias("n"), x["n"].alias("before"), y["n"].alias("after")))
    most = F.array_max(F.array(pair(before, after), pair(before, none), pair(none, after)))
    first, last = left - most["before"], stop + most["after"]
    found = F.struct((at - most["before"]).alias("start"), (at + SPAN + most["after"]).alias("stop"), _count(F.slice(equal, first + 1, last - first)).alias("agreeing"), F.lit(False).alias("around"))
    return F.when(most["gain"] + gain(F.slice(equal, left + 1, F.lit(SPAN))) >= 0, found)


def short_items(benchmark: DataFrame) -> DataFrame:
    """seed, item_id, near and n of the items under SPAN words: all their words as one window."""
    items = benchmark.where("text is not null").select("item_id", word_hashes(F.col("text")).alias("near")).distinct()
    return items.withColumn("n", F.size("near")).where((F.col("n") > 0) & (F.col("n") < SPAN)).withColumn("seed", F.xxhash64("n", "near"))


def _short_hits(docs: DataFrame, items: DataFrame, n: int, few: bool) -> DataFrame:
    words = docs.select("_owner", "doc_id", word_hashes(F.col("text")).alias("h"))
    at = words.withColumn("at", F.explode(F.when(F.size("h") >= n, F.sequence(F.lit(0), F.size("h") - n))))
    window = F.array(*(F.col("h")[F.col("at") + i] for i in range(n)))
    met = _met(words, at.withColumn("seed", F.xxhash64(F.lit(n), window)), items, few).where(window == F.col("near"))
    return met.select("_owner", "doc_id", "item_id", F.col("at").alias("start"), (F.col("at") + n).alias("stop"), F.lit(n).alias("agreeing"), F.lit(True).alias("around"))


def overlaps(docs: DataFrame, benchmark: DataFrame, passages: bool = False) -> DataFrame:
    """_owner, doc_id, item_id, first and last + 1 word of the verified overlaps, best agreement in words.

    passages: also those that hold a part of the surroundings only, and items under SPAN words; without, the rule of OP4_SQL."""
    keyed = docs.select(F.xxhash64("doc_id", "text").alias("_owner"), "doc_id", "text")
    seeds = staged(item_seeds(benchmark))
    passes = [_hits(keyed, seeds, passages, seeds.count() <= BROADCAST_SEEDS)]
    if passages:
        short = staged(short_items(benchmark))
        for n, count in sorted((x["n"], x["count"]) for x in short.groupBy("n").count().collect()):  # SPAN - 1 rows at most
            passes.append(_short_hits(keyed, short.where(F.col("n") == n).drop("n"), n, count <= BROADCAST_SEEDS))
    # passages count only where nothing agrees over all of the surroundings
    of = lambda how, name: F.coalesce(how(F.when(F.col("around"), F.col(name))), how(name)).cast("long")
    return reduce(DataFrame.union, passes).groupBy("_owner", "doc_id", "item_id").agg(
        of(F.min, "start").alias("first_word"), of(F.max, "stop").alias("last_word"), of(F.max, "agreeing").alias("agreeing")
    )


def decontaminate(docs: DataFrame, benchmark: DataFrame, passages: bool = False) -> DataFrame:
    """docs without the documents that overlap an item."""
    bad = staged(overlaps(docs, benchmark, passages).select(F.col("_owner").alias("_bad")).distinct())
    side = F.broadcast(bad) if bad.count() <= BROADCAST_ROWS else bad
    return docs.join(side, F.xxhash64(docs["doc_id"], docs["text"]) == bad["_bad"], "left_anti")


def op4_spaced_seed_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return overlaps(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), passages=True).drop("_owner")


def _sql_seed(mask: str, words: str, at: str) -> str:
    return " || ' ' || ".join(f"{words}[{at} + {i + 1}]" for i, bit in enumerate(mask) if bit == "1")


OP4_SQL = rf"""
WITH d AS (SELECT hash(doc_id, text) AS o, doc_id, list_filter(regexp_split_to_array(lower(text), '[^\p{{L}}\p{{N}}]+'), lambda x: x <> '') AS h FROM documents WHERE text IS NOT NULL),
b AS (SELECT DISTINCT item_id, list_filter(regexp_split_to_array(lower(text), '[^\p{{L}}\p{{N}}]+'), lambda x: x <> '') AS h FROM benchmark WHERE text IS NOT NULL),
dp AS (SELECT o, doc_id, h, unnest(range(0, len(h) - {SPAN - 1})) AS p FROM d),
bp AS (SELECT item_id, h, unnest(range(0, len(h) - {SPAN - 1})) AS q FROM b),
ds AS ({" UNION ALL ".join(f"SELECT o, doc_id, h, p, {n} AS m, {_sql_seed(mask, 'h', 'p')} AS s FROM dp" for n, mask in enumerate(MASKS))}),
bs AS ({" UNION ALL ".join(f"SELECT item_id, h, q, {n} AS m, {_sql_seed(mask, 'h', 'q')} AS s FROM bp" for n, mask in enumerate(MASKS))}),
hit AS (SELECT o, doc_id, item_id, p, q, ds.h AS dh, bs.h AS bh, least(q, {FLANK}) AS lw, least(q, {FLANK}, p) AS l,
               least(len(bs.h), q + {SPAN + FLANK}) - q AS r FROM ds JOIN bs USING (m, s)),
seen AS (SELECT o, doc_id, item_id, p - l AS start, least(len(dh), p + r) AS stop, lw + r AS wanted,
                len(list_filter(range(-l, r), lambda i: p + i < len(dh) AND dh[p + i + 1] = bh[q + i + 1])) AS agreeing FROM hit)
SELECT doc_id, item_id, CAST(min(start) AS BIGINT) AS first_word, CAST(max(stop) AS BIGINT) AS last_word, CAST(max(agreeing) AS BIGINT) AS agreeing
FROM seen WHERE agreeing * 100 >= {AGREE} * wanted GROUP BY o, doc_id, item_id
"""
