"""Text chunkers: rows of documents to rows of chunks.

A chunker is sequential inside one document and independent between documents,
so it runs where the documents are, without a shuffle.  Windows of words and
sentences, runs of sentences and paragraphs are expressions (folds over arrays,
see `packing`) and stay in the JVM; groups of similar sentences are found in Arrow
batches (`grouping`) and made chunks in the JVM.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F

from loomline.functions.text import join_sentences, let, paragraphs, sentences, word_count_ws, words
from loomline.operators.grouping import groups
from loomline.operators.packing import CHUNKS, chunk, filled, joins, merged, noted, shown, spans, sums_before
from loomline.sources.work import checkpointed, spread

SCHEMA = "chunk_index int, content string, start_pos int, end_pos int, metadata map<string,string>"


@dataclass(frozen=True)
class Config:
    """Settings of all chunkers; sizes in characters unless named otherwise."""

    chunk_size: int = 1000
    overlap_size: int = 200
    min_chunk_size: int = 100
    remove_empty_chunks: bool = True
    window_size: int = 100  # words
    step_size: int = 50  # words, or sentences when windows keep sentences whole
    use_sentences: bool = True
    max_sentences: int = 10
    min_sentences: int = 2
    sentence_overlap: int = 1
    paragraphs: bool = True
    language: str = "zh"
    similarity: float = 0.7
    min_similarity_sentences: int = 3
    batch: int = 64
    placeholder: bool = False  # name sentences by number instead of showing them

    def __post_init__(self) -> None:
        if not (self.chunk_size > 0 and 0 <= self.overlap_size < self.chunk_size and self.min_chunk_size > 0):
            raise ValueError("sizes must be positive and the overlap smaller than a chunk")
        if self.step_size <= 0 or self.window_size <= 0 or self.max_sentences <= self.sentence_overlap or self.sentence_overlap < 0:
            raise ValueError("windows must advance")


SENTENCE_KEYS = ("chunk_method", "is_complete_text", "sentence_count", "word_count", "sentence_start_index", "sentence_end_index", "has_overlap", "overlap_sentences")
PARAGRAPH_KEYS = (*SENTENCE_KEYS, "paragraph_index", "is_complete_paragraph", "is_paragraph_part", "paragraph_count", "paragraph_start_index", "paragraph_end_index")
WINDOW_KEYS = ("chunk_method", "is_complete_text", "word_count", "sentence_count", "sentence_start_index", "sentence_end_index", "word_start_index", "word_end_index", "overlap_with_previous", "overlap_with_next", "is_final_chunk")
SEMANTIC_KEYS = ("chunk_method", "is_complete_text", "sentence_count", "sentence_indices", "avg_similarity", "similarity_threshold", "similarity_score", "word_count")


def _whole(text: Column, keys: tuple[str, ...], method: str, **notes: object) -> Column:
    return F.array(chunk(F.lit(0), text, noted(keys, chunk_method=method, is_complete_text=True, **notes)))


def _merged(chunks: Column, keys: tuple[str, ...], config: Config) -> Column:
    return merged(chunks, keys, config.min_chunk_size, 1.5 * config.chunk_size, config.remove_empty_chunks)


def sliding_words(text: Column, config: Config) -> Column:
    """Windows of words, and a last one where steps leave words over."""
    size, step, keys = config.window_size, config.step_size, WINDOW_KEYS

    def windows(w: Column, before: Column) -> Column:
        n = F.size(w)

        def window(number: Column, first: Column, **notes: Column) -> Column:
            content = F.array_join(F.slice(w, first + 1, size), " ")
            at = F.get(before, first)
            end = F.length(text) if "is_final_chunk" in notes else at + F.length(content)
            return chunk(number, content, noted(keys, chunk_method="sliding_window_words", word_count=F.lit(size), word_start_index=first, word_end_index=first + size, **notes), at, end)

        def with_last(steps: Column) -> Column:
            last = window(F.size(steps), n - size, is_final_chunk=F.lit(True))
            return let(last, lambda t: F.when((n % step != 0) & (F.get(steps, F.size(steps) - 1)["content"] != t["content"]), F.concat(steps, F.array(t))).otherwise(steps))

        starts = F.sequence(F.lit(0), n - size, F.lit(step))
        return let(F.transform(starts, lambda first, i: window(i, first, overlap_with_previous=first > 0, overlap_with_next=first + size < n)), with_last)

    def over(w: Column) -> Column:
        many = let(sums_before(F.transform(w, lambda x: F.length(x) + 1)), lambda before: windows(w, before))
        return F.when(F.size(w) > size, _merged(many, keys, config)).otherwise(_whole(text, keys, "sliding_window_words", word_count=F.size(w)))

    return let(words(text), over)


def sliding_sentences(text: Column, config: Config) -> Column:
    """Whole sentences until a window has its words."""
    keys, size, step = WINDOW_KEYS, config.window_size, config.step_size

    def over(parts: Column, counts: Column) -> Column:
        def made(s: Column) -> Column:
            content = F.array_join(F.slice(parts, s["start"] + 1, s["stop"] - s["start"]), ". ")
            total = F.aggregate(F.slice(counts, s["start"] + 1, s["stop"] - s["start"]), F.lit(0), lambda a, x: a + x)
            notes = noted(
                keys, chunk_method="sliding_window_sentences", sentence_count=s["stop"] - s["start"], word_count=total, sentence_start_index=s["start"], sentence_end_index=s["stop"],
                overlap_with_previous=s["i"] > 0, overlap_with_next=s["follow"] < F.size(parts),
            )
            return let(content, lambda c: let(F.when(c.endswith("."), c).otherwise(F.concat(c, F.lit("."))), lambda c: chunk(s["i"], c, notes)))

        found = spans(F.size(parts), lambda start: start + filled(counts, start, size, size), lambda i, start, stop: F.when((i > 0) & (stop - start > step), start + step).otherwise(stop))
        return _merged(F.transform(found, made), keys, config)

    return let(sentences(text, "mixed", collapse=False), lambda parts: let(F.transform(parts, word_count_ws), lambda counts: over(parts, counts)))


def sliding_window(text: Column, config: Config) -> Column:
    """Windows of words, or of whole sentences."""
    return (sliding_sentences if config.use_sentences else sliding_words)(text, config)


def _join(parts: Column, config: Config) -> Column:
    return join_sentences(parts, config.language)


def sentence_runs(text: Column, config: Config, keys: tuple[str, ...] = SENTENCE_KEYS) -> Column:
    """Sentences until a chunk has its number or its size, the last ones repeated in the next."""
    c = config

    def over(parts: Column) -> Column:
        n = F.size(parts)

        def made(s: Column) -> Column:
            count, back = s["stop"] - s["start"], F.when(s["i"] > 0, c.sentence_overlap).otherwise(0)
            return let(
                _join(F.slice(parts, s["start"] + 1, count), c),
                lambda content: chunk(s["i"], content, noted(
                    keys, chunk_method="sentence_based", sentence_count=count, word_count=word_count_ws(content), sentence_start_index=s["start"], sentence_end_index=s["stop"],
                    has_overlap=back > 0, overlap_sentences=back,
                )),
            )

        def runs(lengths: Column) -> Column:
            stop = lambda start: F.greatest(start + filled(lengths, start, c.max_sentences, c.chunk_size), F.least(n, start + c.min_sentences))
            follow = lambda i, start, stop: stop - F.when(i > 0, F.least(F.lit(c.sentence_overlap), stop - start - 1)).otherwise(0)
            return _merged(F.transform(spans(n, stop, follow), made), keys, c)

        one = F.when(n > 0, _whole(text, keys, "sentence_complete", sentence_count=n)).otherwise(F.array().cast(CHUNKS))
        return F.when(n > c.max_sentences, let(F.transform(parts, F.length), runs)).otherwise(one)

    return let(sentences(text, c.language), over)


#: Paragraphs after a short one that are looked at first; few texts have more that fit.
AHEAD = 32


def paragraph_chunks(text: Column, config: Config) -> Column:
    """Paragraphs; a long one in windows of sentences, a short one with those after it that fit, which then also stand for themselves."""
    c, keys = config, PARAGRAPH_KEYS
    kind = "array<struct<content string, notes array<string>>>"

    def one(content: Column, **notes: object) -> Column:
        return F.struct(content.alias("content"), noted(keys, **notes).alias("notes"))

    def over(texts: Column, parts: Column, sizes: Column) -> Column:
        def following(i: Column, own: Column) -> Column:
            """(paragraphs after i that fit, their sentences)."""
            zero = F.struct(F.lit(0).alias("n"), F.lit(0).alias("total"), F.lit(False).alias("full"))
            more = lambda a, x: F.when(a["full"] | (own + a["total"] + x > c.max_sentences), F.struct(a["n"].alias("n"), a["total"].alias("total"), F.lit(True).alias("full"))).otherwise(F.struct((a["n"] + 1).alias("n"), (a["total"] + x).alias("total"), F.lit(False).alias("full")))
            some = lambda most: F.aggregate(F.slice(sizes, i + 2, most), zero, more)
            return let(some(F.lit(AHEAD)), lambda a: F.when(a["full"] | (i + 1 + AHEAD >= F.size(sizes)), a).otherwise(some(F.size(sizes))))

        def alone(i: Column, own: Column) -> Column:
            whole = F.array(one(F.get(texts, i), chunk_method="paragraph_complete", paragraph_index=i, sentence_count=own, is_complete_paragraph=True))

            def window(first: Column) -> Column:
                stop = F.least(own, first + c.max_sentences)
                content = _join(F.slice(F.get(parts, i), first + 1, c.max_sentences), c)
                return one(content, chunk_method="paragraph_sentence_split", paragraph_index=i, sentence_count=stop - first, sentence_start_index=first, sentence_end_index=stop, is_paragraph_part=True)

            split = F.transform(F.sequence(F.lit(0), own - 1, F.lit(c.max_sentences - c.sentence_overlap)), window)
            return F.when(own <= c.max_sentences, whole).otherwise(split)

        def of(i: Column) -> Column:
            def made(own: Column) -> Column:
                def short(after: Column) -> Column:
                    total, stop = own + after["total"], i + 1 + after["n"]
                    both = one(F.array_join(F.slice(texts, i + 1, after["n"] + 1), "\n\n"), chunk_method="paragraph_combined", paragraph_count=after["n"] + 1, sentence_count=total, paragraph_start_index=i, paragraph_end_index=stop)
                    return F.when(total >= c.min_sentences, F.array(both)).otherwise(alone(i, own))

                return F.when(own == 0, F.array().cast(kind)).when(own < c.min_sentences, let(following(i, own), short)).otherwise(alone(i, own))

            return let(F.get(sizes, i), made)

        pieces = F.flatten(F.transform(F.sequence(F.lit(0), F.size(texts) - 1), of))
        at = keys.index("word_count")
        numbered = F.transform(pieces, lambda p, i: chunk(i, p["content"], F.transform(p["notes"], lambda v, k: F.when(k == at, word_count_ws(p["content"]).cast("string")).otherwise(v))))
        return _merged(numbered, keys, c)

    def split(texts: Column) -> Column:
        many = let(F.transform(texts, lambda t: sentences(t, c.language)), lambda parts: let(F.transform(parts, F.size), lambda sizes: over(texts, parts, sizes)))
        return F.when(F.size(texts) > 0, many).otherwise(sentence_runs(text, c, keys))

    return let(paragraphs(text), split)


def by_sentences(text: Column, config: Config) -> Column:
    """Runs of whole sentences, within paragraphs if asked."""
    return paragraph_chunks(text, config) if config.paragraphs else sentence_runs(text, config)


def semantic_groups(config: Config, load: Callable[[], Callable[[list[str]], np.ndarray]] | None = None) -> Callable[[Column], Column]:
    """Function of a column of sentences: the groups that belong together, as arrays of their numbers; load() makes an encoder once a task."""

    @F.arrow_udf("array<array<int>>")
    def grouped(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encode = load() if load else None
        for column in batches:
            found = [groups(parts, config.similarity, config.chunk_size, config.batch, encode) if parts else [] for parts in column.to_pylist()]
            yield pa.array(found, pa.list_(pa.list_(pa.int32())))

    return grouped


def semantic(parts: Column, found: Column, text: Column, config: Config) -> Column:
    """Chunks of groups of similar sentences, which need not be neighbours."""
    keys = SEMANTIC_KEYS

    def made(parts: Column, groups_: Column, c: Column) -> Column:
        """A chunk of some groups: content of all, notes of the last one, as `merged` has them."""
        last = F.get(groups_, c["at"] + c["n"] - 1)
        joined = lambda g: F.array_join(F.transform(g, lambda j: F.get(parts, j)), " ")

        def noted_(group: Column, own: Column) -> Column:
            n = F.size(group)
            likeness = F.when(n == 1, F.lit(1.0)).otherwise(F.greatest(F.lit(0.5), F.lit(1.0) - (n - 1) * F.lit(0.1)))
            notes = noted(
                keys, chunk_method="semantic_similarity", sentence_count=n, sentence_indices=F.concat(F.lit("["), F.array_join(group.cast("array<string>"), ", "), F.lit("]")),
                avg_similarity=likeness, similarity_threshold=F.lit(float(config.similarity)), word_count=F.length(own) - F.length(F.replace(own, F.lit(" "), F.lit(""))) + 1,  # sentences have single blanks
            )
            content = F.when(c["n"] == 1, own).otherwise(joined(F.flatten(F.slice(groups_, c["at"] + 1, c["n"]))))
            return chunk(c["at"], content, notes, end=F.length(own))

        return let(last, lambda group: let(joined(group), lambda own: noted_(group, own)))

    def over(parts: Column, groups_: Column) -> Column:
        sizes = F.transform(groups_, lambda g: F.aggregate(g, F.size(g) - 1, lambda a, j: a + F.length(F.get(parts, j))))
        return F.transform(joins(sizes, config.min_chunk_size, 1.5 * config.chunk_size), lambda c: made(parts, groups_, c))

    shown_ = F.transform(parts, lambda _, j: F.concat(F.lit("句子"), j.cast("string"))) if config.placeholder else parts
    many = let(F.transform(found, lambda g: F.array_sort(g)), lambda g: let(shown_, lambda p: over(p, g)) if config.placeholder else over(parts, g))
    return F.when(F.size(parts) > config.min_similarity_sentences, many).otherwise(_whole(text, keys, "semantic_complete", sentence_count=F.size(parts), similarity_score=F.lit(1.0)))


#: Chunkers that are expressions of a text: (function of it and Config, names of notes by Config).
EXPRESSIONS: dict[str, tuple[Callable[[Column, Config], Column], Callable[[Config], tuple[str, ...]]]] = {
    "sliding_window": (sliding_window, lambda c: WINDOW_KEYS),
    "sentence": (by_sentences, lambda c: PARAGRAPH_KEYS if c.paragraphs else SENTENCE_KEYS),
}


@dataclass
class Chunk:
    """What a registered chunker returns."""

    content: str
    index: int
    start: int
    end: int
    metadata: dict

    @classmethod
    def of(cls, content: str, index: int, method: str, **metadata: object) -> Chunk:
        return cls(content, index, 0, len(content), {"chunk_method": method, **metadata})


#: Chunkers that others have registered.
CHUNKERS: dict[str, Callable[..., list[Chunk]]] = {}


def register(name: str, chunker: Callable[..., list[Chunk]]) -> None:
    """Make a chunker (text, config) -> chunks available by name; it runs in Arrow batches."""
    CHUNKERS[name.lower()] = chunker


def described() -> dict[str, str]:
    """Chunkers by name, with what they do."""
    known = {name: f for name, (f, _) in EXPRESSIONS.items()} | {"semantic": semantic} | CHUNKERS
    return {name: (f.__doc__ or "").strip().split("\n")[0] for name, f in sorted(known.items())}


def numbered(docs: DataFrame, order: str, key: str = "document_id") -> DataFrame:
    """docs with document_index, gapless from 0 by `order`, and `key`: its own, or doc_ and the index where it is missing.

    One sorted pass, whose rows are checkpointed since a second pass could cut other
    ranges, and one count of each partition."""
    placed = checkpointed(docs.repartitionByRange(F.col(order)).sortWithinPartitions(order).withColumns({"_part": F.spark_partition_id(), "_row": F.monotonically_increasing_id()}))
    first = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"), F.min("_row").alias("_first"))
    earlier = F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))  # a row a partition
    index = F.col("_row") - F.col("_first") + F.col("_before")
    found = placed.join(F.broadcast(first.withColumn("_before", earlier)), "_part").withColumn("document_index", index)
    default = F.concat(F.lit("doc_"), F.col("document_index").cast("string"))
    return found.withColumn(key, F.coalesce(F.col(key).cast("string"), default) if key in docs.columns else default).drop("_part", "_row", "_first", "_before", "_n")


def _registered(docs: DataFrame, chunker: Callable[..., list[Chunk]], config: Config, key: str, text: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, chunks = [], []
            for i, value in enumerate(batch.column(1).to_pylist()):
                made = chunker(value, config) if value and value.strip() else []
                keys += [i] * len(made)
                chunks += made
            yield pa.RecordBatch.from_arrays([
                batch.column(0).take(pa.array(keys, pa.int64())), pa.array([c.index for c in chunks], pa.int32()), pa.array([c.content for c in chunks], pa.string()), pa.array([c.start for c in chunks], pa.int32()),
                pa.array([c.end for c in chunks], pa.int32()), pa.array([[(k, str(v)) for k, v in c.metadata.items()] for c in chunks], pa.map_(pa.string(), pa.string())),
            ], [key, "chunk_index", "content", "start_pos", "end_pos", "metadata"])

    return spread(docs.select(F.col(key), F.col(text))).mapInArrow(run, f"{key} {dict(docs.dtypes)[key]}, {SCHEMA}")


def chunk_documents(docs: DataFrame, kind: str, config: Config | None = None, key: str = "id", text: str = "content", load: Callable[[], Callable[[list[str]], np.ndarray]] | None = None) -> DataFrame:
    """Chunks of every document: key, then SCHEMA; a null or blank text has none. load() makes a sentence encoder."""
    config, kind = config or Config(), kind.lower()
    if kind in CHUNKERS:
        return _registered(docs, CHUNKERS[kind], config, key, text)
    t = F.col("_text")
    some = spread(docs.select(F.col(key), F.col(text).alias("_text")).where(t.rlike(r"(?U)\S")))
    if kind == "semantic":
        # evaluated once, before and after the one Python node
        parts = some.select("*", F.explode(F.array(sentences(t, config.language))).alias("_parts"))
        few = F.size("_parts") <= config.min_similarity_sentences
        found = semantic_groups(config, load)(F.when(few, F.array().cast("array<string>")).otherwise(F.col("_parts")))
        grouped = parts.withColumn("_groups", found)
        chunks, keys = semantic(F.col("_parts"), F.col("_groups"), t, config), SEMANTIC_KEYS
        return grouped.select(F.col(key), F.inline(shown(chunks, keys)))
    expression, keys = EXPRESSIONS[kind]
    return some.select(F.col(key), F.inline(shown(expression(t, config), keys(config))))


def chunk_text(spark: SparkSession, text: str | None, kind: str, config: Config | None = None, load: Callable | None = None) -> list[Row]:
    """Chunks of one text, in order."""
    one = spark.createDataFrame([(0, text)], "id int, content string")
    return sorted(chunk_documents(one, kind, config, load=load).collect(), key=lambda r: r.chunk_index)


def word_windows(words: Column, window: int, step: int) -> Column:
    """Array of (first word, content) windows over an array of words; one window if it is short."""

    def shown(w: Column, first: Column) -> Column:
        return F.struct(first.alias("word_start"), F.array_join(F.slice(w, first + 1, window), " ").alias("content"))

    def over(w: Column) -> Column:
        n = F.size(w)
        spans = F.transform(F.sequence(F.lit(0), n - window, F.lit(step)), lambda i: shown(w, i))
        with_tail = let(spans, lambda s: let(shown(w, n - window), lambda t: F.when((n % step != 0) & (F.element_at(s, -1)["content"] != t["content"]), F.concat(s, F.array(t))).otherwise(s)))
        return F.when(n > window, with_tail).otherwise(F.array(shown(w, F.lit(0))))

    return let(words, over)


def sentence_windows(sentences: Column, size: int, overlap: int, separator: str = " ") -> Column:
    """Array of (first sentence, content) windows over an array of sentences."""
    if size <= overlap:
        raise ValueError("windows must advance")

    def over(s: Column) -> Column:
        starts = F.when(F.size(s) <= size, F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), F.size(s) - 1, F.lit(size - overlap)))
        return F.transform(starts, lambda i: F.struct(i.alias("sentence_start"), F.array_join(F.slice(s, i + 1, size), separator).alias("content")))

    return let(sentences, over)


def chunk_report(docs: DataFrame, config: Config | None = None, key: str = "id", text: str = "content") -> DataFrame:
    """What chunkers would find, without chunking: words, sentences, paragraphs, their ratio, windows of words."""
    c = config or Config()
    t = F.coalesce(F.col(text), F.lit(""))
    counted = docs.select(F.col(key), F.length(t).alias("characters"), F.size(words(t)).alias("words"), F.size(sentences(t, c.language)).alias("sentences"), F.size(paragraphs(t)).alias("paragraphs"))
    n = F.col("words")
    windows = F.when(n == 0, 0).when(n <= c.window_size, 1).otherwise(F.floor((n - c.window_size) / c.step_size) + 1)
    return counted.withColumns({"words_per_sentence": F.when(F.col("sentences") > 0, n / F.col("sentences")), "full_windows": windows.cast("int")})


def sentence_report(docs: DataFrame, config: Config | None = None, key: str = "id", text: str = "content") -> DataFrame:
    """What the sentence chunker would find, without chunking: sentences, paragraphs, words a sentence, chunks at a guess, and its settings."""
    c, t = config or Config(), F.coalesce(F.col(text), F.lit(""))
    counted = spread(docs.select(F.col(key), t.alias("_text"))).select(key, sentences(F.col("_text"), c.language).alias("_parts"), F.size(paragraphs(F.col("_text"))).alias("paragraphs"))
    n = F.size("_parts")
    words_ = F.aggregate(F.transform("_parts", word_count_ws), F.lit(0), lambda a, x: a + x)
    return counted.select(
        key, n.alias("sentences"), "paragraphs", F.round(F.when(n > 0, words_ / n).otherwise(0.0), 2).alias("mean_sentence_words"), F.when(n > 0, F.greatest(F.lit(1), F.floor(n / c.max_sentences).cast("int"))).otherwise(0).alias("estimated_chunks"),
        F.lit(c.max_sentences).alias("max_sentences"), F.lit(c.min_sentences).alias("min_sentences"), F.lit(c.sentence_overlap).alias("sentence_overlap"), F.lit(c.language).alias("language"),
    )


def semantic_report(docs: DataFrame, config: Config | None = None, key: str = "id", text: str = "content", encoder: str | None = None) -> DataFrame:
    """What the semantic chunker would go by, without chunking: sentences, threshold, the encoder's name or words, groups at a guess (null without sentences)."""
    c, t = config or Config(), F.coalesce(F.col(text), F.lit(""))
    n = F.size(sentences(t, c.language))
    counted = docs.select(F.col(key), n.alias("sentences"))
    return counted.select(
        key, "sentences", F.lit(float(c.similarity)).alias("similarity_threshold"), F.lit(encoder is not None).alias("uses_encoder"), F.lit(encoder or "words").alias("compared_by"), F.lit(c.min_similarity_sentences).alias("min_similarity_sentences"),
        F.when(F.col("sentences") > 0, F.greatest(F.lit(1), F.floor(F.col("sentences") / c.min_similarity_sentences).cast("int"))).alias("estimated_groups"),
    )
