"""Packing items of a text into chunks by folds that stay in the JVM.

A text is an array; what is sequential about it (where the next chunk begins,
which small chunk joins the one before) is a left fold with a state of fixed
size.  Folds are cut into blocks, so that an output costs a copy of a block, not
of all outputs before it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from loomline.functions.text import let

#: Outputs that one step of a fold copies at most.
BLOCK = 256

CHUNKS = "array<struct<chunk_index int, content string, start_pos int, end_pos int, notes array<string>>>"


def fold(items: Column, zero: Column, step: Callable[[Column, Column], Column], out: str) -> Column:
    """Outputs of step(state, item), a struct of the next `state` and an `out` of this type, for all items in order."""
    none = F.array().cast(f"array<{out}>")

    def one(acc: Column, item: Column) -> Column:
        return let(step(acc["state"], item), lambda r: F.struct(r["state"].alias("state"), F.concat(acc["outs"], F.array(r["out"])).alias("outs")))

    def over(all_: Column) -> Column:
        def block(acc: Column, number: Column) -> Column:
            inner = F.aggregate(F.slice(all_, number * BLOCK + 1, F.lit(BLOCK)), F.struct(acc["state"].alias("state"), none.alias("outs")), one)
            return let(inner, lambda r: F.struct(r["state"].alias("state"), F.concat(acc["outs"], F.array(r["outs"])).alias("outs")))

        blocks = F.sequence(F.lit(0), F.floor((F.size(all_) - 1) / BLOCK).cast("int"))
        start = F.struct(zero.alias("state"), F.array().cast(f"array<array<{out}>>").alias("outs"))
        return F.when(F.size(all_) > 0, F.aggregate(blocks, start, block, lambda acc: F.flatten(acc["outs"]))).otherwise(none)

    return let(items, over)


def sums_before(lengths: Column) -> Column:
    """For each length, the sum of those before it."""
    return fold(lengths, F.lit(0), lambda total, n: F.struct((total + n).alias("state"), total.alias("out")), "int")


def filled(lengths: Column, start: Column, most: int, size: int) -> Column:
    """How many items from start on fit while there are fewer than `most` and their lengths sum to less than `size`."""
    zero = F.struct(F.lit(0).alias("total"), F.lit(0).alias("n"))
    more = lambda a, x: F.when(a["total"] < size, F.struct((a["total"] + x).alias("total"), (a["n"] + 1).alias("n"))).otherwise(a)
    return F.aggregate(F.slice(lengths, start + 1, F.lit(most)), zero, more, lambda a: a["n"])


def spans(n: Column, stop: Callable[[Column], Column], follow: Callable[[Column, Column, Column], Column]) -> Column:
    """Array of (i, start, stop, follow): span i of n items goes from start to stop(start), the next from follow(i, start, stop)."""
    kind = "struct<i int, start int, stop int, follow int>"

    def step(state: Column, item: Column) -> Column:
        def found(end: Column) -> Column:
            return let(follow(state["i"], item, end), lambda f: F.struct(F.struct(f.alias("start"), (state["i"] + 1).alias("i")).alias("state"), F.struct(state["i"].alias("i"), item.alias("start"), end.alias("stop"), f.alias("follow")).alias("out")))

        return F.when(item == state["start"], let(stop(item), found)).otherwise(F.struct(state.alias("state"), F.lit(None).cast(kind).alias("out")))

    items = F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))
    return F.filter(fold(items, F.struct(F.lit(0).alias("start"), F.lit(0).alias("i")), step, kind), lambda s: s.isNotNull())


def chunk(index: Column, content: Column, notes: Column, start: Column | None = None, end: Column | None = None) -> Column:
    """A chunk; by itself it reaches from 0 to its length."""
    first = F.lit(0) if start is None else start
    return F.struct(index.cast("int").alias("chunk_index"), content.alias("content"), first.cast("int").alias("start_pos"), (F.length(content) if end is None else end).cast("int").alias("end_pos"), notes.alias("notes"))


def noted(keys: tuple[str, ...], **values: object) -> Column:
    """What is known of a chunk, as text, in the order of keys; null where it is not."""
    missing = set(values) - set(keys)
    if missing:
        raise ValueError(f"no such note: {missing}")
    none = F.lit(None).cast("string")
    return F.array(*((values[k] if isinstance(values[k], Column) else F.lit(values[k])).cast("string") if k in values else none for k in keys))


def joins(lengths: Column, least: int, most: float) -> Column:
    """Array of (at, n): chunks of these lengths that become one, from the chunk at on; one shorter than `least` joins its predecessor by a space if both have `most` characters at most."""

    def step(state: Column, n: Column) -> Column:
        small = (state >= 0) & (n < least) & (state + n <= most)
        return F.struct(F.when(small, state + 1 + n).otherwise(n).alias("state"), (~small).alias("out"))

    def over(all_: Column) -> Column:
        heads = F.filter(F.transform(fold(all_, F.lit(-1), step, "boolean"), lambda b, i: F.when(b, i)), lambda i: i.isNotNull())
        return let(heads, lambda h: F.transform(h, lambda at, i: F.struct(at.alias("at"), (F.coalesce(F.get(h, i + 1), F.size(all_)) - at).alias("n"))))

    return let(lengths, over)


def merged(chunks: Column, keys: tuple[str, ...], least: int, most: float, drop_blank: bool = True) -> Column:
    """Blank chunks dropped; one shorter than `least` joined to its predecessor by a space if both have `most` characters at most.

    Indexes keep their gaps; a note of the later chunk wins."""

    def joined(many: Column) -> Column:
        last = lambda k: let(F.filter(F.transform(many, lambda c: c["notes"][k]), lambda v: v.isNotNull()), lambda v: F.get(v, F.size(v) - 1))
        notes = F.transform(F.sequence(F.lit(0), F.lit(len(keys) - 1)), last)
        return chunk(many[0]["chunk_index"], F.array_join(F.transform(many, lambda c: c["content"]), " "), notes, many[0]["start_pos"], F.get(many, F.size(many) - 1)["end_pos"])

    def over(kept: Column) -> Column:
        found = joins(F.transform(kept, lambda c: F.length(c["content"])), least, most)
        return F.transform(found, lambda c: F.when(c["n"] == 1, F.get(kept, c["at"])).otherwise(let(F.slice(kept, c["at"] + 1, c["n"]), joined)))

    return let(F.filter(chunks, lambda c: c["content"].rlike(r"(?U)\S")) if drop_blank else chunks, over)


def shown(chunks: Column, keys: tuple[str, ...]) -> Column:
    """Chunks with their notes as a map."""
    names = F.array(*map(F.lit, keys))
    return F.transform(chunks, lambda c: F.struct(c["chunk_index"].alias("chunk_index"), c["content"].alias("content"), c["start_pos"].alias("start_pos"), c["end_pos"].alias("end_pos"), F.map_filter(F.map_from_arrays(names, c["notes"]), lambda _, v: v.isNotNull()).alias("metadata")))
