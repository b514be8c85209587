"""Shuffling packed arrays by range of hash, with a bounded number of rows a task.

A task sends one row for each range that it holds entries of.  With as many
ranges as the input has partitions these rows would grow with its square, so a
task deals into FAN_OUT coarse ranges at most; where more are needed, rows of a
coarse range are shared out to tasks, each of which cuts its share into the
fine ranges inside it.  Every task then sends FAN_OUT rows at most, twice.
"""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rows that one task sends, at most, for one batch of entries.
FAN_OUT = 1024


def ranges_for(docs: DataFrame) -> int:
    """Ranges that entries of docs are dealt into: a multiple of what is sent first."""
    ranges = max(4, 2 * docs.rdd.getNumPartitions())
    slots = coarse(ranges)
    return slots * -(-ranges // slots)


def coarse(ranges: int) -> int:
    """Ranges that a task deals into at first."""
    return min(ranges, FAN_OUT)


def spread(packed: DataFrame, schema: str, slots: int, ranges: int, resplit: Callable[[pa.Table, int, int], pa.Table]) -> DataFrame:
    """packed, by coarse range, with rows by fine range; resplit(rows of one coarse range, slots, ranges) cuts them."""
    if slots == ranges:
        return packed
    share = ranges // slots

    def cut(group: pa.Table) -> pa.Table:
        return resplit(group, slots, ranges)

    # rows of a coarse range are dealt by a hash of their content to `share` tasks
    key, *others = [c.split()[0] for c in schema.split(", ")]
    return packed.withColumn("share", F.pmod(F.xxhash64(*others), F.lit(share))).groupBy(key, "share").applyInArrow(lambda g: cut(g.drop_columns(["share"])), schema)
