"""Windows of words or sentences from SQL, over a whole table:

    SELECT * FROM chunk(TABLE(SELECT id, content FROM articles), 'words', 100, 50)

The table has two columns, a key of any type and the text.  Rows out: the key, under
its name, chunk_index, first (the first word or sentence) and content.  Windows are
those of `chunkers.word_windows` and `chunkers.sentence_windows` (step: size less
overlap); a null text is an empty one.  Rows are independent, so nothing is shuffled.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

from pyspark.sql import SparkSession
from pyspark.sql import types as T
from pyspark.sql.udtf import AnalyzeArgument, AnalyzeResult

from loomline.functions.text import ENDS


def windows(items: list[str], size: int, step: int, tail: bool) -> Iterator[tuple[int, str]]:
    """(first, content) of windows of blank-joined items; tail: a last whole window where steps leave some over, unless it is like the one before."""
    n, content = len(items), None
    for first in range(0, n - size + 1 if tail else n, step) if n > size else [0]:
        content = " ".join(items[first : first + size])
        yield first, content
    if tail and n > size and n % step and (last := " ".join(items[n - size :])) != content:
        yield n - size, last


class Chunk:
    """The table function; see the module."""

    @staticmethod
    def analyze(docs: AnalyzeArgument, kind: AnalyzeArgument, size: AnalyzeArgument, step: AnalyzeArgument) -> AnalyzeResult:
        if not docs.isTable or len(docs.dataType.fields) != 2 or not isinstance(docs.dataType.fields[1].dataType, T.StringType):
            raise ValueError("chunk needs a table of a key and a text")
        if kind.value not in ("words", "sentences") or not size.isConstantExpression or not step.isConstantExpression or size.value < 1 or step.value < 1:
            raise ValueError("chunk makes windows of 'words' or 'sentences', of a constant size and step of one or more")
        key = docs.dataType.fields[0]
        fields = [T.StructField("chunk_index", T.IntegerType()), T.StructField("first", T.IntegerType()), T.StructField("content", T.StringType())]
        return AnalyzeResult(T.StructType([T.StructField(key.name, key.dataType), *fields]))

    def eval(self, docs: T.Row, kind: str, size: int, step: int) -> Iterator[tuple]:
        text = docs[1] or ""
        if kind == "words":
            items = text.split()
        else:
            items = [p for p in (" ".join(s.split()) for s in re.split(ENDS["en"], text)) if p]
        for i, (first, content) in enumerate(windows(items, size, step, kind == "words")):
            yield docs[0], i, first, content


def register(spark: SparkSession, name: str = "chunk") -> None:
    from pyspark.sql.functions import udtf

    spark.udtf.register(name, udtf(Chunk))
