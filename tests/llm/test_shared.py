import os

import numpy as np
import pyarrow as pa

from loomline.llm.shared import release, staged, work_dir
from loomline.llm.textkernel import Words, flat, gather, slices, window_hash, window_starts


def test_staged_tables_are_written_once_and_released(spark):
    df = staged(spark.range(5))
    assert df.count() == 5 and "Range" not in df._jdf.queryExecution().executedPlan().toString()
    root = os.path.dirname(work_dir(spark)).removeprefix("file:")
    assert os.path.isdir(root)
    release(spark)
    assert not os.path.isdir(root)


def test_words_of_any_column():
    texts = ["a b", None, "", "  é\x0bx\n", "one", "漢字 b"]
    for column in (pa.array(texts), pa.array(texts, pa.large_string()), pa.chunked_array([texts[:2], texts[2:]]), pa.array(["zz", *texts]).slice(1)):
        data, offsets = flat(column)
        words = Words(data, offsets)
        assert words.counts.tolist() == [2, 0, 0, 2, 1, 2]
        shown = [bytes(data[a:b]).decode() for a, b in zip(words.start, words.end)]
        assert shown == ["a", "b", "é", "x", "one", "漢字", "b"]
        assert words.hash[1] == words.hash[6] and len(set(words.hash.tolist())) == 6
    assert flat(pa.array([], pa.string()))[1].tolist() == [0]


def test_windows_do_not_cross_rows_and_do_not_depend_on_place():
    data, offsets = flat(pa.array(["a b c d", "x", "", "b c d e"]))
    words = Words(data, offsets)
    starts = window_starts(words.first, 3)
    assert starts.tolist() == [0, 1, 5, 6]
    hashes = window_hash(words.hash, starts, 3)
    assert hashes[1] == hashes[2] and len(set(hashes.tolist())) == 3
    assert window_starts(words.first, 9).tolist() == []


def test_slices_and_gather():
    offsets = np.array([0, 5, 5, 30, 31])
    assert list(slices(offsets, 8)) == [(0, 2), (2, 3), (3, 4)]
    assert gather(np.arange(10), np.array([3, 0, 8]), np.array([2, 0, 1])).tolist() == [3, 4, 8]
