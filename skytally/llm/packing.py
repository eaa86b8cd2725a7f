"""Best-fit packing into sequences of several permitted lengths.

Documents become items of their token count; one longer than the largest permitted length is cut
into pieces of that length and a rest. Items are packed in cells of ``CELL_ITEMS`` consecutive
items of a partition, so nothing is shuffled and a task holds one cell. In a cell, items enter in
falling order of length: into the tightest open bin with room, found by binary search in a list
sorted by room; else a bin is opened whose length costs least per token it can be expected to
hold: ``length + OVERHEAD`` over the item and what of the shorter items still to come fits beside it.
At last each bin is cut down to the smallest permitted length that holds its contents.

Cases: a null or empty text has one token, its end mark; repeated rows are packed each; lengths of
zero or null count as one; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skytally.llm.quality import SPACE_RUN
from skytally.llm.registry import read, register, ship

LENGTHS = (512, 1024, 2048, 4096, 8192)
OVERHEAD = 32
CELL_ITEMS = 8192

SCHEMA = ("doc_id long, piece int, start long, n_tokens int, bin_id string, bin_offset int, "
          "bin_used int, bin_length int")



def pack(sizes: Sequence[int], lengths: Sequence[int] = LENGTHS) -> tuple[list[int], list[int], list[int]]:
    """Bin and offset of each item, and each bin's final length. Items fit the largest length."""
    lengths = sorted(lengths)
    order = sorted(range(len(sizes)), key=lambda i: (-sizes[i], i))
    bins, offsets = [0] * len(sizes), [0] * len(sizes)
    open_bins: list[tuple[int, int]] = []  # room and number, sorted
    used: list[int] = []
    left = sum(sizes)
    for i in order:
        size = sizes[i]
        left -= size
        at = bisect.bisect_left(open_bins, (size, -1))
        if at < len(open_bins):
            room, number = open_bins.pop(at)
        else:
            number, room = len(used), min(
                (n for n in lengths if n >= size),
                key=lambda n: ((n + OVERHEAD) / (size + min(n - size, left)), n))
            used.append(0)
        bins[i], offsets[i] = number, used[number]
        used[number] += size
        if room > size:
            bisect.insort(open_bins, (room - size, number))
    return bins, offsets, [next(n for n in lengths if n >= u) for u in used]


def word_tokens(text: Column) -> Column:
    """Words and an end mark: a stand-in for a tokenizer's count, computed in Spark."""
    words = F.filter(F.split(F.coalesce(text, F.lit("")), SPACE_RUN), lambda w: w != "")
    return F.size(words) + 1


def pack_documents(docs: DataFrame, tokens: Column, key: str = "doc_id",
                   lengths: Sequence[int] = LENGTHS) -> DataFrame:
    """A row per piece: its place in the document, and its bin, offset and the bin's length."""
    ship(docs.sparkSession)
    rows = docs.select(F.col(f"`{key}`").cast("long").alias("doc_id"),
                       F.greatest(F.coalesce(tokens, F.lit(1)), F.lit(1)).cast("long").alias("n"))
    lengths = tuple(sorted(lengths))

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, cell, items = TaskContext.get().partitionId(), 0, []
        names = [c.split()[0] for c in SCHEMA.split(", ")]

        def packed() -> pa.RecordBatch:
            bins, offsets, final = pack([item[3] for item in items], lengths)
            full = [0] * len(final)
            for number, item in zip(bins, items):
                full[number] += item[3]
            doc, piece, start, size = zip(*items)
            return pa.RecordBatch.from_arrays([
                pa.array(doc, pa.int64()), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                pa.array(size, pa.int32()), pa.array([f"{part}-{cell}-{b}" for b in bins]),
                pa.array(offsets, pa.int32()), pa.array([full[b] for b in bins], pa.int32()),
                pa.array([final[b] for b in bins], pa.int32())], names=names)

        for batch in batches:
            for doc, n in zip(batch.column("doc_id").to_pylist(), batch.column("n").to_pylist()):
                for number in range(-(-n // lengths[-1])):
                    start = number * lengths[-1]
                    items.append((doc, number, start, min(lengths[-1], n - start)))
                    if len(items) == CELL_ITEMS:
                        yield packed()
                        cell, items = cell + 1, []
        if items:
            yield packed()

    return rows.mapInArrow(cells, SCHEMA)


@register("op6_pack_variable_best_fit")
def op6_pack_variable_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(read(spark, sf_dir, "documents"), word_tokens(F.col("text")))
