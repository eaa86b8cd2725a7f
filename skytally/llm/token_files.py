"""Token-id files: Parquet list columns that can be read selectively.

Documents are tokenised, an end id is appended, and rows go in ascending doc_id order into Parquet
files: range partitions of the id, sorted, each written as files of at most ``ROWS_PER_FILE`` rows
with row groups of ``ROW_GROUP_BYTES`` and pages of ``PAGE_BYTES``. Ids are dictionary-encoded while
a column chunk's dictionary fits in ``DICTIONARY_BYTES``; integer columns beyond that, and doc_id and
n_tokens, are delta-encoded (format version 2). Row groups carry min/max statistics and page
indexes, so a read of some doc_ids, or of the metadata columns alone, touches only their pages.

Tokenising caches the ids of words: the tokenizer drops white space, so no id spans it, and its
splitter never joins letters to other characters but after an apostrophe. Texts with special tokens,
or with characters whose lower case or normal form is not one for one, are cut at white space only
and their words encoded whole. So ids are those of the whole text; tests compare them.

Cases: a null or empty text has only the end id; rows with equal doc_id are kept, in the order of
their ids; an empty table gives an empty result and folder; other columns are not read.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from skytally.llm.registry import read, register, ship
from skytally.session import scratch_path

ROWS_PER_FILE = 500_000
ROW_GROUP_BYTES = 32 << 20
PAGE_BYTES = 256 << 10
DICTIONARY_BYTES = 1 << 20
END_ID = 2
CACHE_ENTRIES = 400_000

# Characters whose lower case and normal form are one for one, without letters that are no a-z or à-ÿ.
PLAIN = re.compile(r"[^\t\n\r -~¡-©«¬®-´¶-¹»-ÿ]")
PIECE = re.compile("[a-zß-öø-ÿ]+|[^a-zß-öø-ÿ]+")
SPACED = re.compile("[^ \t\n\r]+")


def byte_symbols() -> dict[int, str]:
    """Byte-level symbols of the letters ß to ÿ: a UTF-8 byte that is no printable Latin-1 character
    is written as the next free character from 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in printable]
    symbol = {b: chr(b) for b in printable} | {b: chr(256 + n) for n, b in enumerate(other)}
    return {c: "".join(symbol[b] for b in chr(c).encode()) for c in range(0xDF, 0x100)}


class PieceEncoder:
    """Ids of whole texts by a ``tokenizers`` file, as uint32 arrays.

    Words are cut at white space. A word seen before is looked up; a new one of plain letters and
    marks is cut into runs of either, and runs of letters go to the tokenizer's model directly.
    """

    def __init__(self, path: str):
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenize = self.tokenizer.model.tokenize
        self.symbols = byte_symbols()
        self.words: dict[str, bytes] = {}
        self.runs: dict[str, bytes] = {}

    def whole(self, text: str) -> bytes:
        return np.asarray(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def run(self, run: str) -> bytes:
        if not run.isalpha():
            return self.whole(run)
        return array("I", [t.id for t in self.tokenize(run.translate(self.symbols))]).tobytes()

    def word(self, word: str) -> bytes:
        if "'" in word:
            return self.whole(word)
        runs, cut = self.runs, PIECE.findall(word)
        for run in cut:
            if run not in runs:
                runs[run] = self.run(run)
        return b"".join([runs[run] for run in cut])

    def encode(self, text: str) -> np.ndarray:
        if "<|" in text or PLAIN.search(text):
            return np.frombuffer(b"".join(map(self.whole, SPACED.findall(text))), "<u4")
        known, words = self.words, text.lower().split()
        for word in set(words).difference(known):
            known[word] = self.word(word)
        ids = np.frombuffer(b"".join(map(known.__getitem__, words)), "<u4")
        for cache in (self.words, self.runs):
            if len(cache) > CACHE_ENTRIES:
                cache.clear()
        return ids


@lru_cache(maxsize=2)
def encoder(path: str) -> PieceEncoder:
    return PieceEncoder(path)


def _tokenise(path: str, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 200):
                part = batch.slice(at, 200)
                texts = [t or "" for t in part.column("text").to_pylist()]
                lists = [np.append(encoder(path).encode(t), np.uint32(end_id)) for t in texts]
                lengths = np.array([len(ids) for ids in lists], "int32")
                offsets = np.concatenate([[0], np.cumsum(lengths)]).astype("int32")
                flat = np.concatenate(lists).astype("int32") if lists else np.empty(0, "int32")
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(lengths), pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))],
                    names=["doc_id", "n_tokens", "ids"])

    return run


def write_token_files(docs: DataFrame, folder: str, tokenizer_path: str, end_id: int = END_ID,
                      key: str = "doc_id", text: str = "text") -> None:
    """Write doc_id, n_tokens and ids of every document, ascending by doc_id, as Parquet files."""
    ship(docs.sparkSession)
    rows = docs.select(F.col(f"`{key}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    # Spark sorts by the raw id list only among rows of one doc_id.
    (rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
     .mapInArrow(_tokenise(tokenizer_path, end_id), "doc_id long, n_tokens int, ids array<int>")
     .write.option("maxRecordsPerFile", ROWS_PER_FILE)
     .option("parquet.block.size", ROW_GROUP_BYTES)
     .option("parquet.page.size", PAGE_BYTES)
     .option("parquet.writer.version", "PARQUET_2_0")
     .option("parquet.enable.dictionary#doc_id", "false")
     .option("parquet.enable.dictionary#n_tokens", "false")
     .option("parquet.dictionary.page.size", DICTIONARY_BYTES)
     .option("compression", "zstd")
     .parquet(folder))


def read_token_files(spark: SparkSession, folder: str, *columns: str) -> DataFrame:
    """The files' rows; name the columns needed (doc_id, n_tokens, ids)."""
    rows = spark.read.schema("doc_id long, n_tokens int, ids array<int>").parquet(folder)
    return rows.select(*columns) if columns else rows


def token_starts(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 per document; ``start`` counts all ids before it.

    Files are ordered by their least doc_id, then by name (a range never spans two partitions). Each
    file is summed once, the few sums are added up over the files, then over the rows of each file.
    """
    @F.pandas_udf("long")
    def crc(ids):
        return ids.map(lambda x: zlib.crc32(np.asarray(x, "<u4").tobytes()))

    rows = read_token_files(spark, folder).select(
        "doc_id", F.col("n_tokens").cast("long").alias("n_tokens"),
        F.col("_metadata.file_name").alias("file"), F.col("_metadata.row_index").alias("row"),
        crc("ids").alias("ids_crc32"))
    sums = read_token_files(spark, folder).groupBy(F.col("_metadata.file_name").alias("file")).agg(
        F.min("doc_id").alias("least"), F.sum("n_tokens").alias("n"))
    order = Window.orderBy("least", "file").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sums = sums.select("file", (F.sum("n").over(order) - F.col("n")).alias("before"))
    within = Window.partitionBy("file").orderBy("row").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (rows.withColumn("start", F.sum("n_tokens").over(within) - F.col("n_tokens"))
            .join(sums, "file").select("doc_id", (F.col("start") + F.col("before")).alias("start"),
                                       "n_tokens", "ids_crc32"))


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@register("op3_token_parquet")
def op3_token_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_path(spark, "tokens")
    write_token_files(read(spark, sf_dir, "documents"), folder, default_tokenizer())
    return token_starts(spark, folder)
