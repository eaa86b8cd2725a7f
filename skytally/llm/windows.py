"""Packing into windows of one length by best fit decreasing.

Documents become token ids and an end id. One longer than a window is cut into full windows and a
rest, so every piece fits a window; the pieces and their ids are written once. Best fit decreasing
then places the pieces, longest first, each in the tightest window with room. The open windows are kept
in a segment tree indexed by remaining capacity, which finds the least capacity that is enough.

Which of several equally long pieces goes where changes nothing, so the search runs over the counts of
pieces by length: ``plan`` puts whole blocks of equal pieces into blocks of equally full windows and
gives exactly the windows of the piece-by-piece search. Its input has at most one row per length and
its output is bounded by the window length, so the driver's part does not grow with the table.

The pieces of a length are then numbered, and the number tells the window. Numbers follow the pieces'
content and not the files': a length is dealt by hash into cells of about ``CELL_ROWS`` rows, numbered
within cells, and cell counts are summed up. Repeated rows are counted before the shuffle and
numbered as one, so neither a frequent length nor a repeated row fills a task.

Cases: a null or empty text has only its end id; rows with equal doc_id or none are packed each; texts
of any length are cut; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import json
import re
import zlib
from array import array
from collections import deque
from collections.abc import Iterator, Mapping
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from skytally.llm.registry import read, register, ship
from skytally.session import scratch_path

WINDOW = 2048
END_ID = 1
PAD_ID = 0
CELL_ROWS = 100_000
CACHE_ENTRIES = 400_000
CHUNK_ROWS = 50_000

# Characters of Latin texts whose classes are the same in every Unicode version, as the splitter sees them.
LETTERS, DIGITS, SPACES = "A-Za-zªµºÀ-ÖØ-öø-ÿ", "0-9²³¹¼-¾", " \t\n\x0b\x0c\r\x85\xa0"
OTHER_TEXT = re.compile("[^\t\n\x0b\x0c\r -~\x85\xa0-ÿ‐-‧‰-⁞€]")
PIECES = re.compile(
    f"'s|'t|'re|'ve|'m|'ll|'d| ?[{LETTERS}]+| ?[{DIGITS}]+| ?[^{SPACES}{LETTERS}{DIGITS}]+"
    f"|[{SPACES}]+(?![^{SPACES}])|[{SPACES}]+")


def byte_symbols() -> dict[int, str]:
    """Symbol of each byte: itself if a printable Latin-1 character, else the next free one from 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in printable]
    return {b: chr(b) for b in printable} | {b: chr(256 + n) for n, b in enumerate(other)}


class ByteEncoder:
    """Ids of whole texts by a ``tokenizers`` file, as uint32 arrays.

    No id spans two pieces of a byte-level splitter, so Latin texts are split here and a new piece goes
    to the tokenizer's model as byte symbols; the ids of earlier pieces are looked up. Other texts, texts
    that hold an added token, and all texts of a tokenizer with another splitter, a normalizer or another
    kind of model are encoded whole.
    """

    def __init__(self, path: str):
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        rules = json.loads(self.tokenizer.to_str())
        splitter = rules.get("pre_tokenizer") or {}
        self.cached = (splitter.get("type") == "ByteLevel" and not splitter.get("add_prefix_space")
                       and splitter.get("use_regex", True) and not rules.get("normalizer")
                       and rules["model"]["type"] == "BPE")
        self.tokenize, self.symbols = self.tokenizer.model.tokenize, byte_symbols()
        self.added = [t["content"] for t in rules.get("added_tokens", [])]
        self.known: dict[str, bytes] = {}

    def piece(self, piece: str) -> bytes:
        symbols = piece.encode().decode("latin-1").translate(self.symbols)
        return array("I", [token.id for token in self.tokenize(symbols)]).tobytes()

    def encode(self, text: str) -> np.ndarray:
        if not self.cached or OTHER_TEXT.search(text) or any(t in text for t in self.added):
            return np.asarray(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4")
        known, pieces = self.known, PIECES.findall(text)
        for piece in set(pieces).difference(known):
            known[piece] = self.piece(piece)
        ids = np.frombuffer(b"".join(map(known.__getitem__, pieces)), "<u4")
        if len(known) > CACHE_ENTRIES:
            known.clear()
        return ids


@lru_cache(maxsize=2)
def encoder(path: str) -> ByteEncoder:
    return ByteEncoder(path)


PIECE_SCHEMA = "doc_id long, start long, length int, doc_tokens long, ids_crc32 long, ids array<int>"
KEY = ["length", "doc_id", "start", "doc_tokens", "ids_crc32"]


def _cut(path: str, window: int, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = encoder(path)
        for batch in batches:
            for at in range(0, batch.num_rows, 200):
                part = batch.slice(at, 200)
                rows, lists = [], []
                for doc, text in zip(part.column("doc_id").to_pylist(), part.column("text").to_pylist()):
                    ids = np.append(tokens.encode(text or ""), np.uint32(end_id)).astype("<u4")
                    for start in range(0, len(ids), window):
                        piece = ids[start:start + window]
                        rows.append((doc, start, len(piece), len(ids), zlib.crc32(piece.tobytes())))
                        lists.append(piece)
                doc, start, length, total, crc = zip(*rows)
                ends = np.concatenate([[0], np.cumsum(length)]).astype("int32")
                yield pa.RecordBatch.from_arrays(
                    [pa.array(doc, pa.int64()), pa.array(start, pa.int64()), pa.array(length, pa.int32()),
                     pa.array(total, pa.int64()), pa.array(crc, pa.int64()),
                     pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(lists).astype("int32")))],
                    names=["doc_id", "start", "length", "doc_tokens", "ids_crc32", "ids"])

    return run


def token_pieces(docs: DataFrame, tokenizer_path: str, window: int = WINDOW, end_id: int = END_ID,
                 key: str = "doc_id", text: str = "text") -> DataFrame:
    """A row per piece of at most ``window`` ids, with the ids, written to the shared folder."""
    spark = docs.sparkSession
    ship(spark)
    rows = docs.select(F.col(f"`{key}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    folder = scratch_path(spark, "pieces")
    rows.mapInArrow(_cut(tokenizer_path, window, end_id), PIECE_SCHEMA).write.option("compression", "zstd").parquet(folder)
    return spark.read.schema(PIECE_SCHEMA).parquet(folder)


class CapacityTree:
    """Counts of open windows by remaining capacity, summed up in a segment tree."""

    def __init__(self, window: int):
        self.leaves = 1 << window.bit_length()
        self.sums = [0] * (2 * self.leaves)

    def add(self, capacity: int, count: int) -> None:
        node = self.leaves + capacity
        while node:
            self.sums[node] += count
            node >>= 1

    def tightest(self, size: int) -> int | None:
        """The least capacity of at least ``size`` that an open window has."""
        node = self.leaves + size
        while not self.sums[node]:
            while node & 1:  # a right child: what is larger lies beyond its parent
                node >>= 1
            if not node:
                return None
            node += 1
        while node < self.leaves:
            node = 2 * node if self.sums[2 * node] else 2 * node + 1
        return node - self.leaves


def plan(counts: Mapping[int, int], window: int = WINDOW) -> list[tuple[int, int, int, int, int, int]]:
    """Blocks (length, first number, pieces, pieces per window, first window, offset) of best fit decreasing.

    A piece stays the tightest choice's guest until the window has no room for another of its length, so a
    window with room r takes r // length pieces at once, and a block of equal windows is filled in one step.
    """
    tree, rooms = CapacityTree(window), [deque() for _ in range(window + 1)]
    blocks, windows = [], 0

    def put(capacity: int, first: int, count: int) -> None:
        if capacity and count:
            rooms[capacity].append((first, count))
            tree.add(capacity, count)

    for length in sorted(counts, reverse=True):
        number, left = 0, counts[length]
        while left:
            room = tree.tightest(length)
            if room is None:
                opened = -(-left // (window // length))
                put(window, windows, opened)
                windows, room = windows + opened, window
            first, count = rooms[room].popleft()
            tree.add(room, -count)
            each = min(room // length, left)
            full = min(count, left // each)
            blocks.append((length, number, full * each, each, first, window - room))
            put(room - each * length, first, full)
            number, left = number + full * each, left - full * each
            if full < count:
                rooms[room].appendleft((first + full, count - full))
                tree.add(room, count - full)
    return blocks


PLACE_SCHEMA = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
                "sequence_id long, offset long")


def _placed(blocks: list[tuple[int, int, int, int, int, int]], with_ids: bool):
    table = np.array(sorted(blocks), "int64").reshape(-1, 6).T
    at = [pa.int64()] * 7

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        length, number, _, each, first, offset = table
        keys = np.rec.fromarrays([length, number], names="length,number")
        for batch in batches:
            copies = batch.column("copies").to_numpy()
            ends = np.cumsum(copies)
            for low in range(0, int(ends[-1]) if len(ends) else 0, CHUNK_ROWS):
                flat = np.arange(low, min(low + CHUNK_ROWS, ends[-1]))
                row = np.searchsorted(ends, flat, "right")
                mine = batch.column("number").to_numpy()[row] + flat - (ends[row] - copies[row])
                size = batch.column("length").to_numpy()[row].astype("int64")
                block = np.searchsorted(keys, np.rec.fromarrays([size, mine], names="length,number"), "right") - 1
                turn = mine - number[block]
                taken = batch.take(pa.array(row))
                columns = [taken.column("doc_id"), taken.column("start"), size, taken.column("ids_crc32"),
                           taken.column("doc_tokens"), first[block] + turn // each[block],
                           offset[block] + turn % each[block] * size]
                arrays = [pa.array(c, t) if isinstance(c, np.ndarray) else c.cast(t) for c, t in zip(columns, at)]
                names = [c.split()[0] for c in PLACE_SCHEMA.split(", ")]
                if with_ids:
                    arrays, names = [*arrays, taken.column("ids")], [*names, "ids"]
                yield pa.RecordBatch.from_arrays(arrays, names=names)

    return run


def place_pieces(pieces: DataFrame, window: int = WINDOW, with_ids: bool = False) -> DataFrame:
    """Each piece with its window (``sequence_id``) and ``offset``; with its ids if wanted."""
    spark = pieces.sparkSession
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    blocks = plan(counts, window)
    key = [*KEY, "ids"] if with_ids else KEY
    # One row per length, at most ``window``.
    cells = spark.createDataFrame([(n, 1 + c // CELL_ROWS) for n, c in counts.items()], "length int, cells long")
    rows = (pieces.groupBy(*key).agg(F.count("*").alias("copies")).join(F.broadcast(cells), "length")
            .withColumn("cell", F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), "cells")).drop("cells"))
    before = Window.partitionBy("length").orderBy("cell").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    starts = (rows.groupBy("length", "cell").agg(F.sum("copies").alias("n"))
              .select("length", "cell", (F.sum("n").over(before) - F.col("n")).alias("first")))
    within = (Window.partitionBy("length", "cell").orderBy(*[c for c in key if c != "length"])
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    numbered = (rows.withColumn("upto", F.sum("copies").over(within)).join(starts, ["length", "cell"])
                .select(*key, "copies", (F.col("first") + F.col("upto") - F.col("copies")).alias("number")))
    return numbered.mapInArrow(_placed(blocks, with_ids), PLACE_SCHEMA + (", ids array<int>" if with_ids else ""))


def packed_sequences(places: DataFrame, window: int = WINDOW, pad_id: int = PAD_ID) -> DataFrame:
    """sequence_id, n_tokens, ids: the pieces' ids in order, padded to the window unless a power of two long."""
    held = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    ids, used = F.flatten(F.transform("held", lambda p: p["ids"])), F.size("ids")
    missing = F.when(F.bit_count(used) == 1, 0).otherwise(F.lit(window) - used)
    return (places.groupBy("sequence_id").agg(held.alias("held")).select("sequence_id", ids.alias("ids"))
            .select("sequence_id", used.alias("n_tokens"),
                    F.concat("ids", F.array_repeat(F.lit(pad_id), missing)).alias("ids")))


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@register("op11_pack_best_fit")
def op11_pack_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return place_pieces(token_pieces(read(spark, sf_dir, "documents"), default_tokenizer()))
