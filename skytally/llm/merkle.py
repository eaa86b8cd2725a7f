"""Document fingerprints: a Merkle tree over pieces, paragraphs and sections of a text.

A paragraph is a line with its line end. Its leaves are pieces of at least ``PIECE_MIN`` characters
that end at a mark (or after ``PIECE_MAX``), so an edit changes only the pieces it touches. A section
is a run of paragraphs closed by one whose hash is divisible by ``SECTION_EVERY``. Every node hashes
its children, leaves hash their text; the pieces are the whole text, so equal roots mean equal texts
and equal texts have equal fingerprints.

A fingerprint is ``root;section:leaf,leaf,...;section:...`` in hex. Likeness of two fingerprints
descends only into differing branches: 1 for equal roots; sections with equal hashes match whole; the
leaves of the other sections match as multisets; twice the matches over both leaf counts.

``fingerprint_with_edits`` also compares each document with an edited copy and with the next document
in falling order of doc_id (after the last: the first). Rows are range-partitioned by doc_id and
sorted; a task streams its range with one document of look-back. The first and last document of each
range are written besides its results, and the few (last, next first) pairs are joined afterwards.

Cases: a null text counts as empty; the empty text has a root and no leaves, and is like another
empty text only; rows of equal doc_id follow in order of their text; a table of one row is its own
next document; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from hashlib import blake2b, sha256

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from skytally.llm.registry import read, register, ship
from skytally.session import scratch_path

PIECE_MIN, PIECE_MAX = 32, 400
SECTION_EVERY = 4
LEAF_BYTES, SECTION_BYTES, ROOT_BYTES = 4, 8, 16

PARAGRAPH = re.compile("[^\n]*\n|[^\n]+")
PIECE = re.compile(rf"[\s\S]{{{PIECE_MIN},{PIECE_MAX}}}?(?:[.!?;,|]\s+|\Z)|[\s\S]{{1,{PIECE_MAX}}}")

RESULT = ("n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
          "near_edited double, near_next double")


def _hash(data: bytes, size: int) -> bytes:
    return blake2b(data, digest_size=size).digest()


def fingerprint(text: str) -> str:
    sections: list[str] = []
    nodes: list[bytes] = []
    leaves: list[str] = []
    paragraphs: list[bytes] = []

    def close() -> None:
        node = _hash(b"".join(paragraphs), ROOT_BYTES)
        nodes.append(node)
        sections.append(f"{node[:SECTION_BYTES].hex()}:{','.join(leaves)}")
        leaves.clear()
        paragraphs.clear()

    for paragraph in PARAGRAPH.findall(text):
        hashes = [_hash(piece.encode("utf-8", "surrogatepass"), ROOT_BYTES) for piece in PIECE.findall(paragraph)]
        leaves.extend([h[:LEAF_BYTES].hex() for h in hashes])
        paragraphs.append(_hash(b"".join(hashes), ROOT_BYTES))
        if paragraphs[-1][0] % SECTION_EVERY == 0:
            close()
    if paragraphs:
        close()
    return ";".join([_hash(b"".join(nodes), ROOT_BYTES).hex(), *sections])


def likeness(a: str, b: str) -> float:
    """Share of leaves that two fingerprints have in common, 0 to 1."""
    if a == b:
        return 1.0
    left, right = a.split(";")[1:], b.split(";")[1:]
    if not left or not right:
        return 0.0
    size = lambda sections: sum(s.count(",") + 1 for s in sections)
    same = Counter(left) & Counter(right)
    matched = size(same.elements())
    rest = [Counter() for _ in range(2)]
    for counts, sections in zip(rest, (left, right)):
        for section in (Counter(sections) - same).elements():
            counts.update(section.partition(":")[2].split(","))
    matched += (rest[0] & rest[1]).total()
    return 2 * matched / (size(left) + size(right))


def edited_text(text: str, following: str) -> str:
    """``text`` with its last third replaced by as much of the start of ``following``."""
    third = len(text) // 3
    return text[:len(text) - third] + following[:third]


def _compared(text: str, print_: str, following: str, next_print: str) -> tuple:
    edited = edited_text(text, following)
    edited_print = fingerprint(edited)
    return (len(text), sha256(edited.encode()).hexdigest(), print_, edited_print,
            likeness(print_, edited_print), likeness(print_, next_print))


STREAM = pa.schema([
    ("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()),
    ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()),
    ("near_next", pa.float64()), ("edge", pa.string()), ("text", pa.string())])


def _stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Results of all documents but the last; then the first and the last, with texts."""
    held = None
    ends: list[tuple] = []
    edge = lambda name: (held[0], None, None, None, None, None, None, name, held[1])
    for batch in batches:
        for at in range(0, batch.num_rows, 500):
            part, rows = batch.slice(at, 500), []
            for doc, text in zip(part.column("doc_id").to_pylist(), part.column("text").to_pylist()):
                current = (doc, text, fingerprint(text))
                if held is None:
                    held = current
                    ends.append(edge("first"))
                else:
                    rows.append((held[0], *_compared(held[1], held[2], text, current[2]), None, None))
                    held = current
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, f.type) for c, f in zip(zip(*rows), STREAM)], schema=STREAM)
    if held is not None:
        ends.append(edge("last"))
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, f.type) for c, f in zip(zip(*ends), STREAM)], schema=STREAM)


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            found = _compared(row["text"], fingerprint(row["text"]), row["following"], fingerprint(row["following"]))
            yield pa.RecordBatch.from_arrays(
                [pa.array([v], f.type) for v, f in zip((row["doc_id"], *found), STREAM)],
                schema=pa.schema(list(STREAM)[:7]))


def fingerprint_with_edits(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next."""
    spark = docs.sparkSession
    ship(spark)
    order = F.col("doc_id").desc_nulls_last()
    rows = docs.select(F.col(f"`{key}`").cast("long").alias("doc_id"),
                       F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    folder = scratch_path(spark, "fingerprints")
    (rows.repartitionByRange(order).sortWithinPartitions(order, "text")
     .mapInArrow(_stream, f"doc_id long, {RESULT}, edge string, text string")
     .withColumn("range", F.spark_partition_id())
     .write.option("compression", "zstd").parquet(folder))
    stored = spark.read.schema(f"doc_id long, {RESULT}, edge string, text string, range int").parquet(folder)
    first = stored.filter("edge = 'first'").select(F.col("range"), "doc_id", "text")
    last = stored.filter("edge = 'last'").select("range", "doc_id", "text")
    # Ranges in order, one row each; the last is followed by the first.
    spot = F.row_number().over(Window.orderBy(order, "range"))
    spots = first.select("range", spot.alias("spot"))
    count = F.count("*").over(Window.partitionBy())
    follows = spots.select("spot", F.col("range").alias("next_range"))
    turned = spots.select("range", (F.col("spot") % count + 1).alias("spot")).join(follows, "spot")
    pairs = (last.join(turned, "range")
             .join(first.select(F.col("range").alias("next_range"), F.col("text").alias("following")), "next_range")
             .select("doc_id", "text", "following")
             .mapInArrow(_pairs, f"doc_id long, {RESULT}"))
    return stored.filter("edge is null").drop("edge", "text", "range").unionByName(pairs)


@register("op10_merkle_fingerprints")
def op10_merkle_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint_with_edits(read(spark, sf_dir, "documents"))
