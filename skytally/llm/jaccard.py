"""N-gram Jaccard join by a token-group matrix, and the classes of near duplicates it links.

A document is the set of its five-word shingles (64-bit hashes). Two documents link when
``100 * |A ∩ B| >= 75 * |A ∪ B|``. The join works on distinct sets, known by a 64-bit digest, so
exact copies are one set however many rows they are.

1. A pass over all texts gives each document's digest and size, and counts the shingles met at least
   ``CHUNK_COPIES`` times in a chunk of texts. Those with high sums go into a bitmap of fixed size.
2. Linked sets share a shingle among the first ``n - ceil(3n/4) + 1`` of each in any common order of
   shingles. Here the order is: not in the bitmap first, then by hash; shared passages and licence
   lines come last and rarely enter the prefix. Prefixes are dealt by shingle, those in the bitmap
   salted by digest, sorted, and streamed; only shingles shared by several sets are kept.
   A pair is taken up only if sizes and ranks of the shingle allow the overlap a link needs.
3. Every set is compared with the first set of its bucket, then with at most ``PIVOTS`` sets of other
   components, drawn one from each of its buckets, again while such a round joins many sets. So a group of
   variants is one component before step 4, and its sets do not all meet each other there. These rounds compare
   by the shingles' low 16 bits; the pairs left are compared exactly. The links give components, and these are cut into groups of at most about ``GROUP_SETS`` sets: similar documents.
4. The token-group matrix: a group is stored with the union of its sets. A set meets the groups of
   other components with which it shares a prefix shingle; as ``|A ∩ B| <= |A ∩ union|``, a group is
   opened, and its members compared, only if the set has ``ceil(3n/4)`` shingles in the union.
   Unions use the shingles' low 16 bits, which can only overstate an overlap; an opened group and its
   sets are compared by one product of set-by-shingle matrices. Classes need no more than these links.
5. For the links themselves the pairs within the components of step 3 are compared too: a component is
   cut into blocks, each pair of blocks is one such product, and every set gets the rows it links to. The products give sums, so a group of many variants makes no row per pair;
   ``set_links`` gives the pairs where they are wanted.
6. All links give the components of the result.

No step holds a bucket or a component in one task, and nothing but the bitmap (fixed size) and counts
reaches the driver. Intermediate tables go to the shared folder.

``n_links`` of a row counts the other rows it links to, exact copies included.

Cases: rows may lack a doc_id or share one, as a row is known by doc_id and text; a class without any
doc_id has no component_id; a text with fewer than five words is one shingle of them all; without words or null it has an
empty set and is its own component; repeated rows fall in one class; rows with equal doc_id keep their
own rows; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from hashlib import blake2b
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skytally.llm.components import connected_components
from skytally.llm.registry import read, register, ship
from skytally.session import cut_lineage

SHINGLE = 5
CHUNK_SHINGLES = 2_000_000
CHUNK_COPIES, HOT_COPIES = 2, 6
BITMAP_BITS = 24
HOT_SHINGLES = 1 << 20
SALTS = 16
GROUP_SETS = 128
LONG_BUCKET = 1000
PIVOT_ROUNDS, PIVOTS = 3, 8
BLOCK_SETS, BLOCK_SHINGLES = 256, 200_000
MATRIX_CELLS = 2_000_000

_MULTIPLIERS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93,
                         0xA0761D6478BD642F], "u8")


def shingles(text: str | None) -> np.ndarray:
    """Sorted distinct shingle hashes of a text, letters A-Z in lower case."""
    import xxhash

    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.empty(0, "u8")
    if len(words) < SHINGLE:
        return np.array([xxhash.xxh64_intdigest(b" ".join(words), 1)], "u8")
    h = np.array(list(map(xxhash.xxh64_intdigest, words)), "u8")
    size = len(h) - SHINGLE + 1
    mixed = h[:size] * _MULTIPLIERS[0]
    for k in range(1, SHINGLE):
        mixed += h[k:k + size] * _MULTIPLIERS[k]
    mixed ^= mixed >> np.uint64(29)
    mixed *= np.uint64(0xBF58476D1CE4E5B9)
    mixed ^= mixed >> np.uint64(32)
    return np.unique(mixed)


def digest(tokens: np.ndarray) -> int:
    return int.from_bytes(blake2b(tokens.tobytes(), digest_size=8).digest(), "little", signed=True)


def prefix_length(n: int) -> int:
    return n - (3 * n + 3) // 4 + 1


def in_bitmap(bitmap: np.ndarray, values: np.ndarray) -> np.ndarray:
    at = (values.astype("u8") & np.uint64((1 << BITMAP_BITS) - 1)).astype("i8")
    return (bitmap[at >> 6] >> (at & 63).astype("u8")) & np.uint64(1) == 1


def bitmap_of(values: DataFrame, column: str) -> np.ndarray:
    """A bit for the low BITMAP_BITS bits of each value: 2^(BITMAP_BITS - 3) bytes, whatever the input."""
    place = F.col(column).bitwiseAND(F.lit((1 << BITMAP_BITS) - 1))
    words = (values.select(F.shiftright(place, 6).alias("word"),
                           F.expr(f"shiftleft(1L, cast({column} & 63 as int))").alias("bit"))
             .groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow())
    bitmap = np.zeros(1 << (BITMAP_BITS - 6), "u8")
    bitmap[words.column("word").to_numpy()] = words.column("bits").to_numpy().astype("i8").view("u8")
    return bitmap


def _batch(schema: str, columns: list) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
    fields = [c.split() for c in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[k]) for c, (_, k) in zip(columns, fields)],
                                      names=[name for name, _ in fields])


PROFILE = "doc_id long, row long, digest long, n int, token long, copies int"


def _profile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """doc_id, row, digest, n of each document; token, copies of shingles frequent in a chunk."""
    seen: set[int] = set()
    held: list[np.ndarray] = []
    size = 0

    def frequent() -> pa.RecordBatch:
        tokens, counts = np.unique(np.concatenate(held), return_counts=True) if held else (np.empty(0, "u8"),) * 2
        pick = counts >= CHUNK_COPIES
        none = pa.nulls(int(pick.sum()), pa.int64())
        return _batch(PROFILE, [none, none, none, none.cast(pa.int32()), tokens[pick].view("i8"), counts[pick].astype("i4")])

    for batch in batches:
        rows = []
        for doc, row, text in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "row", "text"))):
            tokens = shingles(text)
            key = digest(tokens) if len(tokens) else None
            rows.append((doc, row, key, len(tokens)))
            if key is not None and key not in seen:
                seen.add(key)
                held.append(tokens)
                size += len(tokens)
        if rows:
            none = pa.nulls(len(rows), pa.int64())
            yield _batch(PROFILE, [*map(list, zip(*rows)), none, none.cast(pa.int32())])
        if size >= CHUNK_SHINGLES:
            yield frequent()
            seen, held, size = set(), [], 0
    yield frequent()


def _frequent_bitmap(profile: DataFrame) -> np.ndarray:
    """Bits of the most frequent shingles, at most about ``HOT_SHINGLES`` of them."""
    sums = cut_lineage(profile.filter("token is not null").groupBy("token").agg(
        F.sum("copies").alias("copies")).filter(F.col("copies") >= HOT_COPIES))
    # Counts by power of two: a few dozen rows.
    steps = sums.groupBy(F.floor(F.log2("copies")).alias("step")).count().collect()
    least, total = 63, 0
    for row in sorted(steps, key=lambda r: -r["step"]):
        if total + row["count"] > HOT_SHINGLES and total:
            break
        total, least = total + row["count"], row["step"]
    return bitmap_of(sums.filter(F.floor(F.log2("copies")) >= least), "token")


PREFIX = "bucket long, digest long, place long"  # place: size, rank and whether the bucket is salted
RANK_BITS = 31


def salted_bucket(tokens: np.ndarray, key) -> np.ndarray:
    return (tokens + (1 + key % SALTS)) * _MULTIPLIERS[1]


def unsalted(buckets: np.ndarray, keys: np.ndarray) -> np.ndarray:
    inverse = np.uint64(pow(int(_MULTIPLIERS[1]), -1, 1 << 64))
    return buckets * inverse - (1 + keys % SALTS).astype("u8")


def unpacked(batch: pa.RecordBatch) -> np.ndarray:
    """Rows token, bucket, digest, n, rank of a PREFIX batch."""
    bucket, key, place = (batch.column(c).to_numpy() for c in range(3))
    n, rank = np.abs(place) >> RANK_BITS, np.abs(place) & ((1 << RANK_BITS) - 1)
    token = np.where(place < 0, unsalted(bucket.view("u8"), key).view("i8"), bucket)
    return np.vstack([token, bucket, key, n, rank])


def _prefixes(bitmap: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen: set[int] = set()
            out: list[list[np.ndarray]] = []
            for text in batch.column("text").to_pylist():
                tokens = shingles(text)
                if not len(tokens):
                    continue
                key = digest(tokens)
                if key in seen:
                    continue
                seen.add(key)
                hot = in_bitmap(bitmap, tokens)
                size = prefix_length(len(tokens))
                rare = tokens[~hot][:size]
                rest = tokens[hot][:size - len(rare)]
                # A frequent shingle's bucket is dealt over SALTS tasks by the sets' digests.
                place = (len(tokens) << RANK_BITS) + np.arange(len(rare) + len(rest), dtype="i8")
                place[len(rare):] *= -1
                out.append([np.concatenate([rare, salted_bucket(rest, np.uint64(key % SALTS))]),
                            np.full(len(place), key, "i8"), place])
            if out:
                bucket, key, place = (np.concatenate(c) for c in zip(*out))
                yield _batch(PREFIX, [bucket.view("i8"), key, place])
    return run


SHARED = "token long, digest long, n int, rank int, first long, first_n int, first_rank int"


def compatible(n, rank, other_n, other_rank):
    """Whether sets of these sizes can link when their first common shingle has these ranks.

    The shingles from there on bound the overlap, which a link needs to be 3/7 of both sizes.
    """
    least = np.minimum(n - rank, other_n - other_rank)
    return (3 * n <= 4 * other_n) & (3 * other_n <= 4 * n) & (7 * least >= 3 * (n + other_n))


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by bucket and digest, those that a row of their shingle can link to, with the
    bucket's first row.

    Rows of salted buckets and of buckets above LONG_BUCKET rows are all kept: the shingle has other
    buckets, or the rows stream through without being held.
    """
    def run(rows: np.ndarray, first: np.ndarray | None) -> np.ndarray:
        """Columns of a bucket's rows to give out; ``first`` is set for all but a long bucket's start."""
        keep = rows
        if first is None:
            first = rows[:, 0]
            if rows[0, 0] == rows[1, 0]:  # not salted
                n, rank = rows[3], rows[4]
                fits = compatible(n[:, None], rank[:, None], n[None], rank[None])
                np.fill_diagonal(fits, False)
                keep = rows[:, fits.any(0)]
        return np.vstack([keep[0], keep[2:5], np.repeat(first[2:5, None], keep.shape[1], 1)])

    held, long = np.empty((5, 0), "i8"), None  # long: first row of a bucket that is given out already
    for batch in batches:
        rows = np.hstack([held, unpacked(batch)])
        fresh = np.ones(rows.shape[1], bool)
        fresh[1:] = (rows[1, 1:] != rows[1, :-1]) | (rows[2, 1:] != rows[2, :-1])
        rows = rows[:, fresh]  # a set once per bucket
        cuts = np.flatnonzero(np.diff(rows[1])) + 1
        edges = [0, *cuts.tolist(), rows.shape[1]]
        out = []
        for a, b in zip(edges[:-2], edges[1:-1]):
            same = long is not None and rows[1, a] == long[1]
            if same or b - a > 1 or rows[0, a] != rows[1, a]:
                out.append(run(rows[:, a:b], long if same else None))
        held = rows[:, edges[-2]:]
        if held.shape[1] > LONG_BUCKET:
            if long is None or held[1, 0] != long[1]:
                long = held[:, 0].copy()
            out.append(run(held[:, :-1], long))
            held = held[:, -1:]  # kept to know the next row of the same set
        if out:
            yield _batch(SHARED, list(np.hstack(out)))
    if held.shape[1]:
        same = long is not None and held[1, 0] == long[1]
        if same or held.shape[1] > 1 or held[0, 0] != held[1, 0]:
            yield _batch(SHARED, list(run(held, long if same else None)))


SETS = "digest long, n int, tokens binary, brief binary"


def brief(tokens: np.ndarray) -> np.ndarray:
    """The shingles' low 16 bits, sorted, repeats kept: their overlap is at least the sets'."""
    return np.sort(tokens.astype("u2"))


def common(a: np.ndarray, b: np.ndarray) -> int:
    """Overlap of two sorted arrays with repeats."""
    both = np.concatenate([a, b])
    if len(np.unique(a)) == len(a) and len(np.unique(b)) == len(b):
        both.sort()
        return int((both[1:] == both[:-1]).sum())
    (x, m), (y, n) = (np.unique(c, return_counts=True) for c in (a, b))
    _, i, j = np.intersect1d(x, y, assume_unique=True, return_indices=True)
    return int(np.minimum(m[i], n[j]).sum())


def _sets(wanted: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Sets of the rows whose key is in the bitmap, each once a task."""
        seen: set[int] = set()
        for batch in batches:
            picked = np.flatnonzero(in_bitmap(wanted, batch.column("row").to_numpy()))
            texts = batch.column("text").take(pa.array(picked))
            for at in range(0, len(texts), 500):
                found = {digest(t): t for t in map(shingles, texts.slice(at, 500).to_pylist()) if len(t)}
                found = {k: t for k, t in found.items() if k not in seen}
                seen.update(found)
                if found:
                    yield _batch(SETS, [list(found), [len(t) for t in found.values()],
                                        [t.tobytes() for t in found.values()], [brief(t).tobytes() for t in found.values()]])
    return run


def _compatible(n: str, rank: str, other_n: str, other_rank: str):
    n, rank, other_n, other_rank = map(F.col, (n, rank, other_n, other_rank))
    return ((3 * n <= 4 * other_n) & (3 * other_n <= 4 * n)
            & (7 * F.least(n - rank, other_n - other_rank) >= 3 * (n + other_n)))


def _compared(kind: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The pairs whose overlap, or the bound the brief forms give, is enough for a link."""
        for batch in batches:
            u, v, left, right = (batch.column(c) for c in range(4))
            hits = []
            for x, y in zip(left, right):
                a, b = np.frombuffer(x.as_buffer(), kind), np.frombuffer(y.as_buffer(), kind)
                both = common(a, b)
                hits.append(100 * both >= 75 * (len(a) + len(b) - both))
            mask = pa.array(hits, pa.bool_())
            yield pa.RecordBatch.from_arrays([c.filter(mask) for c in (u, v)], names=["u", "v"])
    return run


def _pass(pairs: DataFrame, sets: DataFrame, column: str, kind: str) -> DataFrame:
    side = lambda c: sets.select(F.col("digest").alias(c), F.col(column).alias(f"{c}_set"))
    return (pairs.join(side("v"), "v").join(side("u"), "u").select("u", "v", "u_set", "v_set")
            .mapInArrow(_compared(kind), "u long, v long"))


def _only(sets: DataFrame, digests: DataFrame, column: str = "tokens") -> DataFrame:
    """digest and tokens (or brief) of the sets named, and a few more: by a bitmap, as whole sets are too much to shuffle for that."""
    bitmap = bitmap_of(digests, "digest")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(in_bitmap(bitmap, batch.column("digest").to_numpy())))

    return sets.select("digest", column).mapInArrow(run, f"digest long, {column} binary")


def _unions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Unions of runs of rows sorted by group, in brief form."""
    held, group = np.empty(0, "u2"), None
    for batch in batches:
        done = []
        for g, form in zip(batch.column("group").to_pylist(), batch.column("brief")):
            if g != group:
                if group is not None:
                    done.append((group, held.tobytes()))
                held, group = np.empty(0, "u2"), g
            held = np.union1d(held, np.frombuffer(form.as_buffer(), "u2"))
        if done:
            yield _batch("group long, union binary", list(zip(*done)))
    if group is not None:
        yield _batch("group long, union binary", [[group], [held.tobytes()]])


BOUNDED = "u long, n int, group long"


def _bounded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(set, group) rows in which enough of the set is in the group's union for a link."""
    for batch in batches:
        fits = []
        for form, union in zip(batch.column("brief"), batch.column("union")):
            a, b = np.frombuffer(form.as_buffer(), "u2"), np.frombuffer(union.as_buffer(), "u2")
            at = np.searchsorted(b, a)
            both = int((b[np.minimum(at, len(b) - 1)] == a).sum())
            fits.append(both >= (3 * len(a) + 3) // 4)
        mask = pa.array(fits, pa.bool_())
        yield pa.RecordBatch.from_arrays([batch.column(c).filter(mask) for c in ("u", "n", "group")],
                                         names=["u", "n", "group"])


CELL = "root long, low int, high int, part int, digest long, copies long, tokens binary"


def linked(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Matrix of which sets of ``left`` link to which of ``right``: overlaps by matrix products over the shingles."""
    sizes = [np.array([len(t) for t in side]) for side in (left, right)]
    tokens = np.concatenate([*left, *right])
    owner = np.repeat(np.arange(len(left) + len(right)), np.concatenate(sizes))
    _, code = np.unique(tokens, return_inverse=True)
    order = np.argsort(code, kind="stable")
    owner, code = owner[order], code[order]
    overlap = np.zeros((len(left), len(right)), "f4")  # exact below 2^24 shingles
    width = max(1, MATRIX_CELLS // (len(left) + len(right)))
    for start in range(0, int(code[-1]) + 1, width):
        a, b = np.searchsorted(code, [start, start + width])
        held = np.zeros((len(left) + len(right), min(width, int(code[-1]) + 1 - start)), "f4")
        held[owner[a:b], code[a:b] - start] = 1
        overlap += held[:len(left)] @ held[len(left):].T
    both = overlap.astype("i8")
    return 100 * both >= 75 * (sizes[0][:, None] + sizes[1][None] - both)


def _cells(result: str, found: Callable[[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, bool], list]):
    """``found`` of each run of CELL rows: a component's pair of blocks."""
    def compared(held: dict, low: int, high: int) -> list:
        sides = [[k for k, (part, _, _) in held.items() if part == p] for p in (low, high)]
        if not all(sides):
            return [np.empty(0, "i8") for _ in result.split(", ")]
        hits = linked(*([held[k][2] for k in side] for side in sides))
        if low == high:
            np.fill_diagonal(hits, False)
        keys, copies = ([np.array([f(k) for k in side], "i8") for side in sides]
                        for f in (lambda k: k, lambda k: held[k][1]))
        return found(hits, *keys, *copies, low == high)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, held = None, {}
        for batch in batches:
            out = []
            names = ("root", "low", "high", "part", "digest", "copies")
            for root, low, high, part, key, copies, tokens in zip(
                    *(batch.column(c).to_pylist() for c in names), batch.column("tokens")):
                if (root, low, high) != cell:
                    if held:
                        out.append(compared(held, *cell[1:]))
                    cell, held = (root, low, high), {}
                held[key] = (part, copies, np.frombuffer(tokens.as_buffer(), "u8"))
            if out:
                yield _batch(result, [np.concatenate(c) for c in zip(*out)])
        if held:
            yield _batch(result, compared(held, *cell[1:]))
    return run


SUMS = "digest long, links long, peer long"


def _sums(hits, left, right, left_copies, right_copies, same) -> list:
    """Rows linked to by each set that has links, and one of the sets it links to."""
    out = [left, hits @ right_copies, right[hits.argmax(1)]]
    if not same:
        out = [np.concatenate(c) for c in zip(out, [right, left_copies @ hits, left[hits.argmax(0)]])]
    return [c[out[1] > 0] for c in out]


def _pairs(hits, left, right, left_copies, right_copies, same) -> list:
    i, j = np.nonzero(np.triu(hits) if same else hits)
    return [np.minimum(left[i], right[j]), np.maximum(left[i], right[j])]


class Join(NamedTuple):
    known: DataFrame  # doc_id, row, digest, n of each row
    links: DataFrame  # u, v: between the first sets of buckets and others
    inside: DataFrame  # CELL rows: the components of ``links``, by pairs of blocks
    across: DataFrame  # CELL rows: groups, and the sets of other components they were opened for


def _celled(rows: DataFrame, known: DataFrame, sets: DataFrame) -> DataFrame:
    """CELL rows, sorted by cell, of root, low, high, part, digest rows."""
    copies = known.groupBy("digest").agg(F.count("*").alias("copies"))
    return (rows.join(copies, "digest").join(_only(sets, rows), "digest")
            .select("root", "low", "high", "part", "digest", "copies", "tokens")
            .repartition("root", "low", "high").sortWithinPartitions("root", "low", "high"))


def _inside(member: DataFrame) -> DataFrame:
    inside = member.filter("linked")
    parts = inside.groupBy("root").agg(F.ceil(F.greatest(
        F.count("*") / BLOCK_SETS, F.sum("n") / BLOCK_SHINGLES)).cast("int").alias("parts"))
    return (inside.select("digest", "root").join(parts, "root")
            .withColumn("part", F.pmod(F.xxhash64("digest"), F.col("parts")).cast("int"))
            .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
            .select("root", F.least("part", "other").alias("low"), F.greatest("part", "other").alias("high"),
                    "part", "digest"))


def _across(opened: DataFrame, member: DataFrame) -> DataFrame:
    """A group's sets are part -1 - k, the k-th share of the sets it was opened for part k."""
    shares = opened.groupBy("group").agg(F.ceil(F.greatest(
        F.count("*") / BLOCK_SETS, F.sum("n") / BLOCK_SHINGLES)).cast("int").alias("shares"))
    ends = [F.col("group").alias("root"), (-1 - F.col("k")).alias("low"), F.col("k").alias("high")]
    met = opened.join(shares, "group").withColumn("k", F.pmod(F.xxhash64("u"), F.col("shares")).cast("int"))
    own = (member.select("group", "digest").join(shares, "group")
           .withColumn("k", F.explode(F.sequence(F.lit(0), F.col("shares") - 1))))
    return (met.select(*ends, F.col("k").alias("part"), F.col("u").alias("digest"))
            .unionByName(own.select(*ends, (-1 - F.col("k")).alias("part"), "digest")))


def _pivots(shared: DataFrame, roots: DataFrame, salt: int) -> DataFrame:
    """Pairs (u, v) of a set and at most PIVOTS sets of other components, drawn one from each of its buckets."""
    held = shared.select("token", "digest", "n", "rank").join(
        roots.withColumnRenamed("node", "digest"), "digest", "left").withColumn("root", F.coalesce("root", "digest"))
    drawn = held.groupBy("token").agg(
        F.min_by(F.struct("digest", "n", "rank", "root"), F.xxhash64("digest", "token", F.lit(salt))).alias("pivot"))
    drawn = drawn.select("token", *[F.col(f"pivot.{c}").alias(f"pivot_{c}") for c in ("digest", "n", "rank", "root")])
    met = (held.join(drawn, "token").filter(F.col("root") != F.col("pivot_root"))
           .filter(_compatible("n", "rank", "pivot_n", "pivot_rank")))
    few = met.groupBy("digest").agg(F.slice(F.array_sort(F.collect_set("pivot_digest")), 1, PIVOTS).alias("pivots"))
    return few.select(F.col("digest").alias("u"), F.explode("pivots").alias("v"))


def _meets(held: DataFrame) -> DataFrame:
    """u, n, group: the sets and the groups of other components they meet, of token, digest, n, rank, root, group, members rows.

    Two groups meet once: the sets of the smaller one are compared with the larger. The join takes that up, or the
    many sets of a large group would each give a row with every small one.
    """
    groups = held.groupBy("token", "group").agg(
        F.first("root").alias("group_root"), F.first("members").alias("group_members"), F.min("n").alias("least"),
        F.max("n").alias("most"), F.max(F.col("n") - F.col("rank")).alias("behind"))
    # As ``compatible``, by what the group's members can have at most.
    smallest = F.greatest(4 * F.col("least"), 3 * F.col("n"))
    return (held.withColumnRenamed("group", "own").join(groups, "token")
            .filter((F.col("root") != F.col("group_root"))
                    & (F.struct("members", "own") < F.struct(F.col("group_members").alias("members"), F.col("group").alias("own")))
                    & (3 * F.col("n") <= 4 * F.col("most")) & (3 * F.col("least") <= 4 * F.col("n"))
                    & (28 * F.least(F.col("n") - F.col("rank"), F.col("behind")) >= 3 * (4 * F.col("n") + smallest)))
            .select(F.col("digest").alias("u"), "n", "group").distinct())


def _join(docs: DataFrame, key: str, text: str) -> Join:
    spark = docs.sparkSession
    ship(spark)
    rows = docs.select(F.col(f"`{key}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    rows = rows.withColumn("row", row_key(F.col("doc_id"), F.col("text")))
    profile = cut_lineage(rows.mapInArrow(_profile, PROFILE))
    known = profile.filter("token is null").select("doc_id", "row", "digest", "n")
    bitmap = _frequent_bitmap(profile)

    prefixes = rows.select("text").mapInArrow(_prefixes(bitmap), PREFIX)
    shared = cut_lineage(
        prefixes.repartition("bucket").sortWithinPartitions("bucket", "digest").mapInArrow(_shared, SHARED))
    # The sets of all that can link, from one row each; rows the bitmap adds do no harm.
    wanted = shared.select("digest").distinct()
    holders = known.join(wanted, "digest").groupBy("digest").agg(F.min("row").alias("row"))
    sets = cut_lineage(rows.select("row", "text").mapInArrow(_sets(bitmap_of(holders, "row")), SETS))

    known_sets = sets.count()
    stars = (shared.filter(F.col("digest") != F.col("first"))
             .filter(_compatible("n", "rank", "first_n", "first_rank"))
             .select(F.col("digest").alias("u"), F.col("first").alias("v")).distinct())
    near = cut_lineage(_pass(stars, sets, "brief", "u2"))
    roots = cut_lineage(connected_components(near))
    for salt in range(PIVOT_ROUNDS):
        fresh = cut_lineage(_pass(_pivots(shared, roots, salt), sets, "brief", "u2"))
        near = near.unionByName(fresh)
        spokes = roots.select(F.col("node").alias("u"), F.col("root").alias("v"))
        roots = cut_lineage(connected_components(spokes.unionByName(fresh)))
        if 2 * fresh.count() < known_sets:
            break
    ends = near.select(F.explode(F.array("u", "v")).alias("digest"))
    links = cut_lineage(_pass(near, _only(sets, ends), "tokens", "u8"))
    roots = cut_lineage(connected_components(links))

    # Groups: components cut by digest into parts of about GROUP_SETS; a set alone is its own group.
    sizes = roots.groupBy("root").agg(F.ceil(F.count("*") / GROUP_SETS).alias("parts"))
    member = cut_lineage(
        shared.select("digest", "n").distinct().join(roots.withColumnRenamed("node", "digest"), "digest", "left")
        .join(sizes, "root", "left")
        .select("digest", "n", F.coalesce("root", "digest").alias("root"), F.when(
            F.col("parts").isNull(), F.col("digest")).otherwise(
            F.xxhash64("root", F.pmod(F.xxhash64("digest"), F.col("parts")))).alias("group"), F.col("parts").isNotNull().alias("linked")))
    members = member.groupBy("group").agg(F.count("*").alias("members"))
    held = shared.select("token", "digest", "rank").join(member.drop("linked").join(members, "group"), "digest")
    mixed = held.groupBy("token").agg(F.min("root").alias("a"), F.max("root").alias("b")).filter("a <> b").select("token")
    held = cut_lineage(held.join(mixed, "token"))
    meets = cut_lineage(_meets(held))
    needed = member.join(meets.select("group").distinct(), "group", "left_semi").select("digest", "group")
    unions = (_only(sets, needed, "brief").join(needed, "digest")
              .select("group", "brief").repartition("group").sortWithinPartitions("group")
              .mapInArrow(_unions, "group long, union binary"))
    met = _only(sets, meets.select(F.col("u").alias("digest")), "brief").withColumnRenamed("digest", "u")
    opened = cut_lineage(
        meets.join(met, "u").join(unions, "group")
        .select("u", "n", "group", "brief", "union").mapInArrow(_bounded, BOUNDED))
    return Join(known, links, *(_celled(rows, known, sets) for rows in (_inside(member), _across(opened, member))))


def row_key(doc: Column, text: Column) -> Column:
    """A row's key: equal for rows of equal doc_id and text only, up to 64-bit clashes."""
    return F.xxhash64(doc.isNull(), doc, text.isNull(), text)


def _placed(join: Join, across: DataFrame) -> DataFrame:
    """doc_id, row, digest, n, class (null for empty sets) of each row; ``across`` are SUMS of ``join.across``."""
    final = connected_components(join.links.unionByName(
        across.select(F.col("digest").alias("u"), F.col("peer").alias("v")))).withColumnRenamed("node", "digest")
    return join.known.join(final, "digest", "left").withColumn("class", F.coalesce("root", "digest")).drop("root")


def _summed(cells: DataFrame) -> DataFrame:
    return cells.mapInArrow(_cells(SUMS, _sums), SUMS)


def _named(placed: DataFrame) -> DataFrame:
    least = placed.filter("class is not null").groupBy("class").agg(F.min("doc_id").alias("component_id"))
    return placed.join(least, "class", "left").withColumn("component_id", F.when(
        F.col("class").isNull(), F.col("doc_id")).otherwise(F.col("component_id")))


def link_classes(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_shingles and component_id (least doc_id of the class) of each document."""
    join = _join(docs, key, text)
    return _named(_placed(join, _summed(join.across))).select(
        "doc_id", F.col("n").cast("long").alias("n_shingles"), "component_id")


def link_counts(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``link_classes`` with n_links: the other rows that each row links to."""
    join = _join(docs, key, text)
    across = cut_lineage(_summed(join.across))
    # A set's own copies link to each other.
    copies = join.known.filter("digest is not null").groupBy("digest").agg((F.count("*") - 1).alias("links"))
    sums = (across.unionByName(_summed(join.inside)).select("digest", "links").unionByName(copies)
            .groupBy("digest").agg(F.sum("links").alias("n_links")))
    return _named(_placed(join, across)).join(sums, "digest", "left").select(
        "doc_id", F.col("n").cast("long").alias("n_shingles"), "component_id",
        F.coalesce("n_links", F.lit(0)).alias("n_links"))


def set_links(docs: DataFrame, key: str = "doc_id", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """All links u < v between digests of different sets, and doc_id and digest of each document."""
    join = _join(docs, key, text)
    kind = "u long, v long"
    found = [cells.mapInArrow(_cells(kind, _pairs), kind) for cells in (join.inside, join.across)]
    return found[0].unionByName(found[1]), join.known.select("doc_id", "digest")


def class_rows(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``row`` keys of one row of each class: the least doc_id, nulls last, then the least key. Empty sets have none."""
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "row")
    join = _join(docs, key, text)
    return (_placed(join, _summed(join.across)).filter("class is not null")
            .groupBy("class").agg(F.min_by("row", order).alias("row")).select("row"))


@register("op2_jaccard_groups")
def op2_jaccard_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link_counts(read(spark, sf_dir, "documents"))
