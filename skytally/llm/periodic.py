"""Periodic runs of words, found on a Re-Pair grammar of each text.

A run is a stretch of consecutive words with smallest period q (words q apart are identical), at least
``max(MIN_WORDS, MIN_EXPONENT * q)`` words long, that no neighbouring word extends.

Re-Pair replaces the most frequent pair of adjacent symbols by a new nonterminal, over and over. In a run
every pair of neighbours occurs at least ``MIN_PAIRS`` times without overlap, so pairs met less often are
not replaced and no run crosses them: a text is cut at them, which leaves almost nothing of ordinary
prose, and each stretch that is left gets its own grammar. In a round all top pairs that share no symbol
are replaced together, which is what replacing them one by one gives. What is left of a stretch at last
is joined two by two into a balanced tree.

Every place between two words then lies inside exactly one derivation of a node Y Z, at its boundary. The
runs of a node's expansion that cross its boundary are computed once per nonterminal: such a run has 2 q
words on one side of the boundary, so q is the distance from the boundary's words to a later or earlier
occurrence, and the common extensions at that distance give its ends. Shifted to all positions that
derive the nonterminal, intervals of equal period that share a period are merged; what remains is the
maximal runs. Common extensions are exact, by names of words' blocks of doubling length.

All stretches of a batch are worked on together in numpy; a task holds a batch of ``BATCH_WORDS`` words,
or one longer text with about 8 bytes times the logarithm of its length for each word of its stretches.

Cases: a null or empty text has no words, no runs and an empty collapsed text; repeated rows and rows
without doc_id give a row each; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skytally.llm.registry import read, register, ship

MIN_WORDS, MIN_EXPONENT = 6, 4
MIN_PAIRS = 3  # MIN_EXPONENT - 1: a pair recurs at every period but, at the end, the last
BATCH_WORDS, BATCH_TEXTS = 300_000, 10_000
BLOCK_CANDIDATES = 2_000_000

Words = list[bytes]


def spread(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For counts c: the owner of each of sum(c) items, and the item's number within its owner."""
    owner = np.repeat(np.arange(len(counts)), counts)
    return owner, np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)


def pair_counts(left: np.ndarray, right: np.ndarray, base: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return np.unique(left * base + right, return_inverse=True, return_counts=True)


def stretches(symbols: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions that may lie in a run, and the number of the stretch of each."""
    place = np.arange(len(symbols))
    while True:
        base = int(symbols.max(initial=0)) + 1
        same = group[1:] == group[:-1]
        own = group * base + symbols
        if own.max(initial=0) * base >= 1 << 62:  # keys of pairs would not fit
            own = np.unique(own, return_inverse=True)[1]
        _, pair, count = pair_counts(own[:-1], symbols[1:], base)
        joined = same & (count[pair] >= MIN_PAIRS) if len(pair) else same
        number = np.concatenate([[0], np.cumsum(~joined)]) if len(symbols) else group
        kept = np.bincount(number)[number] >= MIN_WORDS if len(symbols) else np.empty(0, bool)
        if kept.all() and (not len(symbols) or number[-1] == group[-1]):
            return place, group
        place, symbols = place[kept], symbols[kept]
        group = np.unique(number[kept], return_inverse=True)[1]


class Grammar:
    """Re-Pair over stretches whose symbols differ; nodes with their expansions and derivations.

    ``start``, ``middle``, ``end``: one expansion of each node and its boundary, as text positions.
    ``node``, ``at``: every derivation of a node, by its text position.
    """

    def __init__(self, symbols: np.ndarray, group: np.ndarray):
        self.parts: list[tuple[np.ndarray, ...]] = []
        self.derived: list[tuple[np.ndarray, np.ndarray]] = []
        self.nodes = 0
        begin = np.arange(len(symbols))
        rest = self.replace(symbols, group, begin, begin + 1)
        self.balance(*rest)
        self.start, self.middle, self.end = (np.concatenate(c) for c in zip(*self.parts))
        self.node, self.at = (np.concatenate(c) for c in zip(*self.derived))

    def add(self, start, middle, end, node=None, at=None) -> None:
        number = np.arange(len(start)) if node is None else node
        self.parts.append((start, middle, end))
        self.derived.append((number + self.nodes, start if at is None else at))
        self.nodes += len(start)

    def replace(self, symbol, group, begin, end):
        """Replace top pairs until none occurs ``MIN_PAIRS`` times; the remaining sequence."""
        done, random = [], np.random.default_rng(0)
        owner = np.zeros(int(symbol.max()) + 1, "int64")
        owner[symbol] = group
        while True:
            base = len(owner)
            change = np.concatenate([[True], symbol[1:] != symbol[:-1]])
            turn = np.arange(len(symbol)) - np.maximum.accumulate(np.where(change, np.arange(len(symbol)), 0))
            # Of equal neighbours every other pair counts, so that occurrences do not overlap.
            left = np.flatnonzero((group[1:] == group[:-1]) & (change[1:] | (turn[:-1] % 2 == 0)))
            pairs, which, count = pair_counts(symbol[left], symbol[left + 1], base)
            a, b = pairs // base, pairs % base
            top = np.zeros(int(group[-1]) + 1, "int64")
            np.maximum.at(top, owner[a], count)
            tops = np.flatnonzero((count >= MIN_PAIRS) & (count == top[owner[a]]))
            live = top[group] >= MIN_PAIRS
            done.append((symbol[~live], group[~live], begin[~live], end[~live]))
            if not len(tops):
                break
            # Top pairs that come first, in random order, at both their symbols.
            rank, (names, at) = random.permutation(len(tops)), np.unique(
                np.concatenate([a[tops], b[tops]]), return_inverse=True)
            least = np.full(len(names), len(tops))
            np.minimum.at(least, at, np.concatenate([rank, rank]))
            first, second = np.split(least[at], 2)
            chosen = tops[(first == rank) & (second == rank)]
            name = np.full(len(pairs), -1)
            name[chosen] = np.arange(len(chosen))
            new = name[which]
            spot, new = left[new >= 0], new[new >= 0]
            example = np.empty(len(chosen), "int64")
            example[new] = spot
            self.add(begin[example], begin[example + 1], end[example + 1], new, begin[spot])
            symbol = symbol.copy()
            symbol[spot], end[spot] = base + new, end[spot + 1]
            owner = np.concatenate([owner, owner[a[chosen]]])
            live[spot + 1] = False
            symbol, group, begin, end = symbol[live], group[live], begin[live], end[live]
        rest = [np.concatenate(c) for c in zip(*done)]
        order = np.argsort(rest[2])
        return rest[1][order], rest[2][order], rest[3][order]

    def balance(self, group, begin, end) -> None:
        """Join neighbours of a stretch two by two."""
        while len(group) > 1:
            first = np.concatenate([[True], group[1:] != group[:-1]])
            turn = np.arange(len(group)) - np.maximum.accumulate(np.where(first, np.arange(len(group)), 0))
            left = np.flatnonzero((turn[:-1] % 2 == 0) & (group[1:] == group[:-1]))
            if not len(left):
                break
            self.add(begin[left], begin[left + 1], end[left + 1])
            end[left] = end[left + 1]
            kept = np.ones(len(group), bool)
            kept[left + 1] = False
            group, begin, end = group[kept], begin[kept], end[kept]
        if not self.parts:
            self.add(*[np.empty(0, "int64")] * 3)


class Extensions:
    """Common extensions of positions of one stretch, by names of blocks of 1, 2, 4, … symbols."""

    def __init__(self, symbols: np.ndarray, longest: int):
        self.n = len(symbols)
        self.names = [symbols.astype("int64")]
        for level in range(max(longest, 2).bit_length() - 1):
            width, last = 1 << level, self.names[-1]
            name = -1 - np.arange(self.n)  # blocks that reach beyond the text equal none
            if self.n >= 2 * width:
                whole = self.n - 2 * width + 1
                name[:whole] = np.unique(last[:whole] * (self.n + 1) + last[width:width + whole], return_inverse=True)[1]
            self.names.append(name)

    def equal(self, i: np.ndarray, j: np.ndarray, width: np.ndarray) -> np.ndarray:
        """Whether the blocks of ``width`` symbols at i and j are the same, by two overlapping names."""
        level = np.frexp(width.astype(float))[1] - 1
        found = np.zeros(len(i), bool)
        for k in np.unique(level):
            at, name = level == k, self.names[k]
            step = width[at] - (1 << k)
            found[at] = (name[i[at]] == name[j[at]]) & (name[i[at] + step] == name[j[at] + step])
        return found

    def right(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Equal symbols from i and from j on, i < j."""
        total = np.zeros(len(i), "int64")
        for k in range(len(self.names) - 1, -1, -1):
            a, b = i + total, j + total
            same = b < self.n
            same[same] = self.names[k][a[same]] == self.names[k][b[same]]
            total += same * (1 << k)
        return total

    def left(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Equal symbols before i and before j, i < j."""
        total = np.zeros(len(i), "int64")
        for k in range(len(self.names) - 1, -1, -1):
            a, b = i - total - (1 << k), j - total - (1 << k)
            same = a >= 0
            same[same] = self.names[k][a[same]] == self.names[k][b[same]]
            total += same * (1 << k)
        return total


def crossing_runs(grammar: Grammar, text: Extensions) -> np.ndarray:
    """Rows node, start, end, period: the runs of each node's expansion that cross its boundary."""
    n, pair = text.n, text.names[1]
    order = np.lexsort((np.arange(n), pair))
    keys = (pair - pair.min())[order] * n + order
    rank = np.empty(n, "int64")
    rank[order] = np.arange(n)
    start, middle, end = grammar.start, grammar.middle, grammar.end
    name = (pair - pair.min()) * n
    found = []
    for later in (True, False):
        reach = (end - middle if later else middle - start) // 2
        anchor = middle if later else np.maximum(middle - 2, 0)
        if later:
            low, high = rank[anchor] + 1, np.searchsorted(keys, name[anchor] + anchor + reach, "right")
        else:
            low, high = np.searchsorted(keys, name[anchor] + np.maximum(anchor - reach, 0), "left"), rank[anchor]
            high = np.where(middle - 2 >= start, high, low)
        counts = np.maximum(high - low, 0)
        block = np.cumsum(counts) // BLOCK_CANDIDATES
        for cut in np.split(np.arange(len(counts)), np.flatnonzero(np.diff(block)) + 1):
            owner, turn = spread(counts[cut])
            owner = cut[owner]
            q = np.abs(order[low[owner] + turn] - anchor[owner])
            b = middle[owner]
            i, j = (b, b + q) if later else (b - q, b)
            fits = text.equal(i, j, q) if later else text.equal(i - q, j - q, q)
            owner, q, i, j = owner[fits], q[fits], i[fits], j[fits]
            before = np.minimum(text.left(i, j), i - start[owner])
            after = np.minimum(text.right(i, j), end[owner] - j)
            crosses = (before if later else after) > 0
            long = before + q + after >= np.maximum(MIN_WORDS, MIN_EXPONENT * q)
            at = crosses & long
            found.append(np.stack([owner[at], (i - before)[at], (j + after)[at], q[at]]))
    return least_periods(np.concatenate(found, axis=1))


def least_periods(runs: np.ndarray) -> np.ndarray:
    """Of rows that differ in their last column only, the one with the least."""
    runs = runs[:, np.lexsort(runs[::-1])]
    new = np.ones(runs.shape[1], bool)
    new[1:] = (runs[:-1, 1:] != runs[:-1, :-1]).any(axis=0)
    return runs[:, new]


def merged(start: np.ndarray, end: np.ndarray, period: np.ndarray) -> np.ndarray:
    """Intervals of equal period that share a period's length made one; rows start, end, period."""
    order = np.lexsort((-end, start, period))
    start, end, period = start[order], end[order], period[order]
    lift = period * (int(end.max(initial=0)) + 1) * 2
    furthest = np.maximum.accumulate(end + lift)
    new = np.ones(len(start), bool)
    new[1:] = (start + lift + period)[1:] > furthest[:-1]
    first = np.flatnonzero(new)
    last = np.concatenate([first[1:], [len(start)]])[:len(first)] - 1
    return least_periods(np.stack([start[first], furthest[last] - lift[last], period[first]]))


def text_runs(texts: list[Words]) -> list[np.ndarray]:
    """Runs of each list of words, as columns start, length, period by start, then period."""
    sizes = np.array([len(words) for words in texts], "int64")
    index: dict[bytes, int] = {}
    for words in texts:
        for word in set(words).difference(index):
            index[word] = len(index)
    ids = np.fromiter((index[word] for words in texts for word in words), "int64", int(sizes.sum()))
    document = np.repeat(np.arange(len(texts)), sizes)
    place, group = stretches(ids, document)
    none = np.empty((3, 0), "int64")
    if not len(place):
        return [none] * len(texts)
    symbols = np.unique(group * (len(index) + 1) + ids[place], return_inverse=True)[1]
    grammar = Grammar(symbols, group)
    node, start, end, period = crossing_runs(grammar, Extensions(symbols, int(np.bincount(group).max())))
    # To every derivation of the node.
    order = np.argsort(grammar.node, kind="stable")
    derived, at = grammar.node[order], grammar.at[order]
    low, high = np.searchsorted(derived, node, "left"), np.searchsorted(derived, node, "right")
    run, turn = spread(high - low)
    shift = at[low[run] + turn] - grammar.start[node[run]]
    start, end, period = merged(start[run] + shift, end[run] + shift, period[run])
    first = np.cumsum(sizes) - sizes
    owner = document[place[start]]
    runs = np.stack([place[start] - first[owner], end - start, period])
    order = np.lexsort((period, runs[0], owner))
    cuts = np.searchsorted(owner[order], np.arange(1, len(texts)))
    return np.split(runs[:, order], cuts, axis=1)


def collapsed(words: Words, runs: np.ndarray) -> bytes:
    """The words without those a run repeats after its first period, joined by a space."""
    if runs.shape[1]:
        marks = np.zeros(len(words) + 1, "int64")
        np.add.at(marks, runs[0] + runs[2], 1)
        np.add.at(marks, runs[0] + runs[1], -1)
        words = [words[i] for i in np.flatnonzero(np.cumsum(marks)[:-1] == 0)]
    return b" ".join(words)


RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
RESULT = "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"


def periodic_runs(docs: DataFrame, key: str = "doc_id", text: str = "text",
                  prepare: Callable[[int | None, Words], Words] | None = None) -> DataFrame:
    """doc_id, n_words, runs and the collapsed text; ``prepare`` may change a document's words first.

    Words are what ASCII white space divides.
    """
    ship(docs.sparkSession)
    rows = docs.select(F.col(f"`{key}`").cast("long").alias("doc_id"),
                       F.coalesce(F.col(f"`{text}`"), F.lit("")).cast("binary").alias("text"))

    def results(held: list[tuple[int | None, Words]]) -> pa.RecordBatch:
        found = text_runs([words for _, words in held])
        ends = np.concatenate([[0], np.cumsum([runs.shape[1] for runs in found])])
        flat = np.concatenate(found, axis=1)
        struct = pa.StructArray.from_arrays([pa.array(c) for c in flat], fields=list(RUN))
        texts = pa.array([collapsed(words, runs) for (_, words), runs in zip(held, found)], pa.binary())
        return pa.RecordBatch.from_arrays(
            [pa.array([doc for doc, _ in held], pa.int64()), pa.array([len(words) for _, words in held], pa.int64()),
             pa.ListArray.from_arrays(pa.array(ends.astype("int32")), struct), texts.cast(pa.string())],
            names=["doc_id", "n_words", "runs", "collapsed"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, total = [], 0
        for batch in batches:
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                words = text.as_py().split()
                held.append((doc, prepare(doc, words) if prepare else words))
                total += len(words)
                if total >= BATCH_WORDS or len(held) == BATCH_TEXTS:
                    yield results(held)
                    held, total = [], 0
        if held:
            yield results(held)

    return rows.mapInArrow(run, RESULT)


def repeat_tail(doc: int | None, words: Words) -> Words:
    """In a tenth of the documents the words from some place on become periodic; by the id's crc32."""
    if doc is None or not words:
        return words
    mark, n = crc32(str(doc).encode()), len(words)
    if mark % 10:
        return words
    g = mark // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + i % p] for i in range(n - a)]


@register("op12_periodic_runs")
def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = periodic_runs(read(spark, sf_dir, "documents"), prepare=repeat_tail)
    ranked = F.transform("runs", lambda r: F.struct(
        -r["length"], r["start"], r["period"], r["length"].alias("n")))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    best = rows.withColumn("best", F.array_min(ranked))
    return best.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("best.start").alias("start"),
        F.col("best.n").alias("length"), F.col("best.period").alias("period"),
        F.floor(F.lit(1000) * F.col("best.n") / F.col("best.period")).cast("long").alias("exponent_milli"),
        F.sha2(F.concat(F.array_join(lines, "\n"), F.when(F.size("runs") > 0, "\n").otherwise("")), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"))
