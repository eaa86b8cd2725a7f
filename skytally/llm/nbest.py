"""N-best SentencePiece segmentation: forward Viterbi, then backward A* over the piece lattice.

The lattice of a text has an edge for every piece of the vocabulary that occurs in it, and byte
pieces for a character that is no piece. Forward Viterbi gives each position the best score of
the text before it; A* goes backward from the end, and that score is an exact heuristic for
what is left, so segmentations come out in falling order of their sum of piece scores. For the n best no
position has to be left more than n times, nor over more than its n best edges; paths are linked
nodes. So a text of m characters takes at most n m steps, ties included, however many segmentations it has.

Pieces are scored by log-probability. A unigram model's file gives them. The given file is a BPE model,
whose scores only rank its pieces: the k-th piece then has the probability of Zipf's law, proportional
to 1 / (k + ``ZIPF_SHIFT``), and byte pieces come last. So the best segmentation is the most probable one
under that law, which is not always the one BPE's merges give.

The lattice falls into parts wherever no piece of the vocabulary joins the character classes on both
sides (mark, Latin letter, other); which classes are joined is read from the vocabulary. The best and second
best of a part are searched once per worker (bounded caches of the parts and words met lately); A* over a
text then only chooses, at each word, among the word's own n best, and so a word's over its parts': the loss
against the best is the sum of the losses, and only those that lose least can take part in the next best.

Decoding joins pieces, bytes and marks back into the text. Each of the n best is put together and decoded whole.

Cases: a null or empty text has one segmentation, without pieces; a text with fewer segmentations
than asked for gives those it has; repeated rows are segmented alike; of equal scores any order is given,
the same one each time; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import gc
import heapq
import math
import re
from array import array
from collections.abc import Iterator, Sequence
from functools import lru_cache
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skytally.llm.registry import read, register, ship

N_BEST = 3
MARK = "▁"
ZIPF_SHIFT = 2.7
CACHE_ENTRIES = 200_000
LATIN = "".join(chr(c) for c in range(0xC0, 0x250) if chr(c).isalpha())

Best = tuple[float, tuple[int, ...]]
Entry = tuple[float, bytes, float, bytes]  # best score, its ids, loss of the second best, decoded
Whole = tuple[float, bytes, bytes]  # score, ids (little-endian uint32), the text they decode to (UTF-8)


def char_class(c: str) -> str:
    return "mark" if c == MARK else "letter" if c.isascii() and c.isalpha() or c in LATIN else "other"


def parts_pattern(pieces: dict) -> re.Pattern:
    """Cuts a text where no piece joins the classes of the neighbouring characters."""
    joined = {(char_class(a), char_class(b)) for piece in pieces for a, b in zip(piece, piece[1:])}
    sets = {"mark": MARK, "letter": f"A-Za-z{LATIN}", "other": f"^{MARK}A-Za-z{LATIN}"}
    looks = [f"(?<=[{sets[a]}])(?=[{sets[b]}])" for a in sets for b in sets if (a, b) not in joined]
    return re.compile("|".join(looks) or "(?!)")


def log_probabilities(scores: list[float], ranked: bool) -> list[float]:
    """Of pieces in the file's order; by rank where the scores are ranks."""
    if not ranked:
        return scores
    whole = math.log(sum(1.0 / (k + ZIPF_SHIFT) for k in range(1, len(scores) + 1)))
    return [-math.log(k + ZIPF_SHIFT) - whole for k in range(1, len(scores) + 1)]


class Lattice:
    """Pieces and scores of a SentencePiece model, and the ``n`` best segmentations of texts."""

    def __init__(self, path: str, n: int):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.n = n
        self.bytes, usual, scores = [0] * 256, [], []
        self.raw_piece: list[bytes] = []
        for i in range(model.get_piece_size()):
            piece = model.id_to_piece(i)
            self.raw_piece.append(piece.replace(MARK, " ").encode("utf-8", "surrogatepass"))
            if model.is_byte(i):
                self.bytes[int(piece[3:5], 16)] = i
                self.raw_piece[i] = bytes([int(piece[3:5], 16)])
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                usual.append((piece, i))
                scores.append(model.get_score(i))
        # Ranks are whole numbers; log-probabilities of a unigram model are not.
        chances = log_probabilities(scores, all(s == int(s) for s in scores))
        self.byte_score = min(chances) - math.log(256)
        self.pieces = {piece: (i, chance) for (piece, i), chance in zip(usual, chances)}
        # Character → (deeper characters, the piece that ends here).
        self.tree: dict[str, tuple[dict, tuple | None]] = {}
        for piece, (i, chance) in sorted(self.pieces.items()):  # a beginning before what it begins
            level = self.tree
            for c in piece[:-1]:
                level = level.setdefault(c, ({}, None))[0]
            deeper = level[piece[-1]][0] if piece[-1] in level else {}
            level[piece[-1]] = (deeper, ((i,), chance))
        used = set("".join(self.pieces))
        self.stop = next(c for c in map(chr, range(0x10FFFF, 0, -1)) if c not in used)
        self.split = parts_pattern(self.pieces).split
        self.whole_words = len(self.split(f"{MARK}ab")) == 1  # a mark and plain letters are one part
        # If no piece joins a mark to what is before it, a text falls into words at once.
        inner = any(a != MARK and b == MARK for piece in self.pieces for a, b in zip(piece, piece[1:]))
        self.words = (lambda text: [text]) if inner else re.compile(f"{MARK}+[^{MARK}]*").findall
        self.plain_words = not inner
        self.known, self.earlier = {}, {}  # entries of parts
        self.word_known, self.word_earlier = {}, {}  # and of words
        self.several: dict[str, list[Best]] = {}

    def _forward(self, part: str, n: int) -> list[list[tuple[float, int, tuple]]]:
        """Viterbi: the n best edges that end at each position as (best score with it, start, (ids, score))."""
        tree, size, padded = self.tree, len(part), part + self.stop
        ends: list[list] = [[] for _ in range(size + 1)]
        best = 0.0
        for start in range(size):
            if start:
                edges = ends[start]
                if len(edges) > 1:
                    edges.sort(reverse=True)
                    del edges[n:]
                best = edges[0][0]
            node = tree.get(part[start])
            if not node or not node[1]:
                data = part[start].encode("utf-8", "surrogatepass")
                score = self.byte_score * len(data)
                ends[start + 1].append((best + score, start, (tuple([self.bytes[b] for b in data]), score)))
            end = start
            while node:
                end += 1
                level, found = node
                if found:
                    ends[end].append((best + found[1], start, found))
                node = level.get(padded[end])
        ends[size].sort(reverse=True)
        del ends[size][n:]
        return ends

    def search(self, part: str, n: int) -> list[tuple[float, tuple]]:
        """Backward A*: score and path (ids, rest of the path) of the n best segmentations, best first."""
        ends = self._forward(part, n)
        left = [n] * len(ends)  # how often a position may still be left
        serial, found, push, pop = 0, [], heapq.heappush, heapq.heappop
        heap = [(-ends[-1][0][0], 0, len(part), 0.0, None)]
        while heap and len(found) < n:
            loss, _, at, behind, path = pop(heap)
            # The best edge loses nothing, so it is followed at once; the others wait in the heap.
            while at and left[at]:
                left[at] -= 1
                (_, start, (ids, score)), *others = ends[at]
                for total, other, (other_ids, other_score) in others:
                    serial += 1  # of equal totals the one found first
                    push(heap, (-(total + behind), serial, other, behind + other_score, (other_ids, path)))
                at, behind, path = start, behind + score, (ids, path)
            if not at:
                found.append((-loss, path))
        return found

    def part_n_best(self, part: str, n: int) -> list[Best]:
        """The part's n best segmentations as (score, ids), best first."""
        return [(score, _ids(path)) for score, path in self.search(part, n)]

    def entry(self, part: str) -> Entry:
        """As ``search`` for two, whose second path loses least where it leaves the best one: each position needs
        its best edge and the total of the next."""
        tree, size, padded, none = self.tree, len(part), part + self.stop, -math.inf
        top, below, came, via = [none] * (size + 1), [none] * (size + 1), [0] * (size + 1), [None] * (size + 1)
        top[0] = 0.0
        for start in range(size):
            best, end = top[start], start
            node = tree.get(part[start])
            if not node or not node[1]:
                data = part[start].encode("utf-8", "surrogatepass")
                score = self.byte_score * len(data)
                total, end = best + score, start + 1
                if total >= top[end]:  # of equal totals the later start
                    below[end], top[end], came[end] = top[end], total, start
                    via[end] = (tuple([self.bytes[b] for b in data]), score)
                elif total > below[end]:
                    below[end] = total
                node = node and node[0].get(padded[end])
            while node:
                end += 1
                level, found = node
                if found:
                    total = best + found[1]
                    if total >= top[end]:
                        below[end], top[end], came[end], via[end] = top[end], total, start, found
                    elif total > below[end]:
                        below[end] = total
                node = level.get(padded[end])
        at, behind, second, back = size, 0.0, none, []
        while at:
            if below[at] + behind > second:
                second = below[at] + behind
            ids, score = via[at]
            back.append(ids)
            behind += score
            at = came[at]
        back.reverse()
        ids = [i for piece in back for i in piece]
        return top[size], array("I", ids).tobytes(), top[size] - second, self.raw(ids)

    def word_entry(self, word: str) -> Entry:
        """From its parts' entries: the second best differs from the best in the part that loses least."""
        if self.whole_words and word.isascii() and word.isalpha():
            return self.entry(MARK + word)
        known, parts = self.known, self.split(marked(word))
        for part in parts:
            if part not in known:
                known[part] = self.earlier.get(part) or self.entry(part)
        if len(parts) == 1:
            return known[parts[0]]
        scores, ids, losses, decoded = zip(*[known[part] for part in parts])
        return sum(scores), b"".join(ids), min(losses), b"".join(decoded)

    def entries(self, text: str) -> tuple[list[str], list[Entry]]:
        """The words of a text and the entry of each; runs of spaces and the word after them are a word."""
        if not text:
            return [], []
        if self.plain_words and not ("  " in text or text[0] == " " or text[-1] == " " or MARK in text):
            words = text.split(" ")
        else:
            words = self.words(MARK + text.replace(" ", MARK))
        # What was not met since the last time goes.
        if len(self.known) > CACHE_ENTRIES:
            self.earlier, self.known = self.known, {}
        if len(self.word_known) > CACHE_ENTRIES:
            self.word_earlier, self.word_known = self.word_known, {}
        known = self.word_known
        for word in set(words).difference(known):
            known[word] = self.word_earlier.get(word) or self.word_entry(word)
        return words, [known[word] for word in words]

    def word_n_best(self, word: str) -> list[Best]:
        """The word's n best segmentations, from those of its parts."""
        parts = self.split(marked(word))
        entries = [self.known.get(part) or self.earlier.get(part) or self.entry(part) for part in parts]
        return self._combined(parts, entries, lambda part: self.part_n_best(part, self.n))

    def _choices(self, units: list[str], entries: list[Entry], several) -> Iterator[tuple[float, dict[int, Best]]]:
        """The n best (loss, unit → its segmentation where not the best), least loss first."""
        losses, least = [e[2] for e in entries], []
        for _ in range(self.n - 1):
            k = losses.index(min(losses)) if losses else 0
            if not losses or losses[k] == math.inf:
                break
            least.append(k)
            losses[k] = math.inf
        held = [several(units[k]) for k in least]
        heap: list[tuple[float, int, tuple[int, ...]]] = [(0.0, 0, ())]
        given = 0
        while heap and given < self.n:
            loss, depth, picked = heapq.heappop(heap)
            if depth == len(least):
                given += 1
                yield loss, {k: best[j] for k, best, j in zip(least, held, picked) if j}
                continue
            best = held[depth]
            for j, (score, _) in enumerate(best):  # what is left can lose nothing: exact
                heapq.heappush(heap, (loss + best[0][0] - score, depth + 1, (*picked, j)))

    def _combined(self, units: list[str], entries: list[Entry], several) -> list[Best]:
        total = sum([e[0] for e in entries])
        plain = [tuple(np.frombuffer(e[1], "<u4").tolist()) for e in entries]
        return [(total - loss, tuple(i for k, ids in enumerate(plain) for i in (other[k][1] if k in other else ids)))
                for loss, other in self._choices(units, entries, several)]

    def word_choices(self, word: str) -> list[Best]:
        if len(self.several) > CACHE_ENTRIES // 10:
            self.several.clear()
        if word not in self.several:
            self.several[word] = self.word_n_best(word)
        return self.several[word]

    def n_best(self, text: str) -> list[Best]:
        """The text's n best segmentations as (score, ids), best first."""
        return self._combined(*self.entries(text), self.word_choices)

    def segmentations(self, text: str) -> list[Whole]:
        """The text's n best segmentations, each put together and decoded whole, best first."""
        words, entries = self.entries(text)
        total, ids, raw = sum([e[0] for e in entries]), [e[1] for e in entries], [e[3] for e in entries]
        found = []
        for loss, other in self._choices(words, entries, self.word_choices):
            pieces, parts = ids, raw
            if other:
                pieces, parts = ids.copy(), raw.copy()
                for k, (_, chosen) in other.items():
                    pieces[k], parts[k] = array("I", chosen).tobytes(), self.raw(chosen)
            found.append((total - loss, b"".join(pieces), b"".join(parts)[1:]))
        return found

    def raw(self, ids: Sequence[int]) -> bytes:
        """What the pieces stand for; word marks become spaces."""
        piece = self.raw_piece
        return b"".join([piece[i] for i in ids])

    def decode(self, ids: tuple[int, ...]) -> str:
        """The text of a segmentation, without the mark it begins with."""
        return self.raw(ids).decode("utf-8", "surrogatepass")[1:]


def marked(word: str) -> str:
    return word if word.startswith(MARK) else MARK + word


def _ids(path: tuple | None) -> tuple[int, ...]:
    out: list[int] = []
    while path:
        out += path[0]
        path = path[1]
    return tuple(out)


@lru_cache(maxsize=2)
def lattice(path: str, n: int) -> Lattice:
    made = Lattice(path, n)
    gc.freeze()  # the vocabulary stays as long as the worker; no collection has to look at it
    return made


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


SEGMENTATIONS = "doc_id long, segmentations array<struct<score double, ids binary, decoded string>>"
BATCH_ROWS, BATCH_BYTES = 500, 4 << 20


def _batch(keys: list, found: list[list[Whole]]) -> pa.RecordBatch:
    offsets = [0, *accumulate(map(len, found))]
    scores, ids, decoded = zip(*[one for several in found for one in several])
    held = pa.StructArray.from_arrays(
        [pa.array(scores, pa.float64()), pa.array(ids, pa.binary()), pa.array(decoded, pa.string())],
        names=["score", "ids", "decoded"])
    return pa.RecordBatch.from_arrays(
        [pa.array(keys, pa.int64()), pa.ListArray.from_arrays(offsets, held)], names=["doc_id", "segmentations"])


def n_best_segmentations(docs: DataFrame, model_path: str, n: int = N_BEST, key: str = "doc_id",
                         text: str = "text") -> DataFrame:
    """Per document its n best segmentations, best first: score, ids (little-endian uint32) and decoded text."""
    ship(docs.sparkSession)
    rows = docs.select(F.col(f"`{key}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = lattice(model_path, n)
        for batch in batches:
            for at in range(0, batch.num_rows, BATCH_ROWS):
                part = batch.slice(at, BATCH_ROWS)
                keys, found, size = [], [], 0
                for doc_id, value in zip(part.column("doc_id").to_pylist(), part.column("text").to_pylist()):
                    keys.append(doc_id)
                    found.append(pieces.segmentations(value or ""))
                    size += len(value or "")
                    if size > BATCH_BYTES:
                        yield _batch(keys, found)
                        keys, found, size = [], [], 0
                if keys:
                    yield _batch(keys, found)

    return rows.mapInArrow(run, SEGMENTATIONS)


def segment_documents(docs: DataFrame, model_path: str, n: int = N_BEST, key: str = "doc_id",
                      text: str = "text") -> DataFrame:
    """Per document, of its n best segmentations: size, crc32 and score of the best and of each other, the sha256
    (UTF-8) of the text the best decodes to, and whether the others decode alike."""
    found = n_best_segmentations(docs, model_path, n, key, text)
    best, others = F.col("segmentations")[0], F.slice("segmentations", 2, n)
    size = lambda s: (F.octet_length(s["ids"]) / 4).cast("long")
    return found.select(
        "doc_id", size(best).alias("n_pieces"), F.crc32(best["ids"]).alias("ids_crc32"),
        F.size("segmentations").alias("n_found"), best["score"].alias("best_score"), others["score"].alias("next_scores"),
        F.forall("segmentations", lambda s: s["decoded"] == best["decoded"]).alias("decoded"),
        F.sha2(best["decoded"], 256).alias("decoded_sha256"),
        F.transform(others, size).alias("next_n_pieces"),
        F.transform(others, lambda s: F.crc32(s["ids"])).alias("next_ids_crc32"))


@register("op8_nbest_segmentation")
def op8_nbest_segmentation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return segment_documents(read(spark, sf_dir, "documents"), default_model())
