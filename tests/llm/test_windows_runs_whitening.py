"""Operators 11 to 13 on odd rows, against plain Python versions."""

import hashlib
import math
import random
import re
import time
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from skytally.llm import periodic, whitening, windows
from skytally.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"
SPACE = re.compile("[\x20\x09-\x0d]+")


def words_of(text):
    return [w for w in SPACE.split(text or "") if w]


@pytest.fixture(scope="module")
def docs_with_nulls(spark, odd_docs, odd_rows):
    """The odd documents, and rows without doc_id, some of them equal."""
    extra = odd_docs.filter("doc_id in (5, 7, 12)").withColumn("doc_id", F.lit(None).cast("long"))
    rows = [*odd_rows, *[(None, t) for d, t in odd_rows if d in (5, 7, 12)] * 2]
    return odd_docs.unionByName(extra).unionByName(extra), rows


# 11 windows
def plain_best_fit(sizes, window):
    """Room left in each window, one piece at a time."""
    rooms = []
    for size in sorted(sizes, reverse=True):
        fitting = [(room, i) for i, room in enumerate(rooms) if room >= size]
        if fitting:
            rooms[min(fitting)[1]] -= size
        else:
            rooms.append(window - size)
    return sorted(rooms)


def test_plan_is_best_fit_decreasing():
    for seed in range(300):
        rng = random.Random(seed)
        window = rng.choice([1, 2, 7, 16, 50, 64])
        sizes = [rng.randint(1, window) for _ in range(rng.randint(0, 80))]
        held = defaultdict(list)
        for length, number, pieces, each, first, offset in windows.plan(Counter(sizes), window):
            for k in range(pieces):
                held[first + k // each].append((offset + k % each * length, length))
        for spans in held.values():
            spans.sort()
            assert [at for at, _ in spans] == [sum(n for _, n in spans[:i]) for i in range(len(spans))]
        assert sorted(window - sum(n for _, n in spans) for spans in held.values()) == plain_best_fit(sizes, window)
        assert sorted(held) == list(range(len(held)))


def test_plan_does_not_grow_with_the_counts():
    rng = random.Random(2)
    shape = {n: rng.randint(1, 50) for n in range(1, 2048)}
    small, large = (windows.plan({n: c * times for n, c in shape.items()}) for times in (1, 10 ** 6))
    assert len(large) < 4 * len(small) < 100_000


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(windows.default_tokenizer())
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids


def test_encoder_gives_the_librarys_ids(library):
    own = windows.ByteEncoder(windows.default_tokenizer())
    assert own.cached
    letters = "ab Zé's\n\t  .,!?19²½'tre\x0b\x85\xa0\x1c\x1f_—“€xxx"
    for seed in range(5000):
        rng = random.Random(seed)
        text = "".join(rng.choice(letters + ("梦😀  " if seed % 5 == 0 else "")) for _ in range(rng.randint(0, 30)))
        assert own.encode(text).tolist() == library(text)


def test_encoder_leaves_other_tokenizers_whole():
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    own, text = windows.ByteEncoder(path), "It's A  Test, don't <|endoftext|> go"
    assert not own.cached
    assert own.encode(text).tolist() == Tokenizer.from_file(path).encode(text, add_special_tokens=False).ids


def check_places(rows, places, library, window):
    """Every id of every row in one piece, pieces gapless in windows, as full as best fit makes them."""
    wanted, sizes = Counter(), []
    for doc, text in rows:
        ids = np.array([*library(text), windows.END_ID], "<u4")
        for start in range(0, len(ids), window):
            piece = ids[start:start + window]
            sizes.append(len(piece))
            wanted[doc, start, len(piece), zlib.crc32(piece.tobytes()), len(ids)] += 1
    assert Counter(tuple(p)[:5] for p in places) == wanted
    held = defaultdict(list)
    for p in places:
        held[p["sequence_id"]].append((p["offset"], p["length"]))
    for spans in held.values():
        spans.sort()
        assert [at for at, _ in spans] == [sum(n for _, n in spans[:i]) for i in range(len(spans))]
    assert sorted(window - sum(n for _, n in spans) for spans in held.values()) == plain_best_fit(sizes, window)
    assert sorted(held) == list(range(len(held)))


@pytest.mark.parametrize("window", [2048, 64])
def test_pieces_are_placed(docs_with_nulls, library, no_docs, window, monkeypatch):
    monkeypatch.setattr(windows, "CELL_ROWS", 20)  # several cells also on few rows
    docs, rows = docs_with_nulls
    pieces = windows.token_pieces(docs, windows.default_tokenizer(), window)
    places = windows.place_pieces(pieces, window)
    check_places(rows, places.collect(), library, window)
    again = windows.token_pieces(docs.repartition(7), windows.default_tokenizer(), window)
    assert sorted(map(repr, windows.place_pieces(again, window).collect())) == sorted(map(repr, places.collect()))
    assert windows.place_pieces(windows.token_pieces(no_docs, windows.default_tokenizer(), window), window).count() == 0


def test_sequences_hold_the_ids(docs_with_nulls, library):
    docs, rows = docs_with_nulls
    pieces = windows.token_pieces(docs, windows.default_tokenizer(), 256)
    places = windows.place_pieces(pieces, 256, with_ids=True).collect()
    packed = windows.packed_sequences(windows.place_pieces(pieces, 256, with_ids=True), 256, pad_id=7).collect()
    ids = {r["sequence_id"]: r["ids"] for r in packed}
    for p in places:
        assert ids[p["sequence_id"]][p["offset"]:p["offset"] + p["length"]] == p["ids"]
    for r in packed:
        used = r["n_tokens"]
        assert len(r["ids"]) == (used if used & (used - 1) == 0 else 256) and set(r["ids"][used:]) <= {7}
    assert sum(r["n_tokens"] for r in packed) == sum(len(library(t)) + 1 for _, t in rows)


def test_window_query(spark, library):
    rows = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()
    check_places(map(tuple, rows), QUERIES["op11_pack_best_fit"](spark, SF_DIR).collect(), library, 2048)


# 12 runs
def plain_runs(words):
    found = {}
    for q in range(1, len(words) // 4 + 1):
        i = 0
        while i + q < len(words):
            start = i
            while i + q < len(words) and words[i] == words[i + q]:
                i += 1
            if i > start and i + q - start >= max(6, 4 * q):
                found.setdefault((start, i + q), q)
            i += i == start
    return sorted((s, e - s, q) for (s, e), q in found.items())


def plain_collapsed(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def test_runs_of_random_words():
    seen = 0
    for seed in range(400):
        rng, texts = random.Random(seed), []
        for _ in range(rng.randint(1, 6)):
            k = rng.choice([1, 2, 3, 5])
            words = [b"%d" % rng.randrange(k) for _ in range(rng.randint(0, 60))]
            for _ in range(rng.randrange(4)):
                period = [b"%d" % rng.randrange(k) for _ in range(rng.randint(1, 9))]
                at, n = rng.randint(0, len(words)), rng.randint(3, 9)
                words[at:at] = (period * n)[:rng.randint(1, len(period) * n)]
            texts.append(words)
        wanted = [plain_runs(w) for w in texts]
        found = periodic.text_runs(texts)
        assert [list(map(tuple, runs.T.tolist())) for runs in found] == wanted
        for words, runs, plain in zip(texts, found, wanted):
            assert periodic.collapsed(words, runs).decode() == plain_collapsed([w.decode() for w in words], plain)
        seen += sum(map(len, wanted))
    assert seen > 500


def test_nonterminals_are_derived_where_they_stand():
    words = np.array([0, 1, 2] * 8 + [1] * 9 + [0, 1] * 7)
    _, symbols = np.unique(words, return_inverse=True)
    grammar = periodic.Grammar(symbols, np.zeros(len(symbols), "int64"))
    for node, at in zip(grammar.node, grammar.at):
        size = grammar.end[node] - grammar.start[node]
        assert (symbols[at:at + size] == symbols[grammar.start[node]:grammar.end[node]]).all()
        assert grammar.start[node] < grammar.middle[node] < grammar.end[node]
    # Between two words of the text there is the boundary of one derivation.
    places = grammar.at + (grammar.middle - grammar.start)[grammar.node]
    assert sorted(places) == list(range(1, len(symbols)))


@pytest.mark.parametrize("words, wanted", [
    ([b"a"] * 300_000, [(0, 300_000, 1)]), ([b"a", b"b"] * 100_000, [(0, 200_000, 2)]),
    ([b"%d" % i for i in range(3000)] * 50, [(0, 150_000, 3000)]), ([b"%d" % i for i in range(200_000)], [])])
def test_long_texts_end_soon(words, wanted):
    started = time.monotonic()
    assert list(map(tuple, periodic.text_runs([words])[0].T.tolist())) == wanted
    assert time.monotonic() - started < 20


def test_runs_of_odd_documents(docs_with_nulls, no_docs, monkeypatch):
    docs, rows = docs_with_nulls
    for batch in (periodic.BATCH_WORDS, 50):
        monkeypatch.setattr(periodic, "BATCH_WORDS", batch)
        got = periodic.periodic_runs(docs).collect()
        wanted = []
        for doc, text in rows:
            words = words_of(text)
            # The plain version is quadratic: the longest text has no repeated words in a row.
            runs = plain_runs(words) if len(words) < 12_000 else []
            wanted.append((doc, len(words), runs, plain_collapsed(words, runs)))
        assert sorted([(r[0], r[1], [tuple(x) for x in r[2]], r[3]) for r in got], key=repr) == sorted(wanted, key=repr)
    assert periodic.periodic_runs(no_docs).count() == 0


def test_run_query(spark):
    wanted = []
    for doc, text in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect():
        words = words_of(text)
        n, mark = len(words), zlib.crc32(str(doc).encode())
        if mark % 10 == 0 and n:
            g = mark // 10
            a = g % n
            p = 1 + math.floor((n - a) / (3 + g % 8))
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        runs = plain_runs(words)
        best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        wanted.append((doc, len(runs), *best, 1000 * best[1] // best[2] if runs else None,
                       sha("".join(f"{s},{m},{q}\n" for s, m, q in runs)), sha(plain_collapsed(words, runs))))
    assert sorted(map(tuple, QUERIES["op12_periodic_runs"](spark, SF_DIR).collect())) == sorted(wanted)


# 13 whitening
def plain_whitening(rows, most=16):
    """By vec_id and content: n, deviation, whitened components and their shares."""
    good = [(k, v) for k, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    lengths = Counter(len(v) for _, v in good)
    if not lengths:
        return [], None
    d = max(lengths, key=lambda n: (lengths[n], n))
    coded = [(k, [math.floor(64 * c) + 10 ** 6 for c in v]) for k, v in good if len(v) == d]
    fit = sorted({tuple(x) for _, x in coded})
    n, sums = len(fit), [sum(c) for c in zip(*fit)]
    centred = np.array([[n * c - s for c, s in zip(x, sums)] for x in fit], float) / n
    cov = centred.T @ centred / n
    e, u = np.linalg.eigh(cov)
    e, u = e[::-1], u[:, ::-1]
    k = min(most, int((e > 1e-12 * e[0]).sum())) if e[0] > 0 else 0
    u = u[:, :k] * np.where(u[np.abs(u[:, :k]).argmax(0), range(k)] < 0, -1, 1)
    out = []
    for key, x in coded:
        z = [n * c - s for c, s in zip(x, sums)]
        w = (np.array(z, float) / n) @ u / np.sqrt(e[:k])
        out += [(key, i + 1, n, sum(c * c for c in z), w[i], e[i] / np.trace(cov)) for i in range(k)]
    return out, n


def check_whitening(got, rows):
    wanted, n = plain_whitening(rows)
    order = lambda r: (r[0] is None, r[0] or 0, r[1], r[3] or 0, r[4])
    got, wanted = sorted(map(tuple, got), key=order), sorted(wanted, key=order)
    assert len(got) == len(wanted)
    for a, b in zip(got, wanted):
        assert a[:4] == b[:4]
        assert a[4] == pytest.approx(b[4], abs=1e-6) and a[5] == pytest.approx(b[5], rel=1e-6) and a[6] < 1e-6


SCHEMA = "vec_id long, embedding array<float>, x string, a string, copies string, index string, salt string"


def vector_frame(spark, rows, parts=3):
    return spark.createDataFrame([(k, v, *["y"] * 5) for k, v in rows], SCHEMA).repartition(parts)


def odd_vectors(seed=4):
    rng = random.Random(seed)
    base = [[float(np.float32(rng.gauss(0, 1) * (i + 1))) for i in range(5)] for _ in range(60)]
    rows = [(i, v) for i, v in enumerate(base)]
    rows += [(i, base[0]) for i in range(100, 140)] + [(None, base[1]), (None, base[1]), (3, base[2])]
    rows += [(200, None), (201, []), (202, [1.0, None, 1.0, 1.0, 1.0]), (203, [float("nan")] * 5),
             (204, [float("inf"), 0.0, 0.0, 0.0, 0.0]), (205, [1.0, 2.0])]
    return rows


def test_whitening_of_odd_vectors(spark, monkeypatch):
    rows = odd_vectors()
    check_whitening(whitening.whiten(vector_frame(spark, rows)).collect(), rows)
    # Many blocks and splits, and hot vectors looked up in copies.
    for name, value in (("BLOCK_BYTES", 5 * 8 * 7), ("SPLIT_BLOCKS", 2), ("HOT_ROWS", 4)):
        monkeypatch.setattr(whitening, name, value)
    check_whitening(whitening.whiten(vector_frame(spark, rows, 8)).collect(), rows)


def test_whitening_of_small_tables(spark):
    one = [1.0, 2.0, 3.0]
    for rows in ([], [(1, None)], [(1, one)], [(1, one), (2, one), (None, one)]):
        df = whitening.whiten(vector_frame(spark, rows, 1))
        assert df.columns == [c.split()[0] for c in whitening.RESULT.split(", ")] and df.count() == 0
    rows = [(1, one), (2, [1.0, 2.0, 4.0]), (3, [1.0, 2.0, 9.0]), (4, [1.0, 3.0, 9.0])]
    check_whitening(whitening.whiten(vector_frame(spark, rows)).collect(), rows)


def test_deviation_is_exact_and_wide(spark):
    rows = [(1, [3e6, 1.0]), (2, [-3e6, 2.0]), (3, [0.5, 7.0]), (4, [8.0, 8.0])]
    check_whitening(whitening.whiten(vector_frame(spark, rows)).collect(), rows)
    far = [(1, [3e38, 1.0]), (2, [-3e38, 2.0]), (3, [0.0, 3.0])]
    got = whitening.whiten(vector_frame(spark, far)).collect()
    assert {r["vec_id"] for r in got} == {1, 2, 3} and all(r["deviation"] is None for r in got if r["vec_id"] < 3)


def test_whitening_query(spark):
    rows = [(r[0], r[1]) for r in spark.read.parquet(f"{SF_DIR}/embeddings.parquet").select("vec_id", "embedding").collect()]
    check_whitening(QUERIES["op13_embedding_whitening"](spark, SF_DIR).collect(), rows)
