"""Secret scans: base patterns, and a character convolutional network over all other candidates.

Base findings are found by pattern (assign, access, hex). Every run of 12 or more key-like
characters is a candidate; the network sees all of it, in windows of ``INSIDE`` characters that overlap
by half, each with what stands before and after it, and the highest score counts. It is trained with
numpy on labelled windows: those that share ``MIN_OVERLAP`` characters or a whole base finding are
positive, those that touch none are negative. On held-out windows its scores are calibrated (Platt), and
the threshold is the highest that keeps ``MIN_RECALL`` of the held-out positives; the precision this
gives there is kept with the network. Candidates above it that no base finding overlaps are added as
``cnn``.

Every distinct labelled window of all documents takes part: a third of them, by hash, is held out, and the
others are dealt by hash into parts of about ``PART_WINDOWS``. In each epoch every part is one task that
trains a copy of the network on all its windows; the copies are averaged by their windows. Calibration and
threshold are sums and one rank over all held-out windows. Only networks and sums reach the driver. Scanning
covers every whole text, in Arrow batches, without a shuffle of texts.

Cases: a null or empty text has no findings; repeated rows are scanned alike; without a positive and
a negative held-out candidate nothing is trained and only base findings are returned; an empty table gives
an empty result; other columns are kept by ``redact_secrets`` and not read by ``scan_secrets``.
"""

from __future__ import annotations

import copy
import math
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skytally.llm.registry import read, register, ship
from skytally.session import cut_lineage

KINDS = ("assign", "access", "hex", "cnn")
PART_WINDOWS = 50_000
HELD_OUT = 3  # one window in so many
MIN_RECALL = 0.98
BEFORE, INSIDE, AFTER = 20, 36, 8
MIN_OVERLAP = 12
EMBED, WIDTH, FILTERS, EPOCHS, BATCH, RATE = 8, 5, 24, 8, 64, 0.01

ASSIGN = re.compile(
    r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A | re.I)
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
ACCESS = re.compile("AKIA[A-Z0-9]+")
HEX = re.compile("[0-9a-f]{24,}")
CANDIDATE = re.compile("(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{12,}")

Span = tuple[str, int, int]


def base_findings(text: str) -> list[Span]:
    """Findings by pattern, ordered by start, then kind."""
    found: list[Span] = []
    lower = text.lower()
    if any(word in lower for word in ASSIGN_WORDS):
        found += [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[1]) >= 6]
    found += [("access", *m.span()) for m in ACCESS.finditer(text) if len(m[0]) >= 20]
    found += [("hex", *m.span()) for m in HEX.finditer(text)]
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0])))


def candidates(text: str) -> list[tuple[int, int]]:
    return [m.span() for m in CANDIDATE.finditer(text)]


def covered(span: tuple[int, int], findings: list[Span]) -> bool:
    return any(start < span[1] and span[0] < end for _, start, end in findings)


def window(text: str, start: int, end: int) -> str:
    """The characters the network sees, padded to one length."""
    before = text[max(0, start - BEFORE):start].rjust(BEFORE, "\0")
    inside = text[start:min(end, start + INSIDE)].ljust(INSIDE, "\0")
    return before + inside + text[end:end + AFTER].ljust(AFTER, "\0")


def pieces(start: int, end: int) -> list[tuple[int, int]]:
    """Spans of INSIDE characters that cover a candidate, overlapping by half; the last ends with it."""
    if end - start <= INSIDE:
        return [(start, end)]
    return [(at, at + INSIDE) for at in (*range(start, end - INSIDE, INSIDE // 2), end - INSIDE)]


def label(span: tuple[int, int], findings: list[Span]) -> int | None:
    """1 for a window that holds a base finding or enough of one, 0 for one that touches none, else None."""
    shared = [(min(end, span[1]) - max(start, span[0]), end - start) for _, start, end in findings]
    if any(both >= min(MIN_OVERLAP, whole) for both, whole in shared):
        return 1
    return None if any(both > 0 for both, _ in shared) else 0


def encode(windows: list[str]) -> np.ndarray:
    """Character numbers, 1 to 95 for printable ASCII, 96 for others, 0 for padding."""
    codes = np.frombuffer("".join(windows).encode("utf-32-le", "surrogatepass"), "<u4").reshape(len(windows), -1)
    return np.where(codes == 0, 0, np.where((codes >= 32) & (codes < 127), codes - 31, 96)).astype(np.int16)


class Network:
    """Embedding, convolution, maximum over positions, logistic output."""

    def __init__(self, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.weights = {
            "embed": rng.normal(0, 0.3, (97, EMBED)), "filters": rng.normal(0, 0.2, (WIDTH * EMBED, FILTERS)),
            "bias": np.zeros(FILTERS), "out": rng.normal(0, 0.3, FILTERS), "out_bias": np.zeros(1)}
        self.first = {k: np.zeros_like(v) for k, v in self.weights.items()}
        self.second = {k: np.zeros_like(v) for k, v in self.weights.items()}
        self.scale, self.shift, self.threshold, self.precision = 1.0, 0.0, 1.1, 0.0

    def forward(self, x: np.ndarray):
        """Where each filter is highest, its value there if positive, and the logits.

        A character adds the same to a filter wherever it stands in the patch at one place, so that is looked up.
        """
        w, span = self.weights, x.shape[1] - WIDTH + 1
        adds = np.einsum("ce,kef->kcf", w["embed"], w["filters"].reshape(WIDTH, EMBED, FILTERS)).astype(np.float32)
        maps = adds[0].take(x[:, :span], axis=0)
        for k in range(1, WIDTH):
            maps += adds[k].take(x[:, k:k + span], axis=0)
        top = maps.argmax(axis=1)
        pooled = np.maximum(np.take_along_axis(maps, top[:, None, :], 1)[:, 0] + w["bias"], 0)
        return top, pooled, pooled @ w["out"] + w["out_bias"][0]

    def logits(self, x: np.ndarray) -> np.ndarray:
        return np.concatenate([self.forward(x[at:at + 64])[2] for at in range(0, len(x), 64)])

    def gradient(self, x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> dict[str, np.ndarray]:
        top, pooled, z = self.forward(x)
        d = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y) * weight / len(y)
        d_pool = d[:, None] * self.weights["out"] * (pooled > 0)
        # What reaches each character, filter and place in the patch.
        seen = [(np.take_along_axis(x, top + k, 1).astype(np.int64) * FILTERS + np.arange(FILTERS)).ravel() for k in range(WIDTH)]
        size = len(self.weights["embed"]) * FILTERS
        reach = np.stack([np.bincount(at, d_pool.ravel(), size).reshape(-1, FILTERS) for at in seen])
        filters = self.weights["filters"].reshape(WIDTH, EMBED, FILTERS)
        return {"out": pooled.T @ d, "out_bias": np.array([d.sum()]), "bias": d_pool.sum(0),
                "filters": (self.weights["embed"].T @ reach).reshape(WIDTH * EMBED, FILTERS),
                "embed": (reach @ filters.transpose(0, 2, 1)).sum(0)}

    def state(self) -> np.ndarray:
        """Weights and both moments of the optimiser, one after the other."""
        return np.concatenate([part[k].ravel() for part in (self.weights, self.first, self.second) for k in self.weights])

    def restore(self, state: np.ndarray) -> None:
        at = 0
        for part in (self.weights, self.first, self.second):
            for k, v in self.weights.items():
                part[k] = state[at:at + v.size].reshape(v.shape).copy()
                at += v.size

    def epoch(self, x: np.ndarray, y: np.ndarray, weight: np.ndarray, order: np.ndarray, step: int) -> int:
        """One pass of Adam over the windows in ``order``; returns the steps done so far."""
        for at in range(0, len(y), BATCH):
            pick = order[at:at + BATCH]
            step += 1
            for k, g in self.gradient(x[pick], y[pick], weight[pick]).items():
                self.first[k] = 0.9 * self.first[k] + 0.1 * g
                self.second[k] = 0.999 * self.second[k] + 0.001 * g * g
                self.weights[k] -= RATE * (self.first[k] / (1 - 0.9 ** step)) / (
                    np.sqrt(self.second[k] / (1 - 0.999 ** step)) + 1e-8)
        return step

    def train(self, x: np.ndarray, y: np.ndarray, seed: int = 11) -> None:
        rng = np.random.default_rng(seed)
        weight, step = class_weight(y, y.mean()), 0
        for _ in range(EPOCHS):
            step = self.epoch(x, y, weight, rng.permutation(len(y)), step)

    def calibrate(self, x: np.ndarray, y: np.ndarray) -> None:
        """Platt scaling, then the highest threshold with the recall asked for."""
        z = self.logits(x)
        n, p = y.sum(), len(y) - y.sum()
        target = np.where(y == 1, (n + 1) / (n + 2), 1 / (p + 2))
        for _ in range(500):
            error = 1 / (1 + np.exp(-np.clip(self.scale * z + self.shift, -30, 30))) - target
            self.scale -= 0.05 * float((error * z).mean())
            self.shift -= 0.05 * float(error.mean())
        score = self.probability(x)
        positive = np.sort(score[y == 1])
        self.threshold = float(positive[int(np.floor((1 - MIN_RECALL) * len(positive)))])
        self.precision = float(y[score >= self.threshold].mean())

    def calibrated(self, z: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.scale * z + self.shift, -30, 30)))

    def probability(self, x: np.ndarray) -> np.ndarray:
        return self.calibrated(self.logits(x))


def class_weight(y: np.ndarray, share: float) -> np.ndarray:
    """Weights that give both classes, of which ``share`` is positive, the same sum."""
    return np.where(y == 1, 0.5 / max(share, 1e-6), 0.5 / max(1 - share, 1e-6))


def fit(rows: list[tuple[str, int]]) -> Network | None:
    """A trained, calibrated network on (window, label) rows held by the caller; a third is held out."""
    if not rows:
        return None
    x, y = encode([w for w, _ in rows]), np.array([label for _, label in rows], float)
    held = np.arange(len(y)) % 3 == 2
    if any(len(set(y[part])) < 2 for part in (held, ~held)):
        return None
    network = Network()
    network.train(x[~held], y[~held])
    network.calibrate(x[held], y[held])
    return network


def findings(texts: list[str], network: Network | None) -> list[list[Span]]:
    """All findings of each text, ordered by start, then kind."""
    found = [base_findings(text) for text in texts]
    if network is None:
        return found
    free = [(k, span) for k, text in enumerate(texts) for span in candidates(text) if not covered(span, found[k])]
    seen = [(owner, k, part) for owner, (k, span) in enumerate(free) for part in pieces(*span)]
    sure: set[int] = set()
    for at in range(0, len(seen), 4096):
        part = seen[at:at + 4096]
        scores = network.probability(encode([window(texts[k], *span) for _, k, span in part]))
        sure.update(owner for (owner, _, _), score in zip(part, scores) if score >= network.threshold)
    for owner in sorted(sure):
        k, span = free[owner]
        found[k].append(("cnn", *span))
    return [sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]))) for spans in found]


def _texts(batch: pa.RecordBatch, step: int = 500) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    for at in range(0, batch.num_rows, step):
        part = batch.slice(at, step)
        yield part, [t or "" for t in part.column("text").to_pylist()]


def _labelled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The labelled windows of the texts, each once in a batch."""
    for batch in batches:
        for _, texts in _texts(batch):
            found: dict[tuple[str, int], None] = {}
            for t in texts:
                base = base_findings(t)
                for span in (p for c in candidates(t) for p in pieces(*c)):
                    y = label(span, base)
                    if y is not None:
                        found[window(t, *span), y] = None
            yield pa.RecordBatch.from_arrays(
                [pa.array([w for w, _ in found], pa.string()), pa.array([y for _, y in found], pa.int32())],
                names=["seen", "label"])


def labelled_windows(docs: DataFrame, text: str = "text") -> DataFrame:
    """Every distinct labelled window of the documents, with its hash."""
    ship(docs.sparkSession)
    found = docs.select(F.col(f"`{text}`").alias("text")).mapInArrow(_labelled, "seen string, label int").distinct()
    return cut_lineage(found.withColumn("place", F.xxhash64("seen")))


def train_parts(windows: DataFrame, count: int, share: float) -> Network:
    """A network trained on all ``count`` rows: per epoch, the mean of the copies trained by the parts."""
    parts = math.ceil(count / PART_WINDOWS)
    # Other bits of the hash than those that hold windows out.
    dealt = windows.withColumn("part", F.pmod(F.shiftright("place", 20), F.lit(parts)).cast("int"))
    kept = dealt.repartition(parts, "part").persist()
    network, steps = Network(), {}
    try:
        for number in range(EPOCHS):
            def run(rows: pd.DataFrame) -> pd.DataFrame:  # done with when this epoch's copies are collected
                rows, part = rows.sort_values(["place", "seen", "label"]), int(rows["part"].iloc[0])
                x, y = encode(rows["seen"].tolist()), rows["label"].to_numpy(float)
                order = np.random.default_rng((11, number, part)).permutation(len(y))
                own = copy.deepcopy(network)  # a task can hold several parts
                done = own.epoch(x, y, class_weight(y, share), order, steps.get(part, 0))
                return pd.DataFrame([(part, len(y), done, own.state().tobytes())], columns=["part", "n", "done", "state"])

            copies = sorted(kept.groupBy("part").applyInPandas(run, "part int, n long, done int, state binary").collect())
            states = np.stack([np.frombuffer(bytes(c["state"])) for c in copies])
            network.restore(np.average(states, axis=0, weights=[c["n"] for c in copies]))
            steps = {c["part"]: c["done"] for c in copies}
    finally:
        kept.unpersist()
    return network


def calibrate_parts(network: Network, held: DataFrame, positive: int, negative: int) -> None:
    """Platt scaling by Newton steps over sums, then the threshold by the rank of the scores, of all held-out rows."""

    def score(batches):
        for batch in batches:
            if batch.num_rows:
                z = network.logits(encode(batch.column("seen").to_pylist()))
                yield pa.RecordBatch.from_arrays([batch.column("label"), pa.array(z, pa.float64())], names=["label", "z"])

    scored = cut_lineage(held.mapInArrow(score, "label int, z double"))
    y, z = F.col("label") == 1, F.col("z")
    target = F.when(y, (positive + 1) / (positive + 2)).otherwise(1 / (negative + 2))

    def sums(scale: float, shift: float) -> tuple[float, ...]:
        at = scale * z + shift
        p = 1 / (1 + F.exp(-at))
        loss = F.greatest(at, F.lit(0.0)) - target * at + F.log1p(F.exp(-F.abs(at)))
        error, curve = p - target, p * (1 - p)
        return tuple(scored.agg(*[F.avg(c) for c in (loss, error * z, error, curve * z * z, curve * z, curve)]).first())

    here = sums(network.scale, network.shift)
    for _ in range(20):
        _, g_scale, g_shift, h_scale, h_both, h_shift = here
        hessian = np.array([[h_scale, h_both], [h_both, h_shift]]) + 1e-9 * np.eye(2)
        move, size = np.linalg.solve(hessian, [g_scale, g_shift]), 1.0
        there = sums(network.scale - move[0], network.shift - move[1])
        while there[0] > here[0] and size > 1e-3:
            size /= 2
            there = sums(network.scale - size * move[0], network.shift - size * move[1])
        if there[0] > here[0] - 1e-9:
            break
        network.scale, network.shift = float(network.scale - size * move[0]), float(network.shift - size * move[1])
        here = there
    rank = int(np.floor((1 - MIN_RECALL) * positive))
    lowest = scored.filter(y).select("z").orderBy("z").rdd.zipWithIndex().filter(lambda r: r[1] == rank).first()[0]["z"]
    network.threshold = float(network.calibrated(np.array([lowest]))[0])
    network.precision = float(scored.filter(z >= lowest).agg(F.avg("label")).first()[0])


def train(docs: DataFrame, key: str = "doc_id", text: str = "text") -> Network | None:
    """Fit the network on the labelled windows of all ``docs``."""
    windows = labelled_windows(docs, text)
    held = F.pmod("place", F.lit(HELD_OUT)) == HELD_OUT - 1
    counts = {(r["held"], r["label"]): r["count"] for r in windows.groupBy(held.alias("held"), "label").count().collect()}
    if len(counts) < 4:
        return None
    count = counts[False, 0] + counts[False, 1]
    network = train_parts(windows.filter(~held), count, counts[False, 1] / count)
    calibrate_parts(network, windows.filter(held), counts[True, 1], counts[True, 0])
    return network


def scan_secrets(docs: DataFrame, network: Network | None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id and ``spans`` (kind, start, end) of every document."""
    ship(docs.sparkSession)
    rows = docs.select(F.col(f"`{key}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    item = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())])

    def scan(batches):
        for batch in batches:
            for part, texts in _texts(batch):
                spans = [[dict(zip(("kind", "start", "end"), s)) for s in found] for found in findings(texts, network)]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(spans, pa.list_(item))], names=["doc_id", "spans"])

    return rows.mapInArrow(scan, "doc_id long, spans array<struct<kind:string,start:int,end:int>>")


def masked(text: str, spans: list[Span], mask: str) -> str:
    """``text`` with each finding, or run of overlapping ones, replaced."""
    out, at = [], 0
    for _, start, end in spans:
        if start >= at:
            out += [text[at:start], mask]
        at = max(at, end)
    return "".join([*out, text[at:]])


def redact_secrets(docs: DataFrame, network: Network | None, text: str = "text", mask: str = "<secret>") -> DataFrame:
    """The documents with their findings masked; all columns and rows stay."""
    ship(docs.sparkSession)

    def redact(texts: pd.Series) -> pd.Series:
        found = findings([t or "" for t in texts], network)
        return pd.Series([None if t is None else masked(t, s, mask) for t, s in zip(texts, found)], dtype=object)

    return docs.withColumn(text, F.pandas_udf(redact, "string", F.PandasUDFType.SCALAR)(F.col(f"`{text}`")))


@register("op7_secret_cnn")
def op7_secret_cnn(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    found = scan_secrets(docs, train(docs))
    of = lambda *kinds: F.filter("spans", lambda s: s["kind"].isin(*kinds))
    text = lambda spans: F.array_join(F.transform(
        spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    return found.select(
        "doc_id", *[F.size(of(k)).cast("long").alias(f"n_{k}") for k in KINDS[:3]],
        F.sha2(text(of(*KINDS[:3])), 256).alias("base_sha256"), text(F.col("spans")).alias("spans"))
