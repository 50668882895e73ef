"""Quality scores by a factorisation machine.

Features of a whole text: its words, hashed; statistics of its structure; and its length. Each has a
weight and a short vector, and each pair of features adds the product of their vectors. The sum over
all pairs is half of the square of the sums less the sum of the squares, so a score takes one pass
over a document's features. Labels, language, source and ids are no features.

The model is fitted on at most ``TRAIN_ROWS`` labelled documents, those whose doc_id hashes lowest
(a documented bound; its features are what the driver gathers), and has a fixed size: ``BUCKETS``
words and ``RANK`` numbers each. Every document is scored, with the model broadcast.

Nulls and odd inputs: a null or empty text has only its statistics and gets a score. Labels without
a doc_id or a quality are left out, repeated labels of a document are averaged, and of rows with one
doc_id one is learned, the one whose features come first. Without labels of both kinds the score is the share of
good labels, 0.5 without any. A null doc_id counts as held out. An empty table gives an empty
result. Columns besides doc_id and text are ignored.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martwright.llm.common import release, rows_of, small, texts

BUCKET_BITS = 17
BUCKETS = 1 << BUCKET_BITS
RANK = 6
TRAIN_ROWS = 12_000
EPOCHS = 8
BATCH = 128
RATE = 0.05
DECAY = 1e-5
THRESHOLD = 0.3
FOLDS = 5
CACHED_WORDS = 100_000
LETTERS = np.array([chr(i).isalpha() for i in range(128)] + [True] * 128)
KINDS = {
    "upper": np.array([65 <= i <= 90 for i in range(256)]),
    "digit": np.array([48 <= i <= 57 for i in range(256)]),
    "stop": np.array([chr(i) in ".!?" for i in range(256)]),
    "comma": np.array([chr(i) in ",;:" for i in range(256)]),
    "shout": np.array([chr(i) in "!" for i in range(256)]),
    "bar": np.array([chr(i) in "|<>{}[]\\/=_" for i in range(256)]),
    "symbol": np.array([chr(i) in "#$%&*+@^~`" for i in range(256)]),
    "line": np.array([i == 10 for i in range(256)]),
    "other": np.array([i > 127 for i in range(256)]),
}
STATISTICS = 18


@lru_cache(maxsize=CACHED_WORDS)
def bucket(word: str) -> int:
    return zlib.crc32(word.encode("utf-8", "replace")) & BUCKETS - 1


def features(text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets and weights of the words (weights have length one), and the statistics."""
    data = np.frombuffer(text.encode("utf-8", "replace"), np.uint8)
    counts = np.bincount(data, minlength=256)
    size, words = max(1, len(data)), text.split()
    tally, n = Counter(words), max(1, len(words))
    lines = [x for x in text.split("\n") if x]
    repeated = 1 - len(set(lines)) / len(lines) if lines else 0.0
    often = max(tally.values(), default=0) / n
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    shares = [counts[k].sum() / size for k in KINDS.values()]
    long = float((lengths > 15).mean()) if len(words) else 0.0
    stats = np.array(
        [np.log1p(len(text)), np.log1p(len(words)), len(tally) / n, often, repeated, np.log1p(len(lines)), lengths.mean() if len(words) else 0.0, long, counts[LETTERS].sum() / size, *shares],
        np.float32,
    )
    values = np.sqrt(np.fromiter(tally.values(), np.float32, len(tally)))
    at = np.fromiter(map(bucket, tally), np.int32, len(tally))
    return at, values / max(1e-6, float(np.sqrt((values * values).sum()))), stats


@dataclass
class Machine:
    """Weights and vectors of words and statistics; the statistics' scale."""

    bias: float = 0.0
    mean: np.ndarray = field(default_factory=lambda: np.zeros(STATISTICS, np.float32))
    spread: np.ndarray = field(default_factory=lambda: np.ones(STATISTICS, np.float32))
    weights: np.ndarray = field(default_factory=lambda: np.zeros(BUCKETS + STATISTICS, np.float32))
    vectors: np.ndarray = field(default_factory=lambda: np.zeros((BUCKETS + STATISTICS, RANK), np.float32))

    def row(self, at: np.ndarray, values: np.ndarray, stats: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """One sparse row: words, then scaled statistics."""
        scaled = np.clip((stats - self.mean) / self.spread, -4, 4) / 4
        return np.concatenate((at, np.arange(BUCKETS, BUCKETS + STATISTICS))), np.concatenate((values, scaled)).astype(np.float32)

    def margin(self, at: np.ndarray, x: np.ndarray) -> float:
        own = self.vectors[at] * x[:, None]
        total = own.sum(axis=0)
        return float(self.bias + self.weights[at] @ x + 0.5 * (total @ total - (own * own).sum()))

    def score(self, text: str) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.margin(*self.row(*features(text))), -30, 30))))


def train(rows: list[tuple[np.ndarray, np.ndarray, np.ndarray]], labels: np.ndarray, seed: int = 7) -> Machine:
    """Logistic loss, in small batches, with steps that shrink for frequent features."""
    machine, random = Machine(), np.random.default_rng(seed)
    if not len(labels):
        return machine
    good = float(labels.mean())
    machine.bias = float(np.log(good / (1 - good))) if 0 < good < 1 else 30.0 * (good > 0.5) - 30.0 * (good < 0.5)
    if not 0 < good < 1:
        return machine
    stats = np.array([s for _, _, s in rows])
    machine.mean, machine.spread = stats.mean(axis=0), stats.std(axis=0) + 1e-6
    machine.vectors = random.normal(0, 0.05, machine.vectors.shape).astype(np.float32)
    sparse = [machine.row(*r) for r in rows]
    seen_w, seen_v = np.full(len(machine.weights), 1e-2, np.float32), np.full(machine.vectors.shape, 1e-2, np.float32)
    for _ in range(EPOCHS):
        order = random.permutation(len(sparse))
        for begin in range(0, len(order), BATCH):
            chosen = [sparse[i] for i in order[begin : begin + BATCH]]
            at, x = (np.concatenate(c) for c in zip(*chosen, strict=True))
            sizes = np.array([len(a) for a, _ in chosen])
            starts, of = np.cumsum(sizes) - sizes, np.repeat(np.arange(len(chosen)), sizes)
            vectors = machine.vectors[at]
            own = vectors * x[:, None]
            total = np.add.reduceat(own, starts)
            margin = machine.bias + np.add.reduceat(machine.weights[at] * x, starts)
            margin += 0.5 * ((total * total).sum(axis=1) - np.add.reduceat((own * own).sum(axis=1), starts))
            wrong = 1 / (1 + np.exp(-np.clip(margin, -30, 30))) - labels[order[begin : begin + BATCH]]
            machine.bias -= RATE * 0.1 * float(wrong.mean())
            push = (wrong[of] * x).astype(np.float32)
            kinds, slot = np.unique(at, return_inverse=True)
            step_w = np.bincount(slot, push, len(kinds)).astype(np.float32) + DECAY * machine.weights[kinds]
            pull = push[:, None] * (total[of] - own)
            step_v = np.stack([np.bincount(slot, pull[:, k], len(kinds)) for k in range(RANK)], axis=1).astype(np.float32) + DECAY * machine.vectors[kinds]
            seen_w[kinds] += step_w * step_w
            seen_v[kinds] += step_v * step_v
            machine.weights[kinds] -= RATE * 4 * step_w / np.sqrt(seen_w[kinds])
            machine.vectors[kinds] -= RATE * step_v / np.sqrt(seen_v[kinds])
    return machine


def held_out(doc_id: str = "doc_id") -> Column:
    """The fold that is never learned from."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % FOLDS == 0


def fit(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> Machine:
    """A machine from at most ``rows`` labelled documents outside the held-out fold."""
    docs = texts(docs)
    known = labels.select(F.col("doc_id").cast("long").alias("label_id"), F.col("quality").cast("double").alias("quality"))
    known = known.where(~held_out("label_id")).groupBy("label_id").agg(F.avg("quality").alias("quality"))
    known = known.where("quality is not null").orderBy(F.xxhash64("label_id"), "label_id").limit(rows)

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [features(t) for (t,) in rows_of(batch, "text")]
            columns = [pa.array([f[i].tobytes() for f in found], pa.binary()) for i in range(3)]
            names = ["doc_id", "quality", "at", "x", "stats"]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("quality"), *columns], names)

    sample = docs.join(F.broadcast(known), docs["doc_id"] == known["label_id"]).select("doc_id", "text", "quality")
    parts = ("at", "x", "stats", "quality")
    sample = sample.mapInArrow(extract, "doc_id long, quality double, at binary, x binary, stats binary")
    found = sample.groupBy("doc_id").agg(F.min(F.struct(*parts)).alias("f")).select("doc_id", "f.*").toPandas().sort_values("doc_id")
    kinds = (np.int32, np.float32, np.float32)
    rows_of_features = [tuple(map(np.frombuffer, r, kinds)) for r in zip(found["at"], found["x"], found["stats"], strict=True)]
    return train(rows_of_features, found["quality"].to_numpy(np.float64))


def scores(docs: DataFrame, machine: Machine) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(machine)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [shared.value.score(t) for (t,) in rows_of(batch, "text")]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found, pa.float64())], ["doc_id", "score"])
        bucket.cache_clear()
        release()

    scored = texts(docs).mapInArrow(run, "doc_id long, score double")
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, machine: Machine) -> DataFrame:
    """The rows whose text scores at least the threshold; all columns are kept."""
    shared, text = docs.sparkSession.sparkContext.broadcast(machine), docs.columns.index(docs.select("text").columns[0])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches):
            good = [shared.value.score(t or "") >= THRESHOLD for t in batch.column(text).to_pylist()]
            yield batch.filter(pa.array(good, pa.bool_()))
        bucket.cache_clear()
        release()

    return docs.mapInArrow(run, docs.schema)
