"""Toxicity by logistic regression, trained with the FTRL-proximal rule on hashed word n-grams and skip-grams.

Features of a text are the distinct hashes of its words, of pairs of neighbours and of pairs with one word between, in
2^20 slots. FTRL-proximal keeps a rate per coordinate and sets weights that the L1 term outweighs to exactly zero, so the
trained model is a few thousand (slot, weight) pairs, which are broadcast.

Training: about `SAMPLE_DOCS` labelled rows, drawn by a hash of the id and each read whole; ids are drawn from the narrow
label table first, so the texts of all other rows are never moved. Features are made in the tasks; the updates, which are
sequential by nature, run in one task over that bounded sample. Scoring reads every text once and shuffles nothing.

Defined cases: a null or empty text has no feature and scores the bias alone; rows with a null id or a null label are not
learned from; a repeated id in either table gives a training row for each
different label and text; without any training row every score is 0.5;
further columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SLOTS = 1 << 20
SAMPLE_DOCS = 20_000
SAMPLE_BOUND = 2  # times SAMPLE_DOCS, whatever the draw gives
EPOCHS = 4
ALPHA, BETA, L1, L2 = 1.0, 1.0, 12.0, 0.1
POSITIVE_WEIGHT = 3.0
KNOWN_WORDS = 300_000
SEED = 6
WORDS = re.compile(r"[^\W\d_]+")


class WordHashes(dict):
    """Word -> 32-bit hash, remembered up to a bound."""

    def __missing__(self, word: str) -> int:
        if len(self) >= KNOWN_WORDS:
            self.clear()
        value = self[word] = zlib.crc32(word.encode())
        return value


def features(text: str, hashes: WordHashes, slots: int = SLOTS) -> np.ndarray:
    """The distinct slots of a text."""
    words = WORDS.findall(text.lower())
    h = np.fromiter(map(hashes.__getitem__, words), dtype=np.uint64, count=len(words))
    pairs = h[:-1] * np.uint64(0x9E3779B97F4A7C15) + h[1:]
    skips = h[:-2] * np.uint64(0xC2B2AE3D27D4EB4F) + h[2:] + np.uint64(1)
    mixed = np.concatenate([h, pairs, skips]) * np.uint64(0xD6E8FEB86659FD93)
    return np.unique((mixed >> np.uint64(40)) % np.uint64(slots)).astype(np.int64)


@dataclass
class Ftrl:
    """FTRL-proximal state over `slots` coordinates; the last coordinate is the bias, free of L1."""

    slots: int = SLOTS
    alpha: float = ALPHA
    beta: float = BETA
    l1: float = L1
    l2: float = L2

    def __post_init__(self):
        self.z, self.n = np.zeros(self.slots + 1), np.zeros(self.slots + 1)

    def weights(self, at: np.ndarray) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        l1 = np.where(at == self.slots, 0.0, self.l1)
        rate = (self.beta + np.sqrt(n)) / self.alpha + self.l2
        return np.where(np.abs(z) <= l1, 0.0, -(z - np.sign(z) * l1) / rate)

    def update(self, at: np.ndarray, label: int) -> None:
        """One example with binary features `at` (the bias is added here)."""
        at = np.append(at, self.slots)
        w = self.weights(at)
        g = (_sigmoid(w.sum()) - label) * (POSITIVE_WEIGHT if label else 1.0)
        n = self.n[at]
        self.z[at] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / self.alpha * w
        self.n[at] = n + g * g

    def model(self) -> tuple[np.ndarray, np.ndarray, float]:
        every = self.weights(np.arange(self.slots + 1))
        used = np.flatnonzero(every[:-1])
        return used, every[used], float(every[-1])


def _sigmoid(x):
    return 1.0 / (1.0 + np.exp(-np.clip(x, -500, 500)))


def learnable(id_col: Column) -> Column:
    """The rows whose labels may be learned from; null for a null id."""
    return F.crc32(id_col.cast("string")) % 5 != 0


def train(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    sample_docs: int = SAMPLE_DOCS,
    epochs: int = EPOCHS,
) -> tuple[np.ndarray, np.ndarray, float]:
    """(slots, weights, bias) from a bounded sample of the labelled rows that `learnable` admits."""
    known = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label")).filter(
        learnable(F.col("id")) & F.col("label").isNotNull()
    )
    n = known.count()
    draw = F.pmod(F.xxhash64(F.lit(SEED), F.col("id")), F.lit(1 << 30)) / float(1 << 30)
    sample = known.filter(draw < min(1.0, sample_docs / max(n, 1))).distinct().limit(SAMPLE_BOUND * sample_docs)
    texts = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    # The sample holds about sample_docs narrow rows whatever the size of the tables, so broadcasting it is bounded.
    # Documents that repeat an id multiply its label; rows that repeat id and text count once.
    examples = texts.join(F.broadcast(sample), "id").select("id", "text", "label")

    def featurise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            slots = [features(t, hashes).astype(np.int32) for t in batch.column(1).to_pylist()]
            columns = [batch.column(0), batch.column(2), pa.array(slots, pa.list_(pa.int32()))]
            yield pa.RecordBatch.from_arrays(columns, ["id", "label", "slots"])

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [
            (label, at.values.to_numpy().astype(np.int64))
            for batch in batches
            for label, at in zip(batch.column(1).to_pylist(), batch.column(2))
        ]
        ftrl, order = Ftrl(), np.random.default_rng(SEED)
        for _ in range(epochs):
            for i in order.permutation(len(rows)):
                ftrl.update(rows[i][1], rows[i][0])
        used, weights, bias = ftrl.model()
        used, weights = np.append(used, SLOTS), np.append(weights, bias)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(weights)], ["slot", "weight"])

    made = examples.mapInArrow(featurise, T.StructType([examples.schema["id"], T.StructField("label", T.IntegerType()), T.StructField("slots", T.ArrayType(T.IntegerType()))]))
    bounded = made.dropDuplicates(["id", "label", "slots"]).limit(SAMPLE_BOUND * sample_docs)
    ordered = bounded.repartition(1).sortWithinPartitions("id", "label", F.xxhash64("slots"))
    model = ordered.mapInArrow(learn, "slot long, weight double").toPandas().sort_values("slot")
    slots, weights = model["slot"].to_numpy(np.int64), model["weight"].to_numpy(np.float64)
    return slots[:-1], weights[:-1], float(weights[-1]) if len(weights) else 0.0


def score(
    docs: DataFrame,
    model: tuple[np.ndarray, np.ndarray, float],
    text_col: str = "text",
    carry: list[str] | None = None,
) -> DataFrame:
    """(whole, score): `whole` is a struct of the columns `carry` (default: all); score is the chance of label 1."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    packed = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in carry or docs.columns]).alias("whole"),
        F.coalesce(F.col(text_col), F.lit("")).alias("body"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        used, weights, bias = shared.value
        dense, hashes = np.zeros(SLOTS), WordHashes()
        dense[used] = weights
        for batch in batches:
            sums = [dense[features(t.as_py(), hashes)].sum() + bias for t in batch.column(1)]
            scores = pa.array(_sigmoid(np.array(sums, dtype=np.float64)))
            yield pa.RecordBatch.from_arrays([batch.column(0), scores], ["whole", "score"])

    return packed.mapInArrow(run, T.StructType([packed.schema["whole"], T.StructField("score", T.DoubleType())]))
