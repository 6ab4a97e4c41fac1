"""Quality classifier by supervised subword embeddings.

A text is a bag of hashed features: its words, the character n-grams of its bytes, and the
ordered pairs of words up to ``BACK`` words apart, whatever their distance. Every feature has a
learned vector; a document is the mean of its vectors, and a softmax layer turns the mean into
class probabilities. Vectors and layer are trained together by numpy stochastic gradient
descent on a bounded sample of labelled rows (``SAMPLE_ROWS``, half of each class, taken
in the order of a hash of the key). The class shares of all training labels then correct
the balanced sample's output.

Scoring reads whole texts. The layer is linear in the mean, so the model is folded into
one weight per feature before it is sent to the executors (``BUCKETS`` numbers).

Null and empty texts have no features and get the prior score. Labels that are null or
not 0 or 1 are ignored; repeated labels count as often as they occur. Without labels of
both classes every score is the smoothed share of label 1. Equal texts have equal scores, repeated
rows are scored each, an empty table gives an empty one. Of further columns, one named like
the score is replaced by it.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dossier.llm.common import BASE, BYTE_CODE, text_bytes, word_hashes, words_of

BUCKET_BITS = 16
BUCKETS = 1 << BUCKET_BITS
NGRAMS = (4,)
BACK = 4
PAIR = np.uint64(0x9E3779B97F4A7C15)
SAMPLE_ROWS = 4000
DIMENSIONS = 12
EPOCHS = 4
RATE = 0.6


def _bucket(h: np.ndarray) -> np.ndarray:
    return (h * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(64 - BUCKET_BITS)


def features(raw: np.ndarray) -> np.ndarray:
    """Feature numbers of one text, one for every occurrence."""
    if not len(raw):
        return np.empty(0, np.uint64)
    code = BYTE_CODE[raw]
    parts = []
    for n in NGRAMS:
        if len(raw) >= n:
            total = code[:len(raw) - n + 1].copy()
            for i in range(1, n):
                total *= BASE
                total += code[i:len(raw) - n + 1 + i]
            parts.append(_bucket(total + np.uint64(n)))
    words = word_hashes(raw, *words_of(raw))
    if len(words):
        parts.append(_bucket(words))
        for back in range(1, min(BACK, len(words) - 1) + 1):
            parts.append(_bucket(words[:-back] * PAIR + words[back:]))
    return np.concatenate(parts) if parts else np.empty(0, np.uint64)


@dataclass
class QualityModel:
    """Feature vectors, output layer and the correction for class shares."""

    vectors: np.ndarray
    layer: np.ndarray
    shift: float
    prior: float

    def folded(self) -> np.ndarray:
        """Log-odds of label 1 that each feature adds to the mean."""
        return (self.vectors @ (self.layer[1] - self.layer[0])).astype(np.float64)


def fit_arrays(samples: list[tuple[np.ndarray, np.ndarray, int]], share: float, seed: int = 7) -> QualityModel:
    """Train on (distinct features, their counts, label); ``share`` is the share of label 1 in all training labels."""
    rng = np.random.default_rng(seed)
    vectors = rng.uniform(-1 / DIMENSIONS, 1 / DIMENSIONS, (BUCKETS, DIMENSIONS)).astype(np.float32)
    layer = np.zeros((2, DIMENSIONS), dtype=np.float32)
    layer[1] = rng.uniform(-0.5, 0.5, DIMENSIONS)
    bags = []
    for ids, counts, label in samples:
        if len(ids):
            bags.append((ids.astype(np.int32), (counts / counts.sum()).astype(np.float32), label))
    steps, done = max(1, EPOCHS * len(bags)), 0
    for _ in range(EPOCHS):
        for at in rng.permutation(len(bags)):
            ids, weight, label = bags[at]
            rate = RATE * (1 - done / steps)
            done += 1
            mean = weight @ vectors[ids]
            out = layer @ mean
            out = np.exp(out - out.max())
            gradient = out / out.sum()
            gradient[label] -= 1
            back = gradient @ layer
            layer -= rate * np.outer(gradient, mean)
            # The mean divides the step among thousands of features; scaling it back keeps them moving.
            vectors[ids] -= (rate * 20 * weight)[:, None] * back
    labels = np.array([label for _, _, label in samples])
    balance = (labels.sum() + 1) / (len(labels) + 2) if len(labels) else share
    shift = np.log(share / (1 - share)) - np.log(balance / (1 - balance))
    return QualityModel(vectors, layer, float(shift), share)


def fit(documents: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id", label: str = "quality",
        sample_rows: int = SAMPLE_ROWS) -> QualityModel:
    """Fit on the labelled documents. ``labels`` should hold training rows only.

    A document sends its distinct features and their counts, at most ``BUCKETS`` of each, however long it is.
    """
    known = labels.select(F.col(key).alias("k"), F.col(label).cast("int").alias("y")).filter("k is not null and y in (0, 1)")
    counts = {r["y"]: r["n"] for r in known.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    total = sum(counts.values())
    share = (counts.get(1, 0) + 1) / (total + 2)
    half = sample_rows // 2
    order = [F.xxhash64(F.col("k").cast("string")), F.col("k")]
    chosen = None
    for y in (0, 1):
        some = known.filter(F.col("y") == y).orderBy(*order).limit(half)
        chosen = some if chosen is None else chosen.unionByName(some)
    if len(counts) < 2:
        return QualityModel(np.zeros((BUCKETS, DIMENSIONS), np.float32), np.zeros((2, DIMENSIONS), np.float32),
                            float(np.log(share / (1 - share))), share)
    # At most sample_rows keys are broadcast.
    texts = documents.select(F.col(key).alias("k"), F.col(text).alias("t"))
    joined = texts.join(F.broadcast(chosen), "k").select("k", "y", "t")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [np.unique(features(raw), return_counts=True) for raw in text_bytes(batch.column("t"))]
            ids = pa.array([f.astype("<u2").tobytes() for f, _ in found], pa.binary())
            counts = pa.array([n.astype("<u4").tobytes() for _, n in found], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("k"), batch.column("y"), ids, counts], ["k", "y", "f", "n"])

    schema = T.StructType([joined.schema["k"], joined.schema["y"], T.StructField("f", T.BinaryType()), T.StructField("n", T.BinaryType())])
    rows = joined.mapInArrow(run, schema).toLocalIterator()
    samples = sorted(((r["k"], r["y"], bytes(r["f"]), bytes(r["n"])) for r in rows))
    return fit_arrays([(np.frombuffer(f, "<u2"), np.frombuffer(n, "<u4"), y) for _, y, f, n in samples], share)


def score(documents: DataFrame, model: QualityModel, text: str = "text", keep: list[str] | None = None,
          out: str = "score") -> DataFrame:
    """Columns ``keep`` (all but ``out`` by default) and the probability of label 1."""
    keep = [c for c in documents.columns if c != out] if keep is None else keep
    weights, shift = model.folded(), model.shift

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = np.empty(batch.num_rows)
            for i, raw in enumerate(text_bytes(batch.column(text))):
                found = features(raw)
                scores[i] = shift + (weights[found].mean() if len(found) else 0.0)
            scores = 1 / (1 + np.exp(-np.clip(scores, -60, 60)))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), pa.array(scores)], [*keep, out])

    schema = T.StructType([documents.schema[c] for c in keep] + [T.StructField(out, T.DoubleType())])
    return documents.select(*dict.fromkeys([*keep, text])).mapInArrow(run, schema)


def held_out(key: str = "doc_id"):
    """Whether a row belongs to the fold that no model sees."""
    return F.crc32(F.col(key).cast("string").cast("binary")) % 5 == 0
