"""Quality as a logistic regression over hashed word n-grams, trained by FTRL-proximal.

A text becomes counts of hashed runs of one and two words. Labelled rows train several
replicas, each in a task of its own, whose weights are averaged; a score is a sparse dot
product with the broadcast weights.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gitloom.llm.common import extended, small_batches, with_columns, without
from gitloom.llm.labelled import held_out, training_sample

#: Labelled rows that are used at most (about), and rows of one replica.
MAX_TRAINING_ROWS = 16_384
REPLICA_ROWS = 2048
#: Weights of the model: fixed, so the broadcast model has one megabyte.
SLOTS = 1 << 18
_TOKEN = re.compile(r"[^\W_]+|[^\w\s]+|_+")
_GOLDEN = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class Ftrl:
    alpha: float = 2.0
    beta: float = 1.0
    l1: float = 0.005
    l2: float = 0.05
    epochs: int = 6


def words(text: str) -> list[str]:
    """Words in lower case, those in capitals marked, a word said again as one mark; runs
    of signs are words too."""
    out, last = [], ""
    for token in _TOKEN.findall(text):
        if token[0].isalnum():
            lower = token.lower()
            if lower == last:
                out.append("<again>")
            elif len(token) > 1 and token.isupper():
                out.append("<capitals>")
            else:
                out.append(lower)
            last = lower
        else:
            out.append(token)
    return out


def features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Slots and values of a text: log counts of its n-grams, scaled to unit length."""
    tokens = words(text)
    if not tokens:
        return np.array([], np.int64), np.array([], np.float64)
    digests = b"".join(map(xxhash.xxh3_64_digest, tokens))
    single = np.frombuffer(digests, ">u8").astype(np.uint64)
    double = (single[:-1] * _GOLDEN ^ single[1:]) * _GOLDEN
    grams = np.concatenate([single, double]) >> np.uint64(64 - 18)
    slots, counts = np.unique(grams.astype(np.int64) % SLOTS, return_counts=True)
    values = np.log1p(counts)
    return slots, values / np.sqrt((values * values).sum())


def train(rows: list[tuple[np.ndarray, np.ndarray, int]], how: Ftrl) -> np.ndarray:
    """Weights after ``epochs`` passes in the given order; the last one is the intercept."""
    z, n = np.zeros(SLOTS + 1), np.zeros(SLOTS + 1)

    def weights(at: np.ndarray) -> np.ndarray:
        strong = np.abs(z[at]) > how.l1
        rate = (how.beta + np.sqrt(n[at])) / how.alpha + how.l2
        return np.where(strong, -(z[at] - np.sign(z[at]) * how.l1) / rate, 0.0)

    for _ in range(how.epochs):
        for slots, values, label in rows:
            at, x = np.append(slots, SLOTS), np.append(values, 1.0)
            w = weights(at)
            p = 1 / (1 + np.exp(-np.clip(w @ x, -35, 35)))
            g = (p - label) * x
            step = (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / how.alpha
            z[at] += g - step * w
            n[at] += g * g
    return weights(np.arange(SLOTS + 1))


def fit(
    docs: DataFrame,
    labels: DataFrame,
    label: str = "quality",
    max_rows: int = MAX_TRAINING_ROWS,
    how: Ftrl | None = None,
) -> np.ndarray:
    """Mean weights of the replicas. Without labelled rows all weights are zero (score 0.5)."""
    rule = how or Ftrl()
    sample = training_sample(docs, labels, label, max_rows)
    total = labels.where(~held_out()).select("doc_id").limit(max_rows).count()
    replicas = max(1, -(-total // REPLICA_ROWS))
    dealt = sample.withColumn("replica", F.pmod(F.xxhash64(F.lit(3), "doc_id"), F.lit(replicas)))

    def learn(group: pd.DataFrame) -> pd.DataFrame:
        ordered = group.assign(o=[xxhash.xxh3_64_intdigest(str(i)) for i in group["doc_id"]])
        ordered = ordered.sort_values("o")
        rows = [(*features(t), y) for t, y in zip(ordered["text"], ordered["label"], strict=True)]
        weights = train(rows, rule).astype("<f4")
        return pd.DataFrame({"n": [len(rows)], "weights": [weights.tobytes()]})

    found = dealt.groupBy("replica").applyInPandas(learn, "n long, weights binary").collect()
    if not found:
        return np.zeros(SLOTS + 1, np.float32)
    models = np.stack([np.frombuffer(r["weights"], "<f4") for r in found])
    return np.average(models, axis=0, weights=[r["n"] for r in found]).astype(np.float32)


def score(docs: DataFrame, weights: np.ndarray, text: str = "text", out: str = "score") -> DataFrame:
    """Add ``out`` in 0 to 1. Null and empty texts get the intercept's score; other columns
    and repeated rows pass, a column named ``out`` is replaced."""
    source = without(docs, out)
    model = docs.sparkSession.sparkContext.broadcast(weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = model.value.astype(np.float64)
        for batch in small_batches(batches, text):
            sums = []
            for t in batch.column(text).to_pylist():
                slots, values = features(t or "")
                sums.append(w[slots] @ values + w[SLOTS])
            scores = 1 / (1 + np.exp(-np.clip(np.array(sums), -35, 35)))
            yield with_columns(batch, **{out: pa.array(scores, pa.float64())})

    return source.mapInArrow(run, extended(source.schema, **{out: T.DoubleType()}))
