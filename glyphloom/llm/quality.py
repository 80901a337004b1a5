"""Quality classifier: nearest-neighbour voting in a latent semantic space.

A text is a vector of hashed byte trigrams, damped by logarithm, weighted by rarity, and of unit length, beside marks for how often a word equals the one before and for the share of words that are new; the leading singular vectors of the labelled sample span the latent space. The labelled latent vectors are broadcast: at most LABELLED rows of DIM numbers. For every document the cosine with every labelled vector is computed, block by block as matrix products, the NEAREST of them vote with their label, weighted by a power of the similarity.

Bounded sample of the fit: the LABELLED labelled documents with the smallest hashes of doc_id among those in training. Held out is crc32(doc_id as text) mod 3 = 1; labels of those rows are never read by the fit. doc_id, lang and source only select rows.

Null text: scored as empty. A text under three bytes has no trigrams: its vector is zero and its score is the share of label 1. Without labels every score is 0.5. Several labels of a document: the lowest counts. Null doc_id: not held out, never in training. Repeated rows are scored each, alike. Empty table: no rows.
"""

from __future__ import annotations

from bisect import bisect
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import pieces, table, utf8

LABELLED, DIM, BUCKETS = 3000, 48, 4096
NEAREST, POWER = 25, 8
ROWS = 512
#: Bounds of the bins of the share of words that equal the one before, and of the share of distinct words in CHUNK consecutive ones.
AGAIN, NEW, CHUNK = (0.01, 0.02, 0.04, 0.08, 0.16, 0.32), (0.1, 0.2, 0.3, 0.4, 0.5, 0.6), 256
MARKS, MARK = len(AGAIN) + len(NEW) + 2, 0.6


def marks(raw: bytes) -> tuple[int, int] | None:
    """The bins of a text; None for one of under 8 words."""
    words = raw.split()
    if len(words) < 8:
        return None
    again = sum(map(eq, words, words[1:])) / len(words)
    new = sum(len(set(words[i : i + CHUNK])) for i in range(0, len(words), CHUNK)) / len(words)
    return bisect(AGAIN, again), len(AGAIN) + 1 + bisect(NEW, new)


def features(raw: bytes) -> np.ndarray:
    out = np.zeros(BUCKETS + MARKS, np.float32)
    out[:BUCKETS] = trigrams(raw)
    for i in marks(raw) or ():
        out[BUCKETS + i] = 1
    return out


def trigrams(raw: bytes, buckets: int = BUCKETS) -> np.ndarray:
    """Counts of hashed byte trigrams."""
    x = np.frombuffer(raw, np.uint8).astype(np.uint32)
    if len(x) < 3:
        return np.zeros(buckets, np.float32)
    codes = x[:-2] * np.uint32(2654435761) + x[1:-1] * np.uint32(2246822519) + x[2:] * np.uint32(3266489917)
    codes = (codes ^ (codes >> np.uint32(15))) * np.uint32(2654435769)
    return np.bincount(codes >> np.uint32(32 - buckets.bit_length() + 1), minlength=buckets).astype(np.float32)


class Model:
    """idf: of buckets; base: buckets x DIM; vectors: labelled latent vectors of unit length; labels: theirs."""

    def __init__(self, counts: np.ndarray, labels: np.ndarray, dim: int = DIM, nearest: int = NEAREST, power: int = POWER):
        self.nearest, self.power = nearest, power
        self.prior = float(labels.mean()) if len(labels) else 0.5
        self.idf = np.log((1 + len(counts)) / (1 + (counts > 0).sum(0))).astype(np.float32) + 1
        x = self._weighted(counts)
        self.base = self._space(x, min(dim, *x.shape))
        self.vectors = self._unit(x @ self.base)
        self.labels = labels.astype(np.float64)

    def _weighted(self, counts: np.ndarray) -> np.ndarray:
        text = self._unit(np.log1p(counts[:, :BUCKETS]) * self.idf[:BUCKETS])
        return np.concatenate([text, counts[:, BUCKETS:] * np.float32(MARK)], axis=1)

    @staticmethod
    def _unit(x: np.ndarray) -> np.ndarray:
        norm = np.linalg.norm(x, axis=1, keepdims=True)
        return x / np.where(norm > 0, norm, 1)

    @staticmethod
    def _space(x: np.ndarray, dim: int) -> np.ndarray:
        """Leading right singular vectors by subspace iteration from a fixed start."""
        q = np.random.default_rng(7).standard_normal((x.shape[1], min(dim + 8, x.shape[1]))).astype(np.float32)
        for _ in range(4):
            q, _ = np.linalg.qr(x.T @ (x @ q))
        u, _, _ = np.linalg.svd((x @ q).T, full_matrices=False)
        return (q @ u[:, :dim]).astype(np.float32)

    def scores(self, counts: np.ndarray) -> np.ndarray:
        out = np.full(len(counts), self.prior)
        if not len(self.vectors):
            return out
        latent = self._unit(self._weighted(counts) @ self.base)
        k = min(self.nearest, len(self.vectors))
        for i in range(0, len(counts), ROWS):
            cosines = latent[i : i + ROWS] @ self.vectors.T
            near = np.argpartition(-cosines, k - 1, axis=1)[:, :k]
            weights = np.clip(np.take_along_axis(cosines, near, 1).astype(np.float64), 0, None) ** self.power
            total = weights.sum(1)
            vote = (weights * self.labels[near]).sum(1)
            out[i : i + ROWS] = np.where(total > 0, vote / np.where(total > 0, total, 1), self.prior)
        return np.round(out, 5)


def held_out(doc_id="doc_id"):
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 3 == 1, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", labelled: int = LABELLED) -> Model | None:
    rows = labels.select("doc_id", F.col(label).alias("label")).where("doc_id is not null and label is not null").where(~held_out())
    rows = rows.groupBy("doc_id").agg(F.min("label").alias("label"))
    chosen = rows.orderBy(F.xxhash64("doc_id"), "doc_id").limit(labelled)
    texts = docs.select("doc_id", utf8().alias("raw")).join(F.broadcast(chosen), "doc_id")  # at most `labelled` rows

    def run(parts):
        for batch in pieces(parts):
            out = [features(x.as_py()) for x in batch.column(1)]
            hit = [np.flatnonzero(c) for c in out]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2).cast(pa.int32()), pa.array([h.astype("<u2").tobytes() for h in hit], pa.binary()), pa.array([np.minimum(c[h], 65535).astype("<u2").tobytes() for c, h in zip(out, hit)], pa.binary())], ["doc_id", "label", "at", "n"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    got = texts.select("doc_id", "raw", F.col("label").cast("int")).mapInArrow(run, f"doc_id {kind}, label int, at binary, n binary").toArrow()
    if not got.num_rows:
        return None
    order = sorted(range(got.num_rows), key=lambda i: (got["doc_id"][i].as_py(), got["at"][i].as_py(), got["n"][i].as_py()))
    counts, marks = np.zeros((len(order), BUCKETS + MARKS), np.float32), np.zeros(len(order))
    for row, i in enumerate(order):
        counts[row, np.frombuffer(got["at"][i].as_py(), "<u2")] = np.frombuffer(got["n"][i].as_py(), "<u2")
        marks[row] = got["label"][i].as_py()
    return Model(counts, marks)


def _scores(model: Model | None, raws) -> np.ndarray:
    """Of a list of texts as bytes."""
    if model is None:
        return np.full(len(raws), 0.5)
    out = [np.empty(0)]
    for i in range(0, len(raws), ROWS):
        out.append(model.scores(np.stack([features(x) for x in raws[i : i + ROWS]])))
    return np.concatenate(out)


def score(docs: DataFrame, model: Model | None) -> DataFrame:
    """(doc_id, held_out, score, predicted)"""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(parts):
        for batch in pieces(parts):
            found = _scores(shared.value, batch.column(2).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found, pa.float64()), pa.array((found >= 0.5).astype(np.int32), pa.int32())], ["doc_id", "held_out", "score", "predicted"])

    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), held_out().alias("held_out"), utf8().alias("raw")).mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")


def keep(docs: DataFrame, model: Model | None) -> DataFrame:
    """The documents that the model does not reject, unchanged."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("boolean")
    def good(raws):
        import pandas as pd

        return pd.Series(_scores(shared.value, raws.array) >= 0.5)

    return docs.where(good(utf8()))


def query(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return score(docs, fit(docs, table(spark, sf_dir, "labels")))
