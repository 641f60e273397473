"""Operator 9, quality by nearest-neighbour voting over latent-semantic vectors."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import BYTE, SPACE, chunks, lean, mix, powers, small_batches, table

#: Labelled rows that are fitted on at most (those with the least hash of doc_id, as many of each label),
#: hashed features, latent dimensions, neighbours that vote.
SAMPLE, HASHED, DIM, NEIGHBOURS = 4000, 2048, 48, 15
RATES = 12
#: A score under this is predicted 0, and the pipeline rejects the document.
REJECT = 0.3
_kind = np.zeros(256, np.uint8)  # of a byte: 0 other sign, 1 lower case, 2 upper case, 3 digit, 4 white space, 5 beyond ASCII
_kind[97:123], _kind[65:91], _kind[48:58], _kind[128:] = 1, 2, 3, 5
_kind[SPACE] = 4


def features(texts: list) -> np.ndarray:
    """float32 rows: square roots of the shares of hashed word shapes and shape pairs, each block of unit length, and rates.

    A word's shape has a run of letters of one kind as one letter; signs stay as they are. Rates: repeated
    words, distinct words, lengths and kinds of bytes. An empty or null text has zeros only.
    """
    out = np.zeros((len(texts), HASHED + RATES), np.float32)
    for first, docs in chunks(texts):
        buf = np.frombuffer(b"\n".join(docs) + b"\n", np.uint8)
        kind = _kind[buf]
        power, inverse = powers(len(buf) + 1)
        space = SPACE[buf]
        edge = np.flatnonzero(np.diff(np.concatenate(([True], space)).astype(np.int8)))
        start, end = edge[::2], edge[1::2]
        raw = np.concatenate((np.zeros(1, np.uint64), np.cumsum(BYTE[buf] * power[: len(buf)])))
        word = (raw[end] - raw[start]) * inverse[start]
        shown = np.where((kind == 0) | (kind == 3), buf, 200 + kind).astype(np.uint8)
        fresh = np.concatenate(([True], shown[1:] != shown[:-1])) | (kind == 0)
        rank = np.cumsum(fresh) - 1
        one = np.where(fresh, BYTE[shown] * power[rank], np.uint64(0))
        upto = np.concatenate((np.zeros(1, np.uint64), np.cumsum(one)))
        shape = mix((upto[end] - upto[start]) * inverse[rank[start]]) if len(start) else start.astype(np.uint64)
        ends = np.searchsorted(start, np.cumsum([len(d) + 1 for d in docs]))
        byte_ends = np.cumsum([len(d) + 1 for d in docs])
        a = x = 0
        for i, (b, y) in enumerate(zip(ends, byte_ends)):
            row, n = out[first + i], b - a
            if n:
                s, w = shape[a:b], word[a:b]
                half = HASHED // 2
                row[:half] = np.sqrt(np.bincount((s % np.uint64(half)).astype(np.int64), minlength=half) / n)
                if n > 1:
                    pair = mix(s[:-1] * np.uint64(3) + s[1:])
                    row[half:HASHED] = np.sqrt(np.bincount((pair % np.uint64(half)).astype(np.int64), minlength=half) / (n - 1))
                share = np.bincount(kind[x : y - 1], minlength=6) / max(1, y - 1 - x)
                counts = np.unique(w, return_counts=True)[1]
                row[HASHED:] = [(w[1:] == w[:-1]).mean() if n > 1 else 0, len(counts) / n, counts.max() / n, np.log1p(n) / 12, np.log1p((y - x) / n) / 4, np.mean(end[a:b] - start[a:b] > 15), *share]
            a, x = b, y
    return out


class Model:
    """Latent vectors of the sample. Weighted columns, a truncated SVD by random projection, unit rows."""

    def __init__(self, x: np.ndarray, label: np.ndarray):
        self.label = label.astype(np.float64)
        self.prior = float(label.mean()) if len(label) else 0.5
        if not len(x):
            self.basis = self.vectors = None
            return
        self.mean = x.mean(axis=0)
        spread = x.std(axis=0)
        seen = (x > 0).sum(axis=0)
        self.scale = np.where((seen >= 2) & (spread > 1e-6), 1.0, 0).astype(np.float32)
        self.scale[HASHED:] *= 0.5 / np.maximum(spread[HASHED:], 1e-3) / np.sqrt(RATES)
        z = (x - self.mean) * self.scale
        rng = np.random.default_rng(9)
        q = z.T @ rng.standard_normal((len(z), min(DIM + 16, len(z)))).astype(np.float32)
        for _ in range(4):
            q = np.linalg.qr(z.T @ (z @ q))[0]
        _, _, vt = np.linalg.svd(z @ q, full_matrices=False)
        self.basis = (q @ vt.T)[:, :DIM].astype(np.float32)
        self.vectors = self.latent(x)

    def latent(self, x: np.ndarray) -> np.ndarray:
        v = ((x - self.mean) * self.scale) @ self.basis
        return v / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-9)

    def score(self, x: np.ndarray) -> np.ndarray:
        """Exact cosines with all vectors of the sample, 256 rows at a time; the nearest vote with their similarity."""
        out = np.full(len(x), self.prior)
        for k in range(0, len(x), 256) if self.vectors is not None else ():
            cos = self.latent(x[k : k + 256]) @ self.vectors.T
            n = min(NEIGHBOURS, cos.shape[1])
            at = np.argpartition(-cos, n - 1, axis=1)[:, :n]
            w = np.maximum(np.take_along_axis(cos, at, 1).astype(np.float64), 1e-6) ** 4
            out[k : k + 256] = (w * self.label[at]).sum(axis=1) / w.sum(axis=1)
        return out


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """A model of at most sample labelled rows, half of each label at most. Null labels are left out."""
    known = labels.where("quality IN (0, 1) AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.max("quality").alias("quality"))
    known = known.where("crc32(encode(cast(doc_id AS string), 'UTF-8')) % 5 <> 0")
    parts = [known.where(F.col("quality") == q).withColumn("h", F.xxhash64("doc_id")).orderBy("h", "doc_id").limit(sample // 2) for q in (0, 1)]
    chosen = parts[0].unionByName(parts[1]).select("doc_id", "quality")
    # broadcast: at most sample rows of two numbers
    rows = docs.join(F.broadcast(chosen), "doc_id").select("doc_id", "quality", "text")

    @lean
    def run(parts_):
        for pdf in parts_:
            x = features(list(pdf["text"]))
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "quality": pdf["quality"], "x": [r.astype(np.float16).tobytes() for r in x]})

    got = rows.mapInPandas(run, "doc_id long, quality int, x binary").dropDuplicates(["doc_id"]).collect()
    got.sort(key=lambda r: r[0])
    x = np.array([np.frombuffer(r[2], np.float16) for r in got], np.float32).reshape(len(got), HASHED + RATES)
    return Model(x, np.array([r[1] for r in got]))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of docs; an empty or null text is scored as one without words.

    Without any labelled row every score is 0.5. Repeated rows get the same score.
    """
    spark = docs.sparkSession
    sent = spark.sparkContext.broadcast(model)  # SAMPLE * DIM and HASHED * DIM numbers: under 2 MB

    @lean
    def run(parts):
        for pdf in parts:
            s = np.round(np.clip(sent.value.score(features(list(pdf["text"]))), 0, 1), 6)
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "held_out": pdf["held_out"], "score": s, "predicted": (s >= REJECT).astype(np.int32)})

    held = F.expr("coalesce(crc32(encode(cast(doc_id AS string), 'UTF-8')) % 5 = 0, false)")
    return docs.select("doc_id", held.alias("held_out"), "text").mapInPandas(run, "doc_id long, held_out boolean, score double, predicted int")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op9: learns where crc32(doc_id as text) mod 5 is not 0, scores every document."""
    small_batches(spark)
    docs = table(spark, sf_dir, "documents")
    return score(docs, fit(docs, table(spark, sf_dir, "labels")))
