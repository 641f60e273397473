"""Operator 10, language identification with hyperdimensional profiles."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import lean, mix, small_batches, table

#: Components of a vector, letters of an n-gram, characters that are counted at a time.
DIM, GRAM, RUN = 256, 3, 1 << 20
SPACE = 32
_letter = np.zeros(0x110000, bool)


def letters() -> np.ndarray:
    if not _letter.any():
        _letter[:] = [chr(c).isalpha() for c in range(0x110000)]
    return _letter


def letter_vectors(codes: np.ndarray) -> np.ndarray:
    """Random vectors of 1 and -1, one for each code point, drawn from the code point alone."""
    words = mix(codes.astype(np.uint64)[:, None] * np.uint64(0x2545F4914F6CDD1D) + np.arange(1, DIM // 64 + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return np.unpackbits(words.view(np.uint8), axis=1).astype(np.int8) * 2 - 1


def gram_vectors(grams: np.ndarray) -> np.ndarray:
    """Vectors of n-grams, rows of code points: each letter's vector is rotated by its place, and they are multiplied."""
    codes, at = np.unique(grams, return_inverse=True)
    at = at.reshape(grams.shape)
    v = letter_vectors(codes)
    out = v[at[:, GRAM - 1]]
    for k in range(GRAM - 1):
        out = out * np.roll(v, GRAM - 1 - k, axis=1)[at[:, k]]
    return out.astype(np.float32)


def profiles(texts: list):
    """For runs of texts (first index, vectors): each text's n-gram vectors bundled, zero if it has no letters.

    Text is lower-cased; what lies between letters counts as one space, as do a text's ends.
    """
    first, size, own = 0, 0, []
    for i, t in enumerate(texts):
        own.append(t or "")
        size += len(own[-1])
        if size >= RUN or i == len(texts) - 1:
            yield first, _bundle(own)
            first, size, own = i + 1, 0, []


def _bundle(texts: list[str]) -> np.ndarray:
    joined = "\x00".join(texts).lower() + "\x00"
    raw = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    doc = np.cumsum(raw == 0) - (raw == 0)
    if doc[-1] != len(texts) - 1:  # texts that hold U+0000
        return np.concatenate([_bundle([t.replace("\x00", " ")]) for t in texts])
    word = letters()[raw]
    keep = word | (np.concatenate(([False], word[:-1])))  # letters, and the first of what follows
    code, doc = np.where(word, raw, SPACE)[keep].astype(np.int64), doc[keep]
    out = np.zeros((len(texts), DIM), np.float32)
    if not len(code):
        return out
    begin = np.concatenate(([True], doc[1:] != doc[:-1]))  # a space before each text's first letter
    at = np.flatnonzero(begin)
    code, doc = np.insert(code, at, SPACE), np.insert(doc, at, doc[at])
    same = doc[2:] == doc[:-2]
    small, ids = np.unique(code, return_inverse=True)
    n = len(small)
    gram = (ids[:-2] * n + ids[1:-1]) * n + ids[2:]
    gram, of = gram[same], doc[2:][same]
    kinds, which = np.unique(gram, return_inverse=True)
    vectors = gram_vectors(np.stack([small[kinds // (n * n)], small[kinds // n % n], small[kinds % n]], axis=1))
    pair, count = np.unique(of * len(kinds) + which, return_counts=True)
    of, which = pair // len(kinds), pair % len(kinds)
    starts = np.flatnonzero(np.concatenate(([True], of[1:] != of[:-1])))
    ends = np.concatenate((starts[1:], [len(of)]))
    for a, b in zip(starts, ends):
        out[of[a]] = count[a:b].astype(np.float32) @ vectors[which[a:b]]
    return out


def fit(docs: DataFrame) -> tuple[list[str], np.ndarray]:
    """Languages and their prototypes: the sum of the unit profiles of all documents of a language.

    Rows without a language or letters add nothing. Only languages times DIM sums reach the driver.
    """

    @lean
    def sums(parts):
        total: dict[str, np.ndarray] = {}
        for pdf in parts:
            lang = pdf["lang"].to_numpy()
            for first, v in profiles(list(pdf["text"])):
                norm = np.linalg.norm(v, axis=1)
                v[norm > 0] /= norm[norm > 0, None]
                own = lang[first : first + len(v)]
                for k in set(own):
                    total[k] = total.get(k, 0) + v[own == k].sum(axis=0, dtype=np.float64)
        for k, v in total.items():
            yield pd.DataFrame({"lang": k, "dim": np.arange(DIM, dtype=np.int32), "x": v})

    rows = docs.where("lang IS NOT NULL AND text IS NOT NULL").select("text", "lang").mapInPandas(sums, "lang string, dim int, x double")
    got = rows.groupBy("lang", "dim").agg(F.sum(F.round("x", 6).cast("decimal(28,6)")).cast("double").alias("x")).collect()
    names = sorted({r[0] for r in got})
    out = np.zeros((len(names), DIM))
    for r in got:
        out[names.index(r[0]), r[1]] = r[2]
    ok = np.linalg.norm(out, axis=1) > 0
    out = out[ok]
    return [n for n, k in zip(names, ok) if k], out / np.linalg.norm(out, axis=1, keepdims=True)


def predict(docs: DataFrame, names: list[str], prototypes: np.ndarray) -> DataFrame:
    """doc_id, held_out, lang_pred, score (the cosine with the prototype, at least 0).

    A null text, or one without letters, is und with score 0, as is every text if nothing was learnt.
    Ties go to the first language by name. Each row is scored alone, so repeated rows agree.
    """

    @lean
    def run(parts):
        for pdf in parts:
            lang, score = ["und"] * len(pdf), np.zeros(len(pdf))
            for first, v in profiles(list(pdf["text"])) if len(names) else ():
                norm = np.linalg.norm(v.astype(np.float64), axis=1)
                cos = v @ prototypes.T / np.where(norm > 0, norm, 1)[:, None]
                best = cos.argmax(axis=1)
                for i in np.flatnonzero(norm > 0):
                    lang[first + i], score[first + i] = names[best[i]], min(1.0, max(0.0, cos[i, best[i]]))
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "held_out": pdf["held_out"], "lang_pred": lang, "score": score})

    return docs.select("doc_id", "held_out", "text").mapInPandas(run, "doc_id long, held_out boolean, lang_pred string, score double")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op10: learns where crc32(doc_id as text) mod 4 is not 2, predicts every document."""
    small_batches(spark)
    docs = table(spark, sf_dir, "documents").withColumn("held_out", F.expr("coalesce(crc32(encode(cast(doc_id AS string), 'UTF-8')) % 4 = 2, false)"))
    names, prototypes = fit(docs.where("NOT held_out"))
    return predict(docs, names, prototypes)
