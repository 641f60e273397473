"""What the operators share: shared-folder tables, vectorised shingling and connected components."""

from __future__ import annotations

import ctypes
import functools
import tempfile
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..shipping import ship

U64 = np.uint64
M1, M2 = U64(0xBF58476D1CE4E5B9), U64(0x94D049BB133111EB)
#: Odd 64-bit multiplier of the polynomial hash, and its inverse modulo 2**64.
BASE = 0x9E3779B97F4A7C15
BASE_INV = pow(BASE, -1, 1 << 64)
SHINGLE = 5


def shared_dir(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir; a local one only where that is unset, as in tests."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        path = "file://" + tempfile.mkdtemp(prefix="lymphora-")
        spark.conf.set("spark.checkpoint.dir", path)
    return path.rstrip("/")


def cut(df: DataFrame, name: str = "t") -> DataFrame:
    """df written as a table in the shared folder and read again, so that its lineage ends there."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/lymphora-{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    spark.sparkContext._jvm.System.gc()  # so that shuffle files that nothing refers to any more are removed
    out = spark.read.schema(df.schema).parquet(path)
    out._path = path
    return out


def drop(df: DataFrame) -> None:
    """Deletes a table that cut wrote and that no later table is computed from."""
    spark = df.sparkSession
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(df._path)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


#: Rows of 64 bits of a key filter at most: 4 MB, as they are sent to all tasks.
WORDS = 1 << 18


def held_by(df: DataFrame, keys: DataFrame, on: list[str], keep: bool = True) -> DataFrame:
    """Rows of df whose hash is one of keys'; with keep False, the others, which are surely not in keys.

    So most of df need not be exchanged for a join with few keys. The filter has WORDS * 64 bits however many keys
    there are: with more keys it lets more rows pass.
    """
    h = F.xxhash64(*on)
    at, bit = F.pmod(h, F.lit(WORDS)), F.pmod(F.shiftrightunsigned(h, 32), F.lit(64)).cast("int")
    bits = keys.select(at.alias("at__"), bit.alias("bit__")).distinct().groupBy("at__").agg(F.sum(F.expr("shiftleft(1L, bit__)")).alias("bits__"))
    found = df.withColumns({"at__": at, "bit__": bit}).join(F.broadcast(bits), "at__", "left")
    hit = F.coalesce(F.expr("shiftright(bits__, bit__) & 1L") == 1, F.lit(False))
    return found.where(hit if keep else ~hit).drop("at__", "bit__", "bits__")


def small_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Arrow batches of at most so many rows: they bound what a Python worker holds."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def trim() -> None:
    """Gives freed memory back to the system, as Spark keeps idle Python workers, with all they hold."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # not glibc
        pass


def lean(run):
    """run, a function of an iterator of batches, that trims at the end of each partition."""
    @functools.wraps(run)
    def trimmed(parts):
        try:
            yield from run(parts)
        finally:
            trim()

    return trimmed


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64."""
    x = x.astype(U64, copy=True)
    x ^= x >> U64(30)
    x *= M1
    x ^= x >> U64(27)
    x *= M2
    x ^= x >> U64(31)
    return x


_powers = [np.ones(1, U64), np.ones(1, U64)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and BASE**-i modulo 2**64 for i < n at least."""
    if len(_powers[0]) < n:
        n = max(n, 1 << 20)
        for k, b in enumerate((BASE, BASE_INV)):
            p = np.full(n, b, U64)
            p[0] = 1
            _powers[k] = np.multiply.accumulate(p)
    return _powers[0], _powers[1]


BYTE = mix(np.arange(1, 257, dtype=U64))
_lower = np.arange(256)
_lower[65:91] += 32
LOWER_BYTE = BYTE[_lower]
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
_place = mix(np.arange(1001, 1001 + SHINGLE, dtype=U64)) | U64(1)


def chunks(texts: list, limit: int = 1 << 20):
    """(first index, list of UTF-8 bytes) of runs of texts of about limit bytes; null is empty."""
    out, size, first = [], 0, 0
    for i, t in enumerate(texts):
        b = (t or "").encode("utf-8", "surrogatepass")
        out.append(b)
        size += len(b)
        if size >= limit:
            yield first, out
            out, size, first = [], 0, i + 1
    if out:
        yield first, out


def shingle_sets(texts: list):
    """For each text its sorted distinct 64-bit hashes of 5-word shingles.

    A-Z is lower-cased, a word is a run of bytes that are not white space. A text with one to four
    words has one shingle, its whole sequence; one without words, or a null, has none.
    """
    for _, docs in chunks(texts):
        buf = np.frombuffer(b"\n".join(docs) + b"\n", np.uint8)
        power, inverse = powers(len(buf) + 1)
        h = np.zeros(len(buf) + 1, U64)
        np.cumsum(LOWER_BYTE[buf] * power[: len(buf)], out=h[1:])
        space = SPACE[buf]
        edge = np.flatnonzero(np.diff(np.concatenate(([True], space)).astype(np.int8)))
        start, end = edge[::2], edge[1::2]
        word = mix((h[end] - h[start]) * inverse[start])
        n = len(word)
        grams = np.zeros(max(n - SHINGLE + 1, 0), U64)
        for k in range(SHINGLE if n >= SHINGLE else 0):
            grams += word[k : n - SHINGLE + 1 + k] * _place[k]
        grams = mix(grams)
        ends = np.cumsum([len(d) + 1 for d in docs])
        upto = np.searchsorted(start, ends)
        a = 0
        for b in upto:
            if b - a >= SHINGLE:
                yield np.unique(grams[a : b - SHINGLE + 1])
            elif b > a:
                with np.errstate(over="ignore"):
                    yield mix(np.array([np.sum(word[a:b] * _place[: b - a]) + U64(b - a)], U64))
            else:
                yield np.zeros(0, U64)
            a = b


def connected_components(edges: DataFrame, limit: int = 40) -> DataFrame:
    """(node, component) of all nodes of edges (src, dst), component being the smallest node reachable.

    Alternates large-star and small-star steps (Kiveris et al. 2014) until the edges stay the same.
    A node with many edges is only ever reduced by min() or joined, so no task gathers its edges.
    """
    spark = edges.sparkSession
    e = cut(edges.where("src <> dst").selectExpr("greatest(src, dst) AS u", "least(src, dst) AS v").distinct(), "cc")
    mark = None
    for _ in range(limit):
        both = e.unionByName(e.selectExpr("v AS u", "u AS v"))
        least = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
        large = both.where("v > u").join(least, "u").selectExpr("v AS u", "m AS v").where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v")))).alias("x")).select("x.*")
        e = cut(small.where("u <> v").distinct(), "cc")
        now = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == mark or not now[0]:
            break
        mark = now
    else:
        raise RuntimeError("components did not settle")
    roots = e.groupBy("u").agg(F.min("v").alias("component")).withColumnRenamed("u", "node")
    return roots.unionByName(e.selectExpr("v AS node", "v AS component").distinct().join(roots.select("node"), "node", "left_anti"))
