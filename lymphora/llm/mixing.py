"""Operator 3, mixing sources to target weights."""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import cut, lean, table

WORD = r"[^\x20\x09-\x0D]+"
_word = re.compile(WORD)
#: Words of a block (fewer in a source of under BLOCK**2 words, so that it has BLOCK blocks at least), blocks of an output shard, chunks that a source's stream is summed in.
BLOCK, SHARD, CHUNKS, SEED = 64, 4096, 1024, 20
#: Columns that tell rows apart, see numbered.
KEY = ["k1", "k2", "copy"]
#: Shards that a task fills with slots.
FILL = 16
#: Sources are held on the driver and sent to the tasks; more of them than this is an error.
MOST_SOURCES = 100_000


def targets(sizes: list[float], weights: list[float], most: float = 3.0) -> list[float]:
    """Shares of the sum of sizes by weight, none above most times its size; the excess is reshared by weight."""
    total, out, free = float(sum(sizes)), [0.0] * len(sizes), list(range(len(sizes)))
    left = total
    while free:
        w = sum(weights[i] for i in free)
        over = [i for i in free if left * weights[i] / w > most * sizes[i]]
        if not over:
            for i in free:
                out[i] = left * weights[i] / w
            break
        for i in over:
            out[i] = most * sizes[i]
        left -= sum(out[i] for i in over)
        free = [i for i in free if i not in set(over)]
    return out


def permuted(k: np.ndarray, n: int, key: int) -> np.ndarray:
    """A pseudorandom permutation of range(n) at k: a four-round Feistel network walked until it is below n."""
    half = max(1, (max(n - 1, 1).bit_length() + 1) // 2)
    mask = np.uint64((1 << half) - 1)
    x, todo = k.astype(np.uint64), np.arange(len(k))
    while len(todo):
        a, b = x[todo] >> np.uint64(half), x[todo] & mask
        for r in range(4):
            f = b + np.uint64((key * 0x9E3779B97F4A7C15 + r * 0xD1B54A32D192ED03) % (1 << 64))
            f ^= f >> np.uint64(30)
            f *= np.uint64(0xBF58476D1CE4E5B9)
            f ^= f >> np.uint64(27)
            f *= np.uint64(0x94D049BB133111EB)
            f ^= f >> np.uint64(31)
            a, b = b, a ^ (f & mask)
        x[todo] = (a << np.uint64(half)) | b
        todo = todo[x[todo] >= n]
    return x.astype(np.int64)


def numbered(docs: DataFrame, *more: Column) -> DataFrame:
    """docs with KEY, and the columns more: a hash of doc_id, one of the text, and a number for rows that share both,
    so that each row has a key of its own, also where the doc_id is null or occurs twice."""
    keys = docs.select("*", F.xxhash64("doc_id").alias("k1"), F.xxhash64("text").alias("k2"), *more)
    return keys.withColumn("copy", F.row_number().over(Window.partitionBy("k1", "k2").orderBy("doc_id", "source")))


class Mix:
    """A mixture: sizes (doc_id, KEY, source, size), sources (a list of dicts), pieces (source_no, block, doc_id,
    KEY, first word, words) and slots (shard, slot, source_no, block)."""

    def __init__(self, docs: DataFrame, seed: int = SEED):
        spark = docs.sparkSession
        size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size")
        slim = numbered(docs.select("doc_id", "source", "text"), size).drop("text")
        # rows without a doc_id are spread by their texts
        self.sizes = sizes = cut(slim.withColumn("chunk", F.pmod(F.xxhash64(F.coalesce("doc_id", "k2")), F.lit(CHUNKS)).cast("int")), "sizes")
        by_chunk = cut(sizes.groupBy("source", "chunk").agg(F.sum("size").alias("n")), "chunks")
        totals = by_chunk.groupBy("source").agg(F.sum("n").alias("n")).limit(MOST_SOURCES + 1).collect()
        if len(totals) > MOST_SOURCES:
            raise ValueError(f"more than {MOST_SOURCES} sources")
        totals = sorted(totals, key=lambda r: (r[0] is None, (r[0] or "").encode("utf-8", "surrogatepass")))
        goal = targets([r[1] for r in totals], [1 + i % 3 for i in range(len(totals))])
        self.sources = []
        for i, (r, t) in enumerate(zip(totals, goal)):
            words = max(1, min(BLOCK, r[1] // BLOCK))
            blocks = -(-r[1] // words)
            self.sources.append({"source": r[0], "no": i, "size": r[1], "target": t, "block_words": words, "blocks": blocks, "quota": min(3 * blocks, round(t * blocks / r[1])) if r[1] else 0})
        self.table = spark.createDataFrame([(s["source"], s["no"], s["size"], s["target"], s["block_words"]) for s in self.sources], "source string, source_no int, source_size long, target double, block_words int")
        at = Window.partitionBy("source").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
        # broadcast: at most CHUNKS rows a source, and MOST_SOURCES sources; beyond 10 MB Spark joins by shuffle
        base = by_chunk.withColumn("base", F.coalesce(F.sum("n").over(at), F.lit(0))).drop("n")
        base = self._numbered(base)
        within = Window.partitionBy("source_no", "chunk").orderBy("doc_id", "k2", "copy").rowsBetween(Window.unboundedPreceding, -1)
        placed = self._numbered(sizes).where("size > 0").join(base.drop("source", "block_words"), ["source_no", "chunk"])
        placed = placed.withColumn("start", F.col("base") + F.coalesce(F.sum("size").over(within), F.lit(0)))
        span = placed.withColumn("block", F.explode(F.sequence(F.floor(F.col("start") / F.col("block_words")), F.floor((F.col("start") + F.col("size") - 1) / F.col("block_words")))))
        first = F.greatest(F.col("block") * F.col("block_words"), F.col("start"))
        self.pieces = span.select("source_no", "block", "doc_id", *KEY, (first - F.col("start")).alias("first"), (F.least((F.col("block") + 1) * F.col("block_words"), F.col("start") + F.col("size")) - first).alias("words"))
        self.slots = self._slots(spark, seed)

    def _numbered(self, df: DataFrame) -> DataFrame:
        """df with source_no. The table of sources is bounded by MOST_SOURCES."""
        own = self.table.select(F.col("source").alias("source__"), "source_no", "block_words")
        return df.join(F.broadcast(own), F.col("source").eqNullSafe(F.col("source__"))).drop("source__")

    def _slots(self, spark: SparkSession, seed: int) -> DataFrame:
        """Each shard draws multinomial counts of its sources. A source's slots are numbered over all shards;
        those beyond its quota fill, in order, what other sources lack, so that every quota is met. A number
        goes through the source's own permutation of its blocks, again from the start after each full round."""
        quota = np.array([s["quota"] for s in self.sources], np.int64)
        blocks = np.array([s["blocks"] for s in self.sources], np.int64)
        total = int(quota.sum())
        shards = -(-total // SHARD)
        if not shards:
            return spark.createDataFrame([], "shard long, slot int, source_no int, block long")
        p = quota / total

        def draw(shard: int) -> np.ndarray:
            m = min(SHARD, total - shard * SHARD)
            return np.random.default_rng([seed, shard]).multinomial(m, p)

        @lean
        def counts(parts):
            for pdf in parts:
                for shard in pdf["id"]:
                    c = draw(int(shard))
                    k = np.flatnonzero(c)
                    yield pd.DataFrame({"shard": int(shard), "source_no": k.astype(np.int32), "n": c[k]})

        drawn = spark.range(shards).mapInPandas(counts, "shard long, source_no int, n long")
        # running counts over shards in two steps, as no task should see all shards of a source
        drawn = cut(drawn.withColumn("part", F.floor(F.col("shard") / 1024)), "drawn")
        parts = drawn.groupBy("source_no", "part").agg(F.sum("n").alias("n"))
        parts = parts.withColumn("base", F.coalesce(F.sum("n").over(Window.partitionBy("source_no").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("n")
        w = Window.partitionBy("source_no", "part").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
        drawn = drawn.withColumn("before", F.coalesce(F.sum("n").over(w), F.lit(0))).join(parts, ["source_no", "part"])
        drawn = drawn.select("shard", "source_no", "n", (F.col("base") + F.col("before")).alias("k"))
        got = {r[0]: r[1] for r in drawn.groupBy("source_no").agg(F.sum("n")).collect()}
        got = np.array([got.get(i, 0) for i in range(len(quota))], np.int64)
        excess, lack = np.maximum(got - quota, 0), np.maximum(quota - got, 0)
        over_at, lack_to = np.concatenate(([0], np.cumsum(excess)))[:-1], np.cumsum(lack)

        @lean
        def fill(parts_):
            for pdf in parts_:
                for shard, s, n, k in zip(pdf["shard"], pdf["source_no"], pdf["n"], pdf["k"]):
                    number, source = np.arange(k, k + n), np.full(n, s)
                    beyond = number >= quota[s]
                    if beyond.any():
                        j = over_at[s] + number[beyond] - quota[s]
                        to = np.searchsorted(lack_to, j, side="right")
                        source[beyond] = to
                        number[beyond] = got[to] + j - (lack_to[to] - lack[to])
                    block = np.empty(n, np.int64)
                    for one in np.unique(source):
                        own = source == one
                        block[own] = permuted(number[own] % blocks[one], int(blocks[one]), seed * 1_000_003 + int(one))
                    yield pd.DataFrame({"shard": shard, "slot": np.arange(n, dtype=np.int32), "source_no": source.astype(np.int32), "block": block})

        # few rows become many, so they are dealt by number and not by size
        return drawn.repartition(-(-shards // FILL), "shard").mapInPandas(fill, "shard long, slot int, source_no int, block long")


def mix_documents(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """(doc_id, KEY, times, first, words): runs of a row's words and how often the mix takes them.

    A null text has no words and is never taken; a null source is a source of its own, last in order;
    an empty table gives an empty mix. Extra columns are ignored. The draw depends on the seed alone.
    """
    mix = Mix(docs, seed)
    return _taken(mix)


def words_of(text: str, runs: list[tuple[int, int]]) -> str:
    """The text's runs (first word, words), with what is between their words; a newline between two runs."""
    at = [m.span() for m in _word.finditer(text)]
    out, upto = [], -1
    for first, n in runs:
        a, b = at[first][0], at[first + n - 1][1]
        if first == upto:  # goes on where the last run ends
            out.append(text[at[first - 1][1] : b])
        else:
            out += ["\n", text[a:b]] if out else [text[a:b]]
        upto = first + n
    return "".join(out)


def _taken(mix: Mix) -> DataFrame:
    used = mix.slots.groupBy("source_no", "block").agg(F.count("*").alias("times"))
    # both sides grow with the documents, so neither is ever broadcast
    return mix.pieces.join(used.hint("merge"), ["source_no", "block"]).select("doc_id", *KEY, "times", "first", "words")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op3: words taken of each row."""
    mix = Mix(table(spark, sf_dir, "documents"))
    taken = _taken(mix).groupBy(*KEY).agg(F.sum(F.col("times") * F.col("words")).alias("taken"))
    own = F.broadcast(mix.table.select(F.col("source").alias("source__"), "source_size", "target"))
    rows = mix.sizes.join(own, F.col("source").eqNullSafe(F.col("source__"))).join(taken.hint("merge"), KEY, "left")
    return rows.select("doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))
