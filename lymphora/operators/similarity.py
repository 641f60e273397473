"""Similarity joins and clonotypes (SIM6, SIM8, JOI2, AGG6)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.sequence import hamming, similar_cdr3
from .clustering import near_pairs, rooted


def within_one(df: DataFrame, keys: list[str], c: str) -> DataFrame:
    """SIM6 for one mismatch: pairs (keys, a, b), a < b, of distinct values of c with Hamming distance 1.

    Values are joined on themselves with one place masked, so nothing is compared pair by pair.
    """
    own = df.select(*keys, c).distinct().where(F.length(c) > 0)
    mask = F.explode(F.transform(F.sequence(F.lit(1), F.length(c)), lambda i: F.struct(i.alias("at"), F.concat(F.substring(F.col(c), F.lit(1), i - 1), F.lit("."), F.substring(F.col(c), i + 1, F.length(c))).alias("rest"))))
    masked = own.select(*keys, c, mask.alias("m")).select(*keys, F.col(c), "m.at", "m.rest")
    other = masked.withColumnRenamed(c, "b")
    return masked.withColumnRenamed(c, "a").join(other, [*keys, "at", "rest"]).where("a < b").select(*keys, "a", "b")


def clonotypes(df: DataFrame, keys: tuple[str, ...] = ("v_call", "j_call"), c: str = "cdr3", mismatches: float = 1, core_start: int = 0, core_end: int = 0) -> DataFrame:
    """SIM6, SIM8: distinct (keys, c) with root, the least value of its single-linkage cluster: equal lengths, mismatches at most (a
    share of the length behind the core's start if under 1), and with a core, equal ends before or behind it (SIM3). c may
    be amino acids."""
    own = df.where(F.length(c) > 0).select(*keys, c).distinct()
    pairs = within_one(own, list(keys), c) if mismatches == 1 else near_pairs(own, list(keys), c, mismatches, core_start)
    if core_start or core_end:
        pairs = pairs.where(similar_cdr3(F.col("a"), F.col("b"), mismatches, core_start, core_end))
    return rooted(own, list(keys), c, pairs)


def numbered_clonotypes(rows: DataFrame, keys: tuple[str, ...] = ("v_call", "j_call"), c: str = "cdr3", **limits) -> DataFrame:
    """SNK4: rows with clonotype_id, a digest of keys and root."""
    roots = clonotypes(rows, keys, c, **limits)
    return rows.join(roots, [*keys, c]).withColumn("clonotype_id", F.md5(F.concat_ws("|", *keys, "root"))).drop("root")


def clonoquery(query: DataFrame, reference: DataFrame, mismatches: int) -> DataFrame:
    """JOI2: each query row with the reference rows of its V, J and CDR3 length within mismatches; those without stay."""
    right = reference.select(*(F.col(c).alias(f"{c}_ref") for c in ("sequence_id", "v_call", "j_call", "cdr3")))
    same = (F.col("v_call") == F.col("v_call_ref")) & (F.col("j_call") == F.col("j_call_ref")) & (F.length("cdr3") == F.length("cdr3_ref"))
    return query.join(right, same & (hamming(F.col("cdr3"), F.col("cdr3_ref")) <= mismatches), "left")


def representative(df: DataFrame, keys: list[str], order: str, sequence: str = "VDJ_nt", count: str = "copies") -> DataFrame:
    """AGG6: of one or two rows the first; of more, the first with the sequence of the largest sum of counts. count becomes the
    group's sum. Two aggregations with partial sums; of each sequence only its first row is exchanged again."""
    first = F.min(F.struct(F.col(order).alias("o_"), F.struct(*[c for c in df.columns if c not in keys]).alias("r_"))).alias("first_")
    by = df.groupBy(*keys, F.col(sequence).alias("s_")).agg(F.count("*").alias("n_"), F.sum(count).alias("own_"), first)
    top = F.min(F.struct((-F.col("own_")).alias("a"), "first_"))["first_"]
    out = by.groupBy(*keys).agg(F.sum("n_").alias("n_"), F.sum("own_").alias("sum_"), F.min("first_").alias("any_"), top.alias("top_"))
    row = F.when(F.col("n_") > 2, F.col("top_")).otherwise(F.col("any_"))["r_"]
    return out.select(*keys, row.alias("r"), "sum_").select(*keys, "r.*", "sum_").withColumn(count, F.col("sum_")).drop("sum_").select(df.columns)
