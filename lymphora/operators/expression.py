"""Counts and other aggregates (AGG1, AGG4, AGG5, AGG7, AGG8, AGG13, AGG14, AGG17, AGG18, MRG4, JOI17)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def distinct_nonempty(c: str) -> Column:
    return F.count_distinct(F.nullif(F.col(c), F.lit("")))


def gene_usage(df: DataFrame, gene: str) -> DataFrame:
    """AGG1: for V, D or J: rows, distinct CDR3s and distinct other genes; rows without the gene are left out."""
    call = f"{gene.lower()}_call"
    others = [distinct_nonempty(f"{g.lower()}_call").alias(f"unique_{g}") for g in "VDJ" if g != gene]
    return df.where(F.col(call) != "").groupBy(F.col(call).alias("gene")).agg(F.count("*").alias("count"), distinct_nonempty("cdr3").alias("unique_CDR3"), *others)


def with_all_genes(usage: DataFrame, genes: DataFrame) -> DataFrame:
    """JOI17: a row for each gene of genes, zero if it isn't expressed."""
    return genes.select("gene").distinct().join(usage, "gene", "left").na.fill(0)


def above_allele_ratio(usage: DataFrame, ratio: float) -> DataFrame:
    """MRG4 without cross-mapping: alleles with at least ratio times the gene's largest unique_CDR3."""
    w = Window.partitionBy(F.substring_index("gene", "*", 1))
    return usage.withColumn("top_", F.max("unique_CDR3").over(w)).where(F.col("unique_CDR3") >= ratio * F.col("top_")).drop("top_")


def shared_cdr3(df: DataFrame, key: str) -> DataFrame:
    """AGG4: per key: distinct CDR3s, and those that also occur under another key."""
    counts = df.where("cdr3 <> ''").groupBy(key, "cdr3").agg(F.count("*").alias("n"))
    other = F.sum("n").over(Window.partitionBy("cdr3")) - F.col("n")
    return counts.withColumn("other", other).groupBy(key).agg(F.count("*").alias("unique_CDR3"), F.sum((F.col("other") > 0).cast("long")).alias("shared"))


def mode(df: DataFrame, key: str, value: str) -> DataFrame:
    """AGG5: the most frequent value of each key, of equals the least."""
    counts = df.groupBy(key, value).agg(F.count("*").alias("n"))
    return counts.withColumn("k", F.row_number().over(Window.partitionBy(key).orderBy(F.desc("n"), value))).where("k = 1").drop("k")


def coexpression(df: DataFrame, a: str, b: str) -> DataFrame:
    return df.groupBy(a, b).agg(F.count("*").alias("count"))


def allele_matrix(df: DataFrame, row: str, column: str, values: list[str]) -> DataFrame:
    """AGG8: counts of column's values, a column each."""
    return df.groupBy(row).pivot(column, values).count().na.fill(0)


def prefix_equivalence(df: DataFrame, c: str, unit: int | None = None) -> DataFrame:
    """AGG13: distinct rows of c in order; a run goes on while a value begins with the one before; size of each value's run.

    Values with a common prefix share their first unit characters, as many as the shortest has, so these deal out the work.
    Empty values are left out.
    """
    df = df.where(F.length(c) > 0)
    unit = unit or min(16, df.agg(F.min(F.length(c))).first()[0] or 1)
    w = Window.partitionBy(F.substring(c, 1, unit)).orderBy(c)
    fresh = ~F.coalesce(F.startswith(F.col(c), F.lag(c).over(w)), F.lit(False))
    runs = df.withColumn("fresh_", fresh.cast("int")).withColumn("run_", F.sum("fresh_").over(w))
    return runs.withColumn("run_size", F.count("*").over(Window.partitionBy(F.substring(c, 1, unit), "run_"))).drop("fresh_", "run_")


def frequent(df: DataFrame, c: str, occurrences: int, length: int) -> DataFrame:
    """AGG14."""
    return df.where(F.length(c) >= length).groupBy(c).agg(F.count("*").alias("count")).where(F.col("count") >= occurrences)


def histogram(df: DataFrame, key: str, c: str, bins: int) -> DataFrame:
    """AGG17: rows of bins of width 1; values beyond the last are left out."""
    return df.where((F.col(c) >= 0) & (F.col(c) < bins)).groupBy(key, F.floor(c).cast("int").alias("bin")).agg(F.count("*").alias("count"))


def nth_longest(df: DataFrame, key: str, c: str, n: int = 10) -> DataFrame:
    """AGG18: the n-th longest length of each key, the shortest if there are fewer."""
    w = Window.partitionBy(key).orderBy(F.desc(F.length(c)))
    ranked = df.select(key, F.length(c).alias("length"), F.row_number().over(w).alias("k")).where(F.col("k") <= n)
    return ranked.groupBy(key).agg(F.min("length").alias("length"))
