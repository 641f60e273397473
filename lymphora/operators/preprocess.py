"""Read pre-processing (PRE1-PRE7, PRE10, PRE11, PRE13)."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .consensus import consensus


def barcode(c: Column, length: int) -> Column:
    """PRE1: a prefix, or a suffix if length is negative."""
    return F.left(c, F.lit(length)) if length > 0 else F.right(c, F.lit(-length))


def unbarcoded(c: Column, length: int) -> Column:
    return F.substring(c, F.lit(length + 1), F.length(c)) if length > 0 else F.left(c, F.greatest(F.length(c) + length, F.lit(0)))


def trim_g(c: Column) -> Column:
    """PRE2."""
    return F.regexp_replace(c, "^G+", "")


def dereplicate(reads: DataFrame) -> DataFrame:
    """PRE3: distinct sequences (columns name, sequence, _row), the first name and the number of copies."""
    return reads.groupBy("sequence").agg(F.min_by("name", "_row").alias("name"), F.count("*").alias("size"), F.min("_row").alias("_row"))


def hamming_neighbours(df: DataFrame, c: str) -> DataFrame:
    """PRE6: (c, neighbour): all strings with at most one other base."""
    subst = F.flatten(F.transform(F.sequence(F.lit(1), F.length(c)), lambda i: F.transform(F.array(*map(F.lit, "ACGT")), lambda b: F.concat(F.substring(F.col(c), F.lit(1), i - 1), b, F.substring(F.col(c), i + 1, F.length(c))))))
    return df.where(F.length(c) > 0).select(c).distinct().select(c, F.explode(F.array_distinct(F.concat(F.array(c), subst))).alias("neighbour"))


def barcode_statistics(df: DataFrame, key: str = "barcode") -> DataFrame:
    """PRE10."""
    sizes = df.groupBy(key).agg(F.count("*").alias("n"))
    return sizes.agg(F.count("*").alias("unique_barcodes"), F.sum((F.col("n") == 1).cast("long")).alias("singletons"), F.sum((F.col("n") == 2).cast("long")).alias("pairs"), F.sum((F.col("n") > 2).cast("long")).alias("larger"))


def length_histogram(df: DataFrame, c: str) -> DataFrame:
    """PRE11."""
    return df.groupBy(F.length(c).alias("length")).agg(F.count("*").alias("frequency"))


def names_by_sequence(df: DataFrame, name: str, sequence: str) -> DataFrame:
    """PRE13."""
    return df.groupBy(sequence).agg(F.array_join(F.array_sort(F.collect_list(name)), ",").alias("names"))


def group_reads(reads: DataFrame, length: int, pseudo_cdr3: tuple[int, int] | None = None, trim: bool = False, minimum: int = 0) -> DataFrame:
    """PRE4, PRE5, PRE7: reads (_row, name, sequence) by barcode and pseudo-CDR3 cluster: a representative each.

    Groups of one or two give their first read; larger ones a consensus (0.501), or the first read if it has an N.
    """
    own = reads.where(F.length("sequence") >= minimum).select("_row", "name", barcode(F.col("sequence"), length).alias("barcode"), unbarcoded(F.col("sequence"), length).alias("body"))
    if trim:
        own = own.withColumn("body", trim_g(F.col("body")))

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("_row")
        rows = list(zip(pdf["name"], pdf["body"]))
        out = []
        for cdr3, group in clusters(rows, pseudo_cdr3):
            name, seq = group[0]
            if len(group) >= 3:
                c = consensus([s for _, s in group], 0.501)
                if "N" not in c:
                    name, seq = None, c
            out.append((pdf["barcode"].iloc[0], cdr3, name, len(group), seq, len(out)))
        return pd.DataFrame(out, columns=["barcode", "cdr3", "name", "size", "sequence", "k"])

    return own.groupBy("barcode").applyInPandas(run, "barcode string, cdr3 string, name string, size int, sequence string, k int")


def clusters(rows: list[tuple[str, str]], at: tuple[int, int] | None) -> list[tuple[str | None, list[tuple[str, str]]]]:
    """Single linkage by pseudo-CDR3 (at most one mismatch), parted where sorted lengths jump by more than 2.

    Without a range all rows are one cluster. Rows without a pseudo-CDR3 are left out.
    """
    if at is None:
        return [(None, rows)]
    by: dict[str, list[tuple[str, str]]] = {}
    for row in rows:
        piece = row[1][at[0] : at[1]]
        if piece:
            by.setdefault(piece, []).append(row)
    left, out = list(by), []
    while left:
        found, todo = [], [left.pop(0)]
        while todo:
            x = todo.pop()
            found.append(x)
            near = [y for y in left if len(y) == len(x) and sum(p != q for p, q in zip(x, y)) <= 1]
            left = [y for y in left if y not in near]
            todo += near
        members = sorted((r for x in found for r in by[x]), key=lambda r: len(r[1]))
        group: list[tuple[str, str]] = []
        for r in members:
            if group and len(r[1]) - len(group[-1][1]) > 2:
                out.append(group)
                group = []
            group.append(r)
        out.append(group)
    named = []
    for g in out:
        counts: dict[str, int] = {}
        for _, s in g:
            counts[s[at[0] : at[1]]] = counts.get(s[at[0] : at[1]], 0) + 1
        named.append((max(counts, key=counts.get), g))
    return named


def renumbered(df: DataFrame, prefix: str, *order: str) -> DataFrame:
    """AUG12: names prefix1, prefix2 ... in the order given. For small results: one task numbers all rows."""
    return df.withColumn("name", F.concat(F.lit(prefix), F.row_number().over(Window.orderBy(*order))))
