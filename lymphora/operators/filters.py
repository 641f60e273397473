"""Filters (FIL1-FIL6, FIL8-FIL12, FIL14, FIL16, FIL17; FIL7, FIL13 and FIL15 are in discovery). Each is a predicate on a DataFrame, so Catalyst pushes and merges them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def cascade(v_evalue: float = 1e-3, v_coverage: float = 90.0, j_coverage: float = 60.0) -> dict[str, Column]:
    """FIL1: the conditions of the pre-processing filter in order; null fails a condition."""
    return {
        "has_vj_assignment": (F.col("v_call") != "") & (F.col("j_call") != ""),
        "has_no_stop": F.col("stop_codon") == "F",
        "good_v_evalue": F.col("v_support") <= v_evalue,
        "good_v_coverage": F.col("V_covered") >= v_coverage,
        "good_j_coverage": F.col("J_covered") >= j_coverage,
    }


def quality_filter(df: DataFrame, **limits: float) -> DataFrame:
    for condition in cascade(**limits).values():
        df = df.where(condition)
    return df


def quality_statistics(df: DataFrame, **limits: float) -> DataFrame:
    """One row of cumulative counts, in one pass."""
    sums, upto = [F.count("*").alias("total")], F.lit(True)
    for name, condition in (cascade(**limits) | {"has_cdr3": F.col("cdr3") != ""}).items():
        upto = upto & F.coalesce(condition, F.lit(False))
        sums.append(F.coalesce(F.sum(upto.cast("long")), F.lit(0)).alias(name))
    return df.agg(*sums)


def exact_v(df: DataFrame) -> DataFrame:
    return df.where("V_errors = 0")


def unmutated_j(df: DataFrame) -> DataFrame:
    return df.where("J_SHM = 0")


def usable_cdr3(df: DataFrame, aa: str) -> DataFrame:
    return df.where((F.length("cdr3") > 0) & ~F.col(aa).contains("*"))


def d_match(df: DataFrame, coverage: float = 70.0, evalue: float = 1e-4) -> DataFrame:
    return df.where((F.col("D_errors") == 0) & (F.col("D_covered") >= coverage) & (F.col("d_support") <= evalue))


def shm_window(df: DataFrame, left: float, right: float) -> DataFrame:
    """FIL10: left <= V_SHM < right."""
    return df.where((F.col("V_SHM") >= left) & (F.col("V_SHM") < right))


def restricted(df: DataFrame, column: str, names: DataFrame, name: str = "name") -> DataFrame:
    """FIL9: rows whose call is among names."""
    return df.join(names.select(F.col(name).alias(column)).distinct(), column, "left_semi")


def marked(df: DataFrame, marks: dict[str, Column]) -> DataFrame:
    """FIL12: why_filtered, an array of the marks that hold, and is_filtered, their number."""
    why = F.filter(F.array(*(F.when(c, F.lit(k)) for k, c in marks.items())), lambda x: x.isNotNull())
    return df.withColumn("why_filtered", why).withColumn("is_filtered", F.size("why_filtered"))


def n_bases(c: Column) -> Column:
    """FIL14."""
    return F.length(c) - F.length(F.replace(c, F.lit("N")))


def count_filter(df: DataFrame, d_evalue: float | None = None, d_coverage: float | None = None, d_errors: int | None = None) -> DataFrame:
    """FIL6: those limits on D that are given."""
    for c, limit, ok in (("d_support", d_evalue, lambda x, y: x <= y), ("D_covered", d_coverage, lambda x, y: x >= y), ("D_errors", d_errors, lambda x, y: x <= y)):
        if limit is not None:
            df = df.where(ok(F.col(c), limit))
    return df


def frequent_rows(df: DataFrame, least: int, c: str = "count") -> DataFrame:
    """FIL8."""
    return df.where(F.col(c) >= least)


def long_enough(df: DataFrame, least: int, c: str = "sequence") -> DataFrame:
    """FIL11: the length counts a barcode that is still there."""
    return df.where(F.length(c) >= least)


def candidate_marks(low_diff: int = 0, max_n: int = 0, cdr3s: int = 1, shared: float = 1.0, js: int = 1, size: int = 0, allow_stop: bool = False) -> dict[str, Column]:
    """FIL12: the marks of the candidate filter. A whitelisted candidate may have a stop and a small cluster."""
    white = F.coalesce(F.col("whitelist_diff") == 0, F.lit(False))
    marks = {
        "too_low_dbdiff": F.col("database_diff") < low_diff,
        "too_many_N_bases": F.col("N_bases") > max_n,
        "too_low_CDR3s_exact": F.col("CDR3s_exact") < cdr3s,
        "too_high_CDR3_shared_ratio": F.col("CDR3_shared_ratio") > shared,
        "too_low_Js_exact": F.col("Js_exact") < js,
        "has_stop": (F.col("has_stop") != 0) & ~white,
        "too_low_cluster_size": (F.col("cluster_size") < size) & ~white,
    }
    return {k: c for k, c in marks.items() if not (allow_stop and k == "has_stop")}


#: Shares below which a run has gone wrong.
GATES = {"merged": 0.3, "trimmed": 0.1, "detected_cdr3s": 0.1}


def gates(counts: DataFrame) -> DataFrame:
    """FIL16: counts (total, merged, trimmed, detected_cdr3s, n) unchanged, or an error that names the share that is too low."""
    of = {"merged": "total", "trimmed": "total", "detected_cdr3s": "n"}
    for c, least in GATES.items():
        if c in counts.columns:
            low = F.coalesce(F.try_divide(F.col(c), F.col(of[c])) < least, F.lit(True))
            message = F.concat(F.lit(f"{c} is under {least} of "), F.lit(of[c]), F.lit(": "), F.coalesce(F.col(c).cast("string"), F.lit("null")))
            counts = counts.withColumn(c, F.when(low, F.raise_error(message).cast("long")).otherwise(F.col(c)))
    return counts
