"""Rearrangement and candidate tables as tab-separated files (SRC2-SRC6, SRC15, SNK1, SNK3-SNK6, SNK8, AUG13, AUG15)."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.sequence import nt_to_aa

#: Names of columns in older files, and what they are called now.
RENAMED = {
    "CDR3_clusters": "clonotypes", "name": "sequence_id", "genomic_sequence": "sequence", "VD_junction": "np1", "DJ_junction": "np2",
    "V_gene": "v_call", "D_gene": "d_call", "J_gene": "j_call", "V_evalue": "v_support", "D_evalue": "d_support", "J_evalue": "j_support",
    "CDR1_nt": "cdr1", "CDR1_aa": "cdr1_aa", "CDR2_nt": "cdr2", "CDR2_aa": "cdr2_aa", "CDR3_nt": "cdr3", "CDR3_aa": "cdr3_aa",
}
#: Columns that can be computed from others, and those others.
VIRTUAL = {
    "VDJ_nt": ["v_sequence_start", "j_sequence_end", "sequence"], "VDJ_aa": ["v_sequence_start", "j_sequence_end", "sequence"],
    "V_nt": ["v_sequence_alignment"], "V_aa": ["v_sequence_alignment_aa"], "D_region": ["d_sequence_alignment"],
    "J_nt": ["j_sequence_alignment"], "J_aa": ["j_sequence_alignment_aa"],
}
INTEGER = r"^(count|size|[VDJ]_errors|V_CDR3_start|CDR3_start|.*_(start|end|length|size|diff)|exact|full_exact|[A-Za-z0-9]+_exact|Js|CDR3s|clonotypes|N_bases|has_stop|is_filtered)$"
DOUBLE = r"^(.*_(score|support|identity|evalue|covered|SHM|aa_mut|ratio))$"
#: Written with one decimal.
ONE_DECIMAL = r"^(.*_(covered|SHM|aa_mut))$"


def computed(name: str) -> Column:
    """AUG15: a virtual column's expression."""
    span = F.substring(F.col("sequence"), F.col("v_sequence_start"), F.greatest(F.col("j_sequence_end") - F.col("v_sequence_start") + 1, F.lit(0)))
    ungapped = lambda c: F.replace(F.col(c), F.lit("-"), F.lit(""))
    return {
        "VDJ_nt": span, "VDJ_aa": nt_to_aa(span), "V_nt": ungapped("v_sequence_alignment"), "V_aa": F.col("v_sequence_alignment_aa"),
        "D_region": ungapped("d_sequence_alignment"), "J_nt": ungapped("j_sequence_alignment"), "J_aa": F.col("j_sequence_alignment_aa"),
    }[name]


def requested(columns: Iterable[str], available: Iterable[str]) -> tuple[list[str], list[str]]:
    """SRC4: columns to read for those wanted, under older names where a file has these, and the virtual ones to compute."""
    have, older = set(available), {new: old for old, new in RENAMED.items()}
    read, compute = [], []
    for c in columns:
        if c in have:
            read.append(c)
        elif c in older and older[c] in have:
            read.append(older[c])
        elif c in VIRTUAL:
            compute.append(c)
            read += requested(VIRTUAL[c], have)[0]
        else:
            raise ValueError(f"the table has no column {c}")
    return list(dict.fromkeys(read)), compute


def fixed(df: DataFrame, columns: list[str] | None = None, compute: Iterable[str] = ()) -> DataFrame:
    """SRC5: current names, numbers as numbers, no null strings, virtual columns, and the order asked for."""
    df = df.withColumnsRenamed({old: new for old, new in RENAMED.items() if old in df.columns and new not in df.columns})
    import re

    typed = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if f.dataType.typeName() == "string":
            kind = "int" if re.match(INTEGER, f.name) else "double" if re.match(DOUBLE, f.name) else None
            # 3.0 is a whole number too, as older writers had it
            c = c.try_cast("double").cast("int") if kind == "int" else c.try_cast("double") if kind else F.coalesce(c, F.lit(""))
        typed.append(c.alias(f.name))
    df = df.select(typed)
    df = df.withColumns({c: computed(c) for c in compute}) if compute else df
    return df.select(*columns) if columns else df


def _reader(reader, path: str, **options):
    return reader.options(sep="\t", header=True, quote="", nullValue="", **options).csv(path)


def read_table(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """SRC2: a current or older table. Only the columns asked for, and what they are computed from, are parsed."""
    df = _reader(spark.read, path)
    read, compute = requested(columns, df.columns) if columns else (df.columns, [])
    return fixed(df.select(read), columns, compute)


def table_stream(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """SRC3: the same for a folder that files arrive in; every micro-batch is a chunk."""
    known = _reader(spark.read, path)
    df = _reader(spark.readStream.schema(known.schema), path)
    read, compute = requested(columns, df.columns) if columns else (df.columns, [])
    return fixed(df.select(read), columns, compute)


def read_candidates(spark: SparkSession, path: str) -> DataFrame:
    """SRC6."""
    return fixed(_reader(spark.read, path))


def read_sections(spark: SparkSession, path: str) -> DataFrame:
    """SRC15: (section, line_no, line) of a file whose sections are parted by blank lines; sections are numbered in file order
    within a partition of the scan."""
    parts = spark.read.text(path, lineSep="\n\n").select(F.monotonically_increasing_id().alias("section"), F.regexp_replace("value", "^\n+|\n+$", "").alias("value"))
    return parts.where("value <> ''").select("section", F.posexplode(F.split("value", "\n")).alias("line_no", "line"))


def shown(df: DataFrame) -> DataFrame:
    """AUG13: columns of shares as text with one decimal, halves to even."""
    import re

    return df.select([F.format_string("%.1f", F.bround(f"`{c}`", 1)).alias(c) if re.match(ONE_DECIMAL, c) else F.col(f"`{c}`") for c in df.columns])


def write_tsv(df: DataFrame, path: str, mode: str = "error") -> None:
    """SNK1: a header in each part file; null is empty."""
    shown(df).write.mode(mode).options(sep="\t", header=True, quote="", nullValue="", emptyValue="").csv(path)


def write_json(stats: DataFrame, path: str, mode: str = "error") -> None:
    """SNK3: statistics, a few rows, as one JSON file."""
    stats.coalesce(1).write.mode(mode).json(path)


def sections(df: DataFrame, group: str, order: str, head: Column | None = None) -> DataFrame:
    """SNK4, SNK5: (group, value): a text section of each group: its rows, tab-separated, in order, and a line before them."""
    line = F.concat_ws("\t", *(F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in df.columns if c != group))
    rows = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(F.col(order).alias("at"), line.alias("line")))), lambda x: x["line"]), "\n")
    body = df.groupBy(group).agg(rows.alias("body"))
    return body.select(group, F.concat(*([head, F.lit("\n")] if head is not None else []), "body", F.lit("\n")).alias("value"))


def write_sections(df: DataFrame, path: str, mode: str = "error") -> None:
    df.select("value").write.mode(mode).text(path)


def read_names(candidates: DataFrame) -> DataFrame:
    """SNK6: a line for each candidate: its name and the names of its reads (array read_names)."""
    return candidates.select(F.concat_ws("\t", F.col("name"), F.array_sort("read_names")).alias("value"))


def cached(spark: SparkSession, folder: str, inputs: Iterable[str], compute: Callable[[], DataFrame]) -> DataFrame:
    """SNK8: the table that compute made from inputs (version, arguments, fingerprints of data), kept under a digest of them.
    A table counts once its commit marker is there, so a run that broke off is repeated."""
    path = f"{folder.rstrip('/')}/{hashlib.md5(chr(0).join(inputs).encode()).hexdigest()}"
    jvm = spark.sparkContext._jvm
    marker = jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    if not marker.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(marker):
        compute().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def fingerprint(df: DataFrame) -> str:
    """A digest of a table's rows in any order."""
    n, s = df.agg(F.count("*"), F.sum(F.xxhash64(*df.columns).cast("decimal(38,0)"))).first()
    return f"{n}:{s}:{','.join(df.columns)}"
