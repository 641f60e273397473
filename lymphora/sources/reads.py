"""Read files: kind, pairs, merging of pairs, trimming (SRC9-SRC12, PRE8, PRE9, PRE12)."""

from __future__ import annotations

import glob
import gzip
import os

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.sequence import reverse_complement

#: IUPAC letters and the bases that each stands for.
BASES = {"A": "A", "C": "C", "G": "G", "T": "T", "U": "T", "R": "AG", "Y": "CT", "S": "CG", "W": "AT", "K": "GT", "M": "AC", "B": "CGT", "D": "AGT", "H": "ACT", "V": "ACG", "N": "ACGTN"}


def first_reads(reads: DataFrame, n: int) -> DataFrame:
    """SRC10."""
    return reads.orderBy("_row").limit(n)


def kind(path: str) -> str:
    """SRC11: fasta or fastq, by a file's first letter."""
    with (gzip.open if path.endswith(".gz") else open)(path, "rt") as f:
        first = f.read(1)
    if first not in (">", "@"):
        raise ValueError(f"{path} is neither FASTA nor FASTQ")
    return "fasta" if first == ">" else "fastq"


def paired_file(path: str) -> str | None:
    """SRC12: the file that differs from path in having a 2 in the place of one 1, if there is just one."""
    folder, name = os.path.split(path)
    beside = set(glob.glob(os.path.join(glob.escape(folder), "*"))) if folder else set(glob.glob("*"))
    other = [os.path.join(folder, f"{name[:k]}2{name[k + 1 :]}") for k, c in enumerate(name) if c == "1"]
    found = [o for o in other if o in beside]
    return found[0] if len(found) == 1 else None


def overlap_length(a: Column, b: Column, least: int) -> Column:
    """The longest overlap of a's end with b's start, of least letters; null if there is none."""
    most = F.least(F.length(a), F.length(b))
    lengths = F.when(most >= least, F.sequence(most, F.lit(least), F.lit(-1)))
    return F.get(F.filter(lengths, lambda k: F.right(a, k) == F.left(b, k)), F.lit(0))


def merged_pairs(forward: DataFrame, reverse: DataFrame, least: int = 10) -> DataFrame:
    """SRC9: (name, sequence) of read pairs (name, sequence) whose forward read's end overlaps the reverse read's, complemented,
    exactly; pairs without such an overlap are left out."""
    pairs = forward.select("name", F.col("sequence").alias("a")).join(reverse.select("name", reverse_complement(F.col("sequence")).alias("b")), "name")
    k = pairs.withColumn("k", overlap_length(F.col("a"), F.col("b"), least)).where("k IS NOT NULL")
    return k.select("name", F.concat("a", F.substring("b", F.col("k") + 1, F.length("b"))).alias("sequence"))


def pattern(primer: str) -> str:
    return "".join(f"[{BASES[c]}]" if len(BASES[c]) > 1 else BASES[c] for c in primer.upper())


def trimmed(reads: DataFrame, forward: list[str], reverse: list[str], stranded: bool = False) -> DataFrame:
    """PRE9: reads that begin with a forward primer and end with a reverse primer's complement, without both. Unless
    stranded, a read's complement may fit instead. Others are discarded; without primers of a side, that side isn't cut."""
    def complement(p: str) -> str:
        return p[::-1].upper().translate(str.maketrans("ACGTURYSWKMBDHVN", "TGCAAYRSWMKVHDBN"))

    front = "^(?:" + "|".join(map(pattern, forward)) + ")" if forward else "^"
    back = "(?:" + "|".join(pattern(complement(p)) for p in reverse) + ")$" if reverse else "$"
    whole = f"{front}(.*?){back}"
    fit = lambda c: F.when(F.upper(c).rlike(whole), F.regexp_extract(F.upper(c), whole, 1))
    sides = [fit(F.col("sequence"))] + ([] if stranded else [fit(reverse_complement(F.upper("sequence")))])
    return reads.withColumn("sequence", F.coalesce(*sides)).where("sequence IS NOT NULL")


def repeated_names(reads: DataFrame, key: str = "barcode") -> DataFrame:
    """PRE8: (key, name, n) of names that occur more than once under a key."""
    return reads.groupBy(key, "name").agg(F.count("*").alias("n")).where("n > 1")


def write_by_barcode(reads: DataFrame, path: str, numbered: bool = False, mode: str = "error") -> None:
    """PRE12: a folder of FASTA text for each barcode; with numbered, folders are numbers in order of first occurrence."""
    key = "barcode"
    if numbered:
        first = reads.groupBy(key).agg(F.min("_row").alias("first"))  # a row for each barcode
        reads = reads.join(first.select(key, F.row_number().over(Window.orderBy("first")).alias("number")), key)
        key = "number"
    text = F.concat(F.lit(">"), "name", F.lit("\n"), "sequence").alias("value")
    reads.select(key, text).repartition(key).write.mode(mode).partitionBy(key).text(path)
