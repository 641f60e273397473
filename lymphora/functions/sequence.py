"""Sequence functions as Column expressions (FN1-FN3, FN10, FN11, FN13, SIM1-SIM3, AUG4, MRG6), and the parser of slices (FN12)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The standard genetic code, codons in TCAG order.
AMINO = "FFLLSSSSYY**CC*WLLLLPPPPHHQQRRRRIIIMTTTTNNKKSSRRVVVVAAAADDEEGGGG"
CODONS = {a + b + c: AMINO[16 * i + 4 * j + k] for i, a in enumerate("TCAG") for j, b in enumerate("TCAG") for k, c in enumerate("TCAG")}
#: IUPAC letters and their complements.
LETTERS, COMPLEMENTS = "ACGTURYSWKMBDHVNacgturyswkmbdhvn", "TGCAAYRSWMKVHDBNtgcaayrswmkvhdbn"


def nt_to_aa(c: Column) -> Column:
    """Translation; unknown, lower-case and incomplete codons are *."""
    table = F.create_map(*(F.lit(x) for pair in CODONS.items() for x in pair))
    return F.array_join(F.transform(F.regexp_extract_all(c, F.lit("(.{1,3})"), 1), lambda x: F.coalesce(F.element_at(table, x), F.lit("*"))), "")


def reverse_complement(c: Column) -> Column:
    return F.reverse(F.translate(c, LETTERS, COMPLEMENTS))


def has_stop(c: Column) -> Column:
    """Whether a whole codon is a stop or unknown."""
    whole = F.substring(c, F.lit(1), F.length(c) - F.length(c) % 3)
    return nt_to_aa(whole).contains("*")


def characters(c: Column) -> Column:
    return F.when(c == "", F.array().cast("array<string>")).otherwise(F.split(c, ""))


def hamming(a: Column, b: Column) -> Column:
    """Null unless the lengths are equal."""
    d = F.size(F.filter(F.zip_with(characters(a), characters(b), lambda x, y: x != y), lambda v: v))
    return F.when(F.length(a) == F.length(b), d)


def alignment_errors(germline: Column, query: Column) -> Column:
    """AUG4: columns in which two alignment rows differ; null if either is empty."""
    return F.when((germline != "") & (query != ""), hamming(germline, query))


def edit_distance(a: Column, b: Column, most: int | None = None) -> Column:
    """With most, a distance beyond it is most + 1."""
    if most is None:
        return F.levenshtein(a, b)
    d = F.levenshtein(a, b, most)
    return F.when(d < 0, most + 1).otherwise(d)


def similar_cdr3(a: Column, b: Column, mismatches: float, core_start: int = 0, core_end: int = 0) -> Column:
    """SIM3: equal lengths and a Hamming distance up to mismatches, or that share of the length behind the core's start;
    with a core, what is before or what is behind it must be equal."""
    most = F.lit(mismatches) if mismatches >= 1 or mismatches == 0 else (F.length(a) - core_start) * mismatches
    ok = (F.length(a) == F.length(b)) & (hamming(a, b) <= most)
    if core_start or core_end:
        end = F.lit(core_end + 1)
        ok &= (F.substring(a, 1, core_start) == F.substring(b, 1, core_start)) | (F.substring(a, end, F.length(a)) == F.substring(b, end, F.length(b)))
    return ok


def gene_name(c: Column) -> Column:
    return F.substring_index(F.substring_index(c, " ", 1), "*", 1)


def same_gene(a: Column, b: Column) -> Column:
    return a.contains("*") & b.contains("*") & (F.substring_index(a, "*", 1) == F.substring_index(b, "*", 1))


def safe_divide(a: Column, b: Column) -> Column:
    return F.coalesce(F.try_divide(a, b), F.lit(0.0))


def sequence_hash(c: Column) -> Column:
    """S and four digits: the last four hexadecimal digits of the MD5 modulo 10000."""
    return F.concat(F.lit("S"), F.lpad((F.conv(F.right(F.md5(c), F.lit(4)), 16, 10).cast("int") % 10000).cast("string"), 4, "0"))


def unique_name(name: Column, sequence: Column) -> Column:
    """name with the sequence's hash, in place of an older one."""
    return F.concat(F.regexp_replace(name, "_S[^_]*$", ""), F.lit("_"), sequence_hash(sequence))


def slice_of(text: str) -> tuple[int | None, int | None]:
    """FN12: start and end of "2:-3"; either may be left out."""
    start, colon, end = text.partition(":")
    if not colon:
        raise ValueError(f"{text} is no slice")
    return (int(start) if start else None, int(end) if end else None)
