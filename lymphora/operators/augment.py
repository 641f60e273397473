"""Columns computed from an aligner's table and a germline database (AUG1-AUG11, AUG14, AUG17). All are Column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.cdr3 import J_START, cdr3_end, cdr3_start
from ..functions.sequence import alignment_errors, hamming, nt_to_aa

#: Regions of V and the columns that give their places.
REGIONS = {"FR1": "fwr1", "CDR1": "cdr1", "FR2": "fwr2", "CDR2": "cdr2", "FR3": "fwr3"}
LOCI = tuple(J_START)
#: Rows of a germline table up to which it is broadcast; a larger one is joined by shuffle.
BROADCAST_ROWS = 20_000


def small(df: DataFrame, most: int = BROADCAST_ROWS) -> DataFrame:
    """df with a broadcast hint if it has at most so many rows."""
    return F.broadcast(df) if df.limit(most + 1).count() <= most else df


def clean_call(c: Column) -> Column:
    """AUG1."""
    return F.regexp_replace(c, "^%+", "")


def header_fields(c: Column) -> dict[str, Column]:
    """AUG3: name, count and barcode of a header name;size=12;barcode=ACG; where of repeated fields the last counts."""
    fields = F.slice(F.split(c, ";"), 2, 1 << 20)
    last = lambda key: F.element_at(F.filter(fields, lambda f: F.startswith(f, F.lit(key + "="))), -1)
    has = lambda key: F.exists(fields, lambda f: F.startswith(f, F.lit(key + "=")))
    value = lambda key: F.when(has(key), F.substring(last(key), F.lit(len(key) + 2), F.length(last(key))))
    return {"sequence_id": F.substring_index(c, ";", 1), "count": value("size").cast("int"), "barcode": value("barcode")}


def errors(germline: Column, query: Column) -> Column:
    """AUG4: alignment columns that differ, null if a row is empty; rows of unequal lengths are an error."""
    both = (germline != "") & (query != "")
    return F.when(both & (F.length(germline) != F.length(query)), F.raise_error(F.lit("alignment rows differ in length")).cast("int")).otherwise(alignment_errors(germline, query))


def ungapped(c: Column) -> Column:
    return F.replace(c, F.lit("-"), F.lit(""))


def covered(alignment: Column, length: Column) -> Column:
    """AUG5: per cent of the gene that the alignment covers."""
    return F.when((alignment != "") & length.isNotNull(), F.length(ungapped(alignment)) / length * 100.0)


def query_position(gene: str, reference: Column) -> Column:
    """AUG9: the place in the query, 0-based, of a place in the reference; null if the alignment of gene doesn't reach it."""
    of = lambda c: F.col(f"{gene}_{c}")
    bases = reference - (of("germline_start") - 1)
    # as much of the germline row as has so many bases
    head = F.call_function("regexp_extract", of("germline_alignment"), F.concat(F.lit("^(?:-*[^-]){"), F.greatest(bases, F.lit(0)).cast("string"), F.lit("}")), F.lit(0))
    reached = (bases > 0) & (F.length(ungapped(of("germline_alignment"))) >= bases)
    return F.when(bases == 0, of("sequence_start") - 1).when(reached, of("sequence_start") - 1 + F.length(ungapped(F.left(of("sequence_alignment"), F.length(head)))))


def regions(v: DataFrame) -> DataFrame:
    """AUG14: V genes (gene, sequence, fwr1_start ... fwr3_end, 1-based) with the nucleotides and amino acids of their regions.
    A gene has them only if all five exist, are whole codons and have no stop."""
    cut = {r: F.substring(F.col("sequence"), F.col(f"{c}_start"), F.col(f"{c}_end") - F.col(f"{c}_start") + 1) for r, c in REGIONS.items()}
    ok = F.lit(True)
    for nt in cut.values():
        ok &= F.coalesce((F.length(nt) > 0) & (F.length(nt) % 3 == 0) & ~nt_to_aa(nt).contains("*"), F.lit(False))
    return v.select("gene", "sequence", *(F.when(ok, nt).alias(f"{r}_nt") for r, nt in cut.items()), *(F.when(ok, nt_to_aa(nt)).alias(f"{r}_aa") for r, nt in cut.items()))


def bounds(c: Column, f) -> Column:
    """f(c, locus) for all known loci, as a map: a gene's motif is sought once, not for each read."""
    return F.create_map(*(x for name in LOCI for x in (F.lit(name), f(c, name))))


def region_mutation(nt: bool = True) -> dict[str, Column]:
    """AUG6, AUG7: per cent of bases or amino acids of each V region that differ from the germline's, and for amino acids of all."""
    out: dict[str, Column] = {}
    if nt:
        for r, c in REGIONS.items():
            query = F.substring(F.col("sequence"), F.col(f"{c}_start"), F.greatest(F.col(f"{c}_end") - F.col(f"{c}_start") + 1, F.lit(0)))
            out[f"{r}_SHM"] = 100.0 * F.levenshtein(F.col(f"v_{r}_nt"), query) / F.length(f"v_{r}_nt")
        return out
    distances, lengths = [], []
    for r, c in REGIONS.items():
        query = nt_to_aa(F.substring(F.col("sequence"), F.col(f"{c}_start"), F.greatest(F.col(f"{c}_end") - F.col(f"{c}_start") + 1, F.lit(0))))
        n = F.length(f"v_{r}_aa")
        d = hamming(F.col(f"v_{r}_aa"), query)
        d = F.when(d / n < 0.8, d)  # more means that something went wrong
        out[f"{r}_aa_mut"] = 100.0 * d / n
        distances.append(d)
        lengths.append(n)
    out["V_aa_mut"] = 100.0 * sum(distances[1:], distances[0]) / sum(lengths[1:], lengths[0])  # null if a region is
    return out


def augmented(rows: DataFrame, v: DataFrame, d: DataFrame, j: DataFrame) -> DataFrame:
    """The aligner's table with all computed columns.

    v, d and j are germline tables (gene, sequence), v with the coordinates of regions(). They are joined by
    broadcast as long as they are small.
    """
    rows = rows.withColumns({c: clean_call(F.col(c)) for c in ("v_call", "d_call", "j_call")})
    v = regions(v).withColumnsRenamed({"gene": "v_call", "sequence": "v_gene_sequence"} | {f"{r}_{k}": f"v_{r}_{k}" for r in REGIONS for k in ("nt", "aa")})
    v = v.withColumn("v_bounds_", bounds(F.col("v_gene_sequence"), cdr3_start))
    rows = rows.join(small(v), "v_call", "left")
    rows = rows.join(small(d.select(F.col("gene").alias("d_call"), F.length("sequence").alias("d_length"))), "d_call", "left")
    rows = rows.join(small(j.select(F.col("gene").alias("j_call"), F.col("sequence").alias("j_gene_sequence"), bounds(F.col("sequence"), cdr3_end).alias("j_bounds_"))), "j_call", "left")
    rows = rows.withColumns({"V_SHM": 100.0 - F.col("v_identity"), "J_SHM": 100.0 - F.col("j_identity")} | header_fields(F.col("sequence_id")))
    rows = rows.withColumns({f"{g.upper()}_errors": errors(F.col(f"{g}_germline_alignment"), F.col(f"{g}_sequence_alignment")) for g in "vdj"})
    lengths = {"v": F.length("v_gene_sequence"), "d": F.col("d_length"), "j": F.length("j_gene_sequence")}
    rows = rows.withColumns({f"{g.upper()}_covered": covered(F.col(f"{g}_germline_alignment"), n) for g, n in lengths.items()})
    rows = rows.withColumns(region_mutation() | region_mutation(False))
    rows = with_cdr3(rows)
    return with_fwr4(rows).drop("v_gene_sequence", "j_gene_sequence", "d_length", "v_bound_", "j_bound_", "v_bounds_", "j_bounds_", *(f"v_{r}_{k}" for r in REGIONS for k in ("nt", "aa")))


def with_cdr3(rows: DataFrame) -> DataFrame:
    """AUG8, AUG10: the CDR3 between the places that V's and J's motifs have in the query. Beyond the V alignment its
    start is counted on from the alignment's end; without a J place the columns stay as they were."""
    rows = rows.withColumns({"v_bound_": F.try_element_at("v_bounds_", F.col("locus")), "j_bound_": F.try_element_at("j_bounds_", F.col("locus"))})
    begin = F.coalesce(query_position("v", F.col("v_bound_")), F.col("v_sequence_end") + (F.col("v_bound_") - F.col("v_germline_end")))
    rows = rows.withColumns({"begin_": begin, "end_": query_position("j", F.col("j_bound_"))})
    ok = (F.col("v_call") != "") & (F.col("j_call") != "") & F.col("begin_").isNotNull() & F.col("end_").isNotNull()
    nt = F.substring(F.col("sequence"), F.col("begin_") + 1, F.greatest(F.col("end_") - F.col("begin_"), F.lit(0)))
    rows = rows.withColumns({"cdr3_start": F.when(ok, F.col("begin_") + 1).otherwise(F.col("cdr3_start")), "cdr3_end": F.when(ok, F.col("end_")).otherwise(F.col("cdr3_end")), "cdr3": F.when(ok, nt).otherwise(F.col("cdr3"))})
    rows = rows.withColumn("cdr3_aa", F.when(ok, nt_to_aa(F.col("cdr3"))).otherwise(F.col("cdr3_aa")))
    known = (F.col("v_call") != "") & (F.coalesce("cdr3_start", F.lit(0)) > 0)
    return rows.withColumn("V_CDR3_start", F.when(known, F.col("cdr3_start") - F.col("v_sequence_start")).otherwise(0)).drop("begin_", "end_")


def with_fwr4(rows: DataFrame) -> DataFrame:
    """AUG11: FR4 from the CDR3's end to J's, and how it differs from the germline J."""
    ok = (F.col("j_call") != "") & F.col("j_bound_").isNotNull() & (F.coalesce("cdr3_end", F.lit(0)) > 0)
    nt = F.substring(F.col("sequence"), F.col("cdr3_end") + 1, F.greatest(F.col("j_sequence_end") - F.col("cdr3_end"), F.lit(0)))
    germline = F.substring(F.col("j_gene_sequence"), F.col("j_germline_start"), F.col("j_germline_end") - F.col("j_germline_start") + 1)
    return rows.withColumns({
        "fwr4_start": F.when(ok, F.col("cdr3_end") + 1), "fwr4_end": F.when(ok, F.col("j_sequence_end")), "fwr4": F.when(ok, nt), "fwr4_aa": F.when(ok, nt_to_aa(nt)),
        "FR4_SHM": F.when(ok, 100.0 * F.levenshtein(germline, nt) / F.length(germline)),
        "J_aa_mut": F.when(ok, 100.0 * F.levenshtein(nt_to_aa(germline), nt_to_aa(nt)) / F.length(nt_to_aa(germline))),
    })


def v_without_cdr3(rows: DataFrame) -> DataFrame:
    """AUG17: V_no_CDR3."""
    start = F.col("V_CDR3_start")
    return rows.withColumn("V_no_CDR3", F.when(start == 0, F.col("V_nt")).when(start < 0, F.left("V_nt", F.greatest(F.length("V_nt") + start, F.lit(0)))).otherwise(F.left("V_nt", start)))
