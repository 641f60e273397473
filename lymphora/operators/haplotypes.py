"""Haplotypes from co-occurring alleles (HAP3-HAP5, SRT2)."""

from __future__ import annotations

from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .augment import small
from .database import expressed_alleles

#: Share of an allele's rows that a het allele has at least for it to be expressed on that chromosome.
EXPRESSED = 0.1


def usage(rows: DataFrame, kind: str) -> DataFrame:
    """Expressed alleles (gene, count) of V, D or J."""
    call = f"{kind.lower()}_call"
    return expressed_alleles(rows.where(F.col(call) != "").groupBy(F.col(call).alias("gene")).agg(F.count("*").alias("count")))


def cooccurrences(rows: DataFrame, het_kind: str, het: tuple[str, str], target_kind: str, targets: DataFrame) -> DataFrame:
    """HAP3: (gene, haplotype1, haplotype2, type, count1, count2) of target alleles (gene, count) by the two alleles of
    a heterozygous gene. A gene's alleles are few, so they are gathered in one row."""
    a, b = f"{het_kind.lower()}_call", f"{target_kind.lower()}_call"
    counts = rows.where(F.col(a).isin(*het)).groupBy(F.col(b).alias("allele")).agg(*(F.sum((F.col(a) == h).cast("long")).alias(f"n{k}") for k, h in enumerate(het, 1)))
    own = targets.select(F.col("gene").alias("allele")).join(counts, "allele", "left").na.fill(0)
    total = F.col("n1") + F.col("n2") + 1
    own = own.withColumns({"e1": F.col("n1") / total >= EXPRESSED, "e2": F.col("n2") / total >= EXPRESSED}).where("e1 OR e2")
    gene = own.groupBy(F.substring_index("allele", "*", 1).alias("gene")).agg(F.sort_array(F.collect_list(F.struct("allele", "n1", "n2", "e1", "e2"))).alias("x"))
    one, two = F.size("x") == 1, F.size("x") == 2
    at = lambda k: F.element_at("x", k)
    only = lambda x, k: x[f"e{k}"] & ~x[f"e{3 - k}"]
    row = lambda h1, h2, kind, c1, c2: F.struct(h1.alias("haplotype1"), h2.alias("haplotype2"), kind.alias("type"), c1.alias("count1"), c2.alias("count2"))
    shown = lambda x, k: F.when(x[f"e{k}"], x["allele"]).otherwise("")
    each = lambda kind: F.transform("x", lambda x: row(shown(x, 1), shown(x, 2), kind, x["n1"], x["n2"]))
    pair = lambda p, q: F.array(row(at(p)["allele"], at(q)["allele"], F.lit("heterozygous"), at(p)["n1"], at(q)["n2"]))
    marks = F.aggregate("x", F.lit(0), lambda s, x: s + x["e1"].cast("int") + x["e2"].cast("int"))
    several = F.when(F.exists("x", lambda x: x["e1"] != x["e2"]) & (marks > 2), F.lit("duplication")).otherwise("unknown")
    found = F.when(one, each(F.when(at(1)["e1"] & at(1)["e2"], F.lit("homozygous")).otherwise("deletion")))
    found = found.when(two & only(F.try_element_at("x", F.lit(1)), 1) & only(F.try_element_at("x", F.lit(2)), 2), F.when(two, pair(1, 2)))
    found = found.when(two & only(F.try_element_at("x", F.lit(1)), 2) & only(F.try_element_at("x", F.lit(2)), 1), F.when(two, pair(2, 1)))
    return gene.select("gene", F.explode(found.otherwise(each(several))).alias("r")).select("gene", "r.*")


def heterozygous(alleles: list[tuple[str, int]], most: int = 5) -> list[tuple[str, str]]:
    """HAP2 on collected usage: pairs of the alleles of genes that have two, the most expressed genes first."""
    genes: dict[str, list[tuple[str, int]]] = {}
    for name, n in sorted(alleles):
        genes.setdefault(name.split("*")[0], []).append((name, n))
    two = sorted((g for g in genes.values() if len(g) == 2), key=lambda g: (-sum(n for _, n in g), g[0][0]))
    return [(g[0][0], g[1][0]) for g in two[:most]]


def haplotypes(rows: DataFrame, order: DataFrame | None = None) -> DataFrame:
    """HAP4, HAP5: blocks (kind, het1, het2, gene, haplotype1, haplotype2, type, count1, count2) of J, D and V.

    Pairs of a heterozygous J and V gene, at most 25, are tried until both come out as heterozygous themselves; else the
    first pair is taken. J's columns are swapped if V's are the other way round. Only usage and block rows, a few hundred,
    reach the driver.
    """
    spark = rows.sparkSession
    rows = rows.select("v_call", "d_call", "j_call")
    used = {k: usage(rows, k) for k in "VDJ"}
    hets = {k: heterozygous([tuple(r) for r in used[k].select("gene", "count").collect()]) or [None] for k in "VJ"}
    first = None
    for j, v in product(hets["J"], hets["V"]):
        blocks, names = [], {n for pair in (j, v) if pair for n in pair}
        for target, kind, pair in (("J", "V", v), ("D", "J", j), ("V", "J", j)):
            if pair:
                blocks.append((target, pair, [tuple(r) for r in cooccurrences(rows, kind, pair, target, used[target]).orderBy("gene", "haplotype1", "haplotype2").collect()]))
        first = first or blocks
        bad = any(n in names and r[3] != "heterozygous" for target, _, found in blocks if target != "D" for r in found for n in r[1:3])
        if not bad or j is None or v is None:
            break
    else:
        blocks = first
    if len(blocks) == 3:
        (jt, jp, jr), _, (_, vp, _) = blocks
        if any((r[1], r[2]) == (vp[1], vp[0]) for r in jr):
            blocks[0] = (jt, (jp[1], jp[0]), [(g, b, a, kind, n2, n1) for g, a, b, kind, n1, n2 in jr])
    flat = [(target, *pair, *r) for target, pair, found in blocks for r in found]
    out = spark.createDataFrame(flat, "kind string, het1 string, het2 string, gene string, haplotype1 string, haplotype2 string, type string, count1 long, count2 long")
    return out if order is None else ordered(out, order, F.when(F.col("haplotype1") != "", F.col("haplotype1")).otherwise(F.col("haplotype2")))


def ordered(df: DataFrame, order: DataFrame, name: Column, strict: bool = False) -> DataFrame:
    """SRT2: df in the order of genes in order (gene, rank), then by allele number; genes that order hasn't go last, or raise."""
    allele = F.coalesce(F.regexp_extract(name, r"\*(\d+)$", 1).try_cast("int"), F.lit(999))
    rank = order.select(F.col("gene").alias("gene__"), F.col("rank").alias("rank__"))
    out = df.join(small(rank), F.substring_index(F.substring_index(name, " ", 1), "*", 1) == F.col("gene__"), "left")
    missing = F.raise_error(F.concat(F.lit("no place for "), name)).cast("int") if strict else F.lit(1_000_000)
    return out.orderBy(F.coalesce("rank__", missing) * 1000 + allele, name).drop("gene__", "rank__")
