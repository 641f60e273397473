"""Germline database operators: joins of sequence tables (JOI3, JOI5, JOI6, JOI10, JOI12, JOI13, JOI15, SRT1) and elimination (GER1-GER10, HAP1, HAP2)."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.sequence import edit_distance, same_gene
from .augment import small
from .clustering import components
from .filters import marked


def intersection(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    """JOI3: the lesser count of each key that both have."""
    x, y = (d.groupBy(*keys).agg(F.count("*").alias(n)) for d, n in ((a, "x"), (b, "y")))
    return x.join(y, keys).select(*keys, F.least("x", "y").alias("count"))


def substrings(needles: DataFrame, haystacks: DataFrame) -> DataFrame:
    """JOI5: (needle, haystack) with needle inside. Needles are cut from haystacks by their lengths and joined by
    value, so haystacks aren't compared with each needle."""
    needles = needles.where(F.length("needle") > 0)
    lengths = needles.select(F.length("needle").alias("k")).distinct().agg(F.collect_set("k").alias("ks"))
    pieces = haystacks.select("haystack").distinct().join(F.broadcast(lengths), F.lit(True)).withColumn("k", F.explode("ks")).where(F.length("haystack") >= F.col("k"))
    cut = F.array_distinct(F.transform(F.sequence(F.lit(1), F.length("haystack") - F.col("k") + 1), lambda i: F.substring(F.col("haystack"), i, F.col("k"))))
    return pieces.select("haystack", F.explode(cut).alias("needle")).join(needles.distinct(), "needle").select("needle", "haystack")


def starting_with(df: DataFrame, c: str, candidates: DataFrame, candidate: str) -> DataFrame:
    """JOI6: rows of df whose c begins with a candidate, joined on prefixes of the candidates' lengths."""
    lengths = candidates.select(F.length(candidate).alias("k")).distinct().agg(F.collect_set("k").alias("ks"))
    cut = df.join(F.broadcast(lengths), F.lit(True)).withColumn("k", F.explode("ks")).where(F.length(c) >= F.col("k")).withColumn("p_", F.substring(F.col(c), F.lit(1), F.col("k")))
    return cut.join(candidates.withColumnRenamed(candidate, "p_"), "p_").drop("k", "ks").withColumnRenamed("p_", candidate)


def nearest(queries: DataFrame, targets: DataFrame) -> DataFrame:
    """JOI10: for each query (name, sequence) the nearest target by edit distance, ties by name. Distinct sequences are compared with
    all targets, as the answer may be any: targets are a germline database, broadcast as long as it is small."""
    t = small(targets.select(F.struct(F.col("name").alias("t")).alias("t"), F.col("sequence").alias("ts")))
    best = F.min(F.struct(edit_distance(F.col("sequence"), F.col("ts")).alias("d"), F.col("t.t").alias("t")))
    found = queries.select("sequence").distinct().join(t, F.length("ts") >= 0).groupBy("sequence").agg(best.alias("b"))
    return queries.join(found, "sequence").select("name", F.col("b.d").alias("distance"), F.col("b.t").alias("closest"))


def whitelisted(candidates: DataFrame, whitelist: DataFrame) -> DataFrame:
    """JOI12: candidates with whitelist_diff 0 where their consensus is a whitelisted sequence, else null."""
    known = whitelist.select(F.col("sequence").alias("consensus"), F.lit(0).alias("whitelist_diff")).distinct()
    return candidates.join(known, "consensus", "left")


def chimeras(queries: DataFrame, references: DataFrame, least: int = 10) -> DataFrame:
    """JOI13: queries (name, sequence) that are a prefix of one reference and a suffix of another, both of least bases: the smallest
    split, and of each side the first reference by _row, or by name if there is no such column."""
    splits = queries.where(F.length("sequence") >= 2 * least).select("name", "sequence", F.explode(F.sequence(F.lit(least), F.length("sequence") - least)).alias("k"))
    halves = splits.withColumns({"left": F.substring("sequence", F.lit(1), F.col("k")), "right": F.substring("sequence", F.col("k") + 1, F.length("sequence"))})
    first = F.col("_row") if "_row" in references.columns else F.col("name")
    r = references.where(F.length("sequence") >= least).select(F.struct(first.alias("at"), "name", F.length("sequence").alias("n")).alias("r"), F.col("sequence").alias("s"))
    ks = r.select("r", "s", F.explode(F.sequence(F.lit(least), F.length("s"))).alias("k"))
    heads = ks.select(F.substring("s", F.lit(1), F.col("k")).alias("left"), "r").groupBy("left").agg(F.min("r").alias("p"))
    tails = ks.select(F.substring("s", F.length("s") - F.col("k") + 1, F.col("k")).alias("right"), "r").groupBy("right").agg(F.min("r").alias("q"))
    best = halves.join(heads, "left").join(tails, "right").groupBy("name").agg(F.min(F.struct("k", "p", "q", F.length("sequence").alias("n"))).alias("b"))
    return best.select("name", "b.k", F.col("b.p.name").alias("prefix_of"), F.col("b.q.name").alias("suffix_of"), F.col("b.q.n").alias("suffix_end"), F.col("b.n").alias("length"))


def chimera_text(candidates: DataFrame, whitelisted: bool = True) -> DataFrame:
    """GER9: (name, chimera) of candidates that aren't known, as ref:1..k+ref:a..b, from whitelisted or else database ones."""
    known = F.col("whitelist_diff" if whitelisted else "database_diff") == 0
    new = candidates.where("coalesce(whitelist_diff, 1) <> 0 AND coalesce(database_diff, 1) <> 0")
    row = ["_row"] if "_row" in candidates.columns else []
    found = chimeras(new.select("name", F.col("consensus").alias("sequence")), candidates.where(known).select(*row, "name", F.col("consensus").alias("sequence")))
    begin = F.col("suffix_end") - (F.col("length") - F.col("k")) + 1
    return found.select("name", F.format_string("%s:1..%d+%s:%d..%d", "prefix_of", "k", "suffix_of", begin, "suffix_end").alias("chimera"))


def common_sequences(df: DataFrame, sequence: str, dataset: str, least: int) -> DataFrame:
    """JOI15: sequences that occur in at least so many data sets."""
    return df.groupBy(sequence).agg(F.count_distinct(dataset).alias("datasets"), F.count("*").alias("rows")).where(F.col("datasets") >= least)


def natural_key(c: Column) -> Column:
    """SRT1: text lower-cased with its numbers filled up to twelve digits, so that it sorts as people count."""
    tokens = F.regexp_extract_all(F.lower(c), F.lit("([0-9]+|[^0-9]+)"), 1)
    return F.array_join(F.transform(tokens, lambda t: F.when(t.rlike("^[0-9]"), F.lpad(t, 12, "0")).otherwise(t)), "")


def discards(clonotype_ratio: float = 0.12, exact_ratio: float = 0.1, unique_d_ratio: float = 0.35, unique_d_least: int = 10) -> dict[str, Column]:
    """GER1, GER3-GER5: why r would discard c; the first that holds gives the reason (GER6)."""
    ratio = lambda n: F.try_divide(F.col(f"c.{n}").cast("double"), F.col(f"r.{n}").cast("double"))
    gene = same_gene(F.col("c.source"), F.col("r.source"))
    larger = F.col("r.cluster_size") >= F.col("c.cluster_size")
    return {
        "identical_to": larger & F.startswith(F.col("r.consensus"), F.col("c.consensus")),
        "clonotype_ratio": gene & (ratio("CDR3s_exact") < clonotype_ratio),
        "exact_ratio": gene & (ratio("exact") < exact_ratio),
        "unique_D_ratio": gene & larger & (F.col("r.Ds_exact") >= unique_d_least) & (ratio("Ds_exact") < unique_d_ratio),
    }


def elimination_edges(candidates: DataFrame, **limits) -> DataFrame:
    """(reference, candidate, reason) of all ordered pairs. Pairs of one gene, or of one prefix, come from equi-joins,
    prefixes being as long as candidates are."""
    rules = discards(**limits)
    gene = candidates.withColumn("g_", F.coalesce(F.substring_index("source", "*", 1), F.lit("")))
    reason = F.coalesce(*(F.when(c, F.lit(k)) for k, c in rules.items()))
    pairs = gene.alias("r").join(gene.alias("c"), (F.col("r.g_") == F.col("c.g_")) & (F.col("r.name") != F.col("c.name")))
    own = pairs.select(F.col("r.name").alias("reference"), F.col("c.name").alias("candidate"), reason.alias("reason")).where("reason IS NOT NULL")
    targets = gene.select(F.col("name").alias("candidate"), F.col("g_").alias("c_gene"), F.col("cluster_size").alias("c_size"), "consensus").where("consensus IS NOT NULL")
    starts = starting_with(gene.select(F.col("name").alias("reference"), "g_", "cluster_size", F.col("consensus").alias("full")), "full", targets, "consensus")
    across = starts.where("g_ <> c_gene AND cluster_size >= c_size").select("reference", "candidate", F.lit("identical_to").alias("reason"))
    return own.unionByName(across)


def germline_edges(c: DataFrame, cross_mapping: float = 0.02, clonotype_ratio: float = 0.12, exact_ratio: float = 0.1, unique_d_ratio: float = 0.35, unique_d_least: int = 10) -> DataFrame:
    """GER1-GER6 with the reason as the filter's report has it: (reference, candidate, reason) of all ordered pairs of
    candidates (name, consensus, cluster, cluster_size, clonotypes, exact, Ds_exact, whitelist_diff, database_diff,
    CDR3_start). Pairs come from equi-joins: on the gene, on prefixes, and for cross-mapping on halves of sequences."""
    if unique_d_least < 1:
        raise ValueError("unique_d_least must be at least 1")  # GER10
    c = c.withColumns({"gene_": F.when(F.col("name").contains("*"), F.substring_index("name", "*", 1)), "white_": F.coalesce(F.col("whitelist_diff") == 0, F.lit(False)), "db_": F.coalesce(F.col("database_diff") == 0, F.lit(False)), "core_": F.left("consensus", F.greatest(F.coalesce("CDR3_start", F.lit(10_000)), F.lit(0))), "sure_": F.arrays_overlap(F.split("cluster", ";"), F.array(F.lit("all"), F.lit("db")))})
    names = c.select("name", "consensus")
    gene = c.select("gene_", F.col("name").alias("reference")).join(c.select("gene_", F.col("name").alias("candidate")), "gene_").select("reference", "candidate")
    starts = starting_with(names.select(F.col("name").alias("reference"), F.col("consensus").alias("full")), "full", names.select(F.col("name").alias("candidate"), "consensus"), "consensus").select("reference", "candidate")
    known = c.where("db_").select("name", "core_")
    lengths = known.select(F.length("core_").alias("n")).distinct().agg(F.collect_set("n").alias("ns"))  # one row
    n, half = F.col("n"), F.floor(F.col("n") / 2).cast("int")
    own = known.select(F.col("name").alias("reference"), F.length("core_").alias("n"), "core_")
    own = own.select("reference", "n", F.explode(F.array(F.struct(F.lit("p").alias("side"), F.left("core_", half).alias("piece")), F.struct(F.lit("s").alias("side"), F.right("core_", n - half).alias("piece")))).alias("x")).select("reference", "n", "x.*")
    other = known.join(F.broadcast(lengths), F.lit(True)).select(F.col("name").alias("candidate"), "core_", F.explode("ns").alias("n"))
    other = other.select("candidate", "n", F.explode(F.array_distinct(F.array(F.left("core_", n), F.right("core_", n)))).alias("v"))
    other = other.select("candidate", "n", F.explode(F.array(F.struct(F.lit("p").alias("side"), F.left("v", half).alias("piece")), F.struct(F.lit("s").alias("side"), F.right("v", n - half).alias("piece")))).alias("x")).select("candidate", "n", "x.*")
    mapped = own.join(other, ["n", "side", "piece"]).select("reference", "candidate")
    pairs = gene.unionByName(starts).unionByName(mapped).where("reference <> candidate").distinct()
    r, x = (c.select(F.col("name").alias(k), F.struct(*[v for v in c.columns if v != k]).alias(s)) for k, s in (("reference", "r"), ("candidate", "c")))
    both = pairs.join(r, "reference").join(x, "candidate")
    ratio = lambda v: F.try_divide(F.col(f"c.{v}").cast("double"), F.col(f"r.{v}").cast("double"))
    text = lambda name, value, digits: F.concat(F.format_string(f"{name}=%.{digits}f,other=", value), F.col("reference"))
    same, larger = F.coalesce(F.col("r.gene_") == F.col("c.gene_"), F.lit(False)), F.col("r.cluster_size") >= F.col("c.cluster_size")
    size = F.length("r.core_")
    apart = F.when(F.length("c.core_") == size, F.levenshtein("r.core_", "c.core_")).otherwise(F.least(F.levenshtein("r.core_", F.left("c.core_", size)), F.levenshtein("r.core_", F.right("c.core_", size))))
    share = F.try_divide(F.col("c.cluster_size").cast("double"), (F.col("r.cluster_size") + F.col("c.cluster_size")).cast("double"))
    reason = F.coalesce(
        F.when(~F.col("c.white_") & larger & (F.col("r.consensus") == F.col("c.consensus")), F.concat(F.lit("identical_to="), "reference")),
        F.when(~F.col("c.white_") & larger & F.startswith("r.consensus", "c.consensus"), F.concat(F.lit("identical_to="), "reference", F.lit(",truncated"))),
        F.when(F.col("r.db_") & F.col("c.db_") & F.col("c.sure_") & (share < cross_mapping) & (apart <= 1), F.concat(F.format_string("xmap_ratio=%.4f,other=", share), F.col("reference"))),
        F.when(same & (ratio("clonotypes") < clonotype_ratio), text("clonotype_ratio", ratio("clonotypes"), 4)),
        F.when(same & (ratio("exact") < exact_ratio), text("ex_occ_ratio", ratio("exact"), 1)),
        F.when(same & larger & (F.col("r.Ds_exact") >= unique_d_least) & (ratio("Ds_exact") < unique_d_ratio), text("Ds_exact_ratio", ratio("Ds_exact"), 1)),
    )
    return both.select("reference", "candidate", reason.alias("reason")).where("reason IS NOT NULL")


def germline_filter(tables: list[DataFrame], whitelist: DataFrame, marks: dict[str, Column] | None = None, order: str = "name", **limits) -> tuple[DataFrame, DataFrame]:
    """The whole filter: (annotated, kept). annotated has why_filtered, an array, of FIL12's marks and of the reasons of the
    references that stood when they were asked (GER7); kept are the candidates without any, with the distance to
    the whitelist (GER8) and chimeras (GER9)."""
    c = tables[0]
    for more in tables[1:]:  # SET4
        c = c.unionByName(more, allowMissingColumns=True)
    c = marked(whitelisted(c, whitelist), marks or {}).withColumnRenamed("why_filtered", "marks_").checkpoint()
    edges = germline_edges(c, **limits).checkpoint()
    rows = c.withColumn("source", F.col("name"))
    stand = survivors(rows, edges, order, F.col("is_filtered") > 0)
    # a reference speaks if nothing had removed it before its turn
    at = c.select(F.col("name").alias("n"), F.col(order).alias("at"), (F.col("is_filtered") > 0).alias("marked"))
    turn = speakers(at, edges)
    why = edges.join(turn, "reference", "left_semi").groupBy(F.col("candidate").alias("name")).agg(F.array_sort(F.collect_list("reason")).alias("reasons"))
    annotated = c.join(why, "name", "left").withColumn("why_filtered", F.concat("marks_", F.coalesce("reasons", F.array().cast("array<string>")))).drop("marks_", "reasons")
    annotated = annotated.withColumn("is_filtered", F.size("why_filtered"))
    kept = annotated.where("is_filtered = 0").join(stand, "name", "left_semi")
    near = nearest(kept.select("name", F.col("consensus").alias("sequence")), whitelist)
    kept = kept.drop("whitelist_diff").join(near.withColumnsRenamed({"distance": "whitelist_diff", "closest": "closest_whitelist"}), "name", "left")
    return annotated, kept.join(chimera_text(kept), "name", "left")


def speakers(rows: DataFrame, edges: DataFrame) -> DataFrame:
    """(reference) that are not removed before their turn in order of rows (n, at, marked). Rows of one linked group are resolved in
    one task; groups are those of elimination, a few genes."""
    links = edges.select(F.col("reference").alias("a"), F.col("candidate").alias("b"))
    group = components(rows.select(F.col("n").alias("node")), links).select(F.col("node").alias("n"), F.col("component").alias("g"))
    own = rows.join(group, "n").join(edges.groupBy(F.col("reference").alias("n")).agg(F.collect_set("candidate").alias("hits")), "n", "left")

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        gone, out = set(pdf.loc[pdf["marked"], "n"]), []
        for n, hits in pdf.sort_values(["at", "n"])[["n", "hits"]].itertuples(index=False):
            if n not in gone:
                out.append(n)
                gone.update(() if hits is None else hits)
        return pd.DataFrame({"reference": pd.Series(out, dtype=object)})

    return own.groupBy("g").applyInPandas(run, "reference string")


def survivors(candidates: DataFrame, edges: DataFrame, order: str = "name", gone: Column | None = None) -> DataFrame:
    """GER7: greedy elimination in table order: a candidate that is gone, before or by then, discards nobody. Genes that
    edges link, directly or over others, are resolved together."""
    before = F.lit(False) if gone is None else F.coalesce(gone, F.lit(False))
    rows = candidates.select("name", F.col(order).alias("at"), before.alias("out"), F.coalesce(F.substring_index("source", "*", 1), F.lit("")).alias("gene"))
    of = lambda n: rows.select(F.col("name").alias(n), F.col("gene").alias(n[0]))
    links = edges.join(of("reference"), "reference").join(of("candidate"), "candidate").where("r <> c").select(F.col("r").alias("a"), F.col("c").alias("b")).distinct()
    rows = rows.join(components(rows.select(F.col("gene").alias("node")), links).withColumnsRenamed({"node": "gene", "component": "group"}), "gene")
    own = rows.withColumnRenamed("name", "candidate").join(edges, "candidate", "left").groupBy("group", "candidate", "at", "out").agg(F.collect_set("reference").alias("hits"))

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        gone: set = set(pdf.loc[pdf["out"], "candidate"])
        names = list(pdf.sort_values(["at", "candidate"])["candidate"])
        by: dict = {}
        for c, refs in zip(pdf["candidate"], pdf["hits"]):
            for r in refs:
                by.setdefault(r, []).append(c)
        for r in names:
            if r not in gone:
                gone.update(by.get(r, ()))
        return pd.DataFrame({"name": pd.Series([n for n in names if n not in gone], dtype=object)})

    return own.groupBy("group").applyInPandas(run, "name string")


def expressed_alleles(usage: DataFrame, share: float = 0.1) -> DataFrame:
    """HAP1: alleles with at least share of their gene's largest count."""
    w = Window.partitionBy(F.substring_index("gene", "*", 1))
    return usage.withColumn("top_", F.max("count").over(w)).where(F.col("count") >= share * F.col("top_")).drop("top_")


def heterozygous(usage: DataFrame, most: int = 5) -> DataFrame:
    """HAP2: genes with exactly two expressed alleles, the most expressed first."""
    two = expressed_alleles(usage).groupBy(F.substring_index("gene", "*", 1).alias("gene")).agg(F.count("*").alias("alleles"), F.sum("count").alias("total")).where("alleles = 2")
    return two.orderBy(F.desc("total"), "gene").limit(most).select("gene", "total")
