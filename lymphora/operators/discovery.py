"""Discovery of germline genes (DIS1-DIS10, AGG3, FIL7, FIL13, FIL15, JOI7, JOI11).

Rows are tables with v_call, d_call, j_call, V_SHM, V_errors, V_nt, VDJ_nt, V_CDR3_start, cdr3, locus, barcode and sequence_id.
Groups go to Python only as samples of bounded size; counts and joins stay in Catalyst.
"""

from __future__ import annotations

import uuid

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.sequence import edit_distance, has_stop, safe_divide, unique_name
from .augment import small, v_without_cdr3
from .clustering import clonotype_counts, clustered, sample
from .consensus import allele_ratio, described, folded, iterative_consensus, letter_named, overlapping, siblings
from .database import starting_with, substrings
from .filters import n_bases

#: Rows of a sibling at least, exact rows of a database gene for it to be added again, rows of a consensus at most.
GROUP, EXPRESSED, CONSENSUS, CLUSTERED = 5, 10, 1600, 1000
#: Columns that discover reads.
READ = ["sequence_id", "v_call", "d_call", "j_call", "V_SHM", "V_errors", "D_errors", "D_covered", "d_support", "V_nt", "VDJ_nt", "V_CDR3_start", "cdr3", "locus", "barcode", "copies"]
CARRIED = ["sequence_id", "V_nt", "cdr3", "j_call", "locus", "V_CDR3_start"]


def windows(step: int = 2, left: float = 0, right: float = 100) -> list[tuple[str, float, float, bool]]:
    """DIS1: (name, left, right, requested): windows of V_SHM over 0 to 20, and the one asked for."""
    shown = lambda x: f"{x:g}"
    spans = [*((float(s), float(s + step)) for s in range(0, 20, step)), (float(left), float(right))]
    return [("all" if span == (0, 100) else f"{shown(span[0])}-{shown(span[1])}", *span, span == (left, right)) for span in spans]


def written(df: DataFrame) -> DataFrame:
    """df as a compressed table in the checkpoint folder. A checkpoint computes its rows twice and keeps them uncompressed."""
    spark = df.sparkSession
    path = f"{spark.sparkContext.getCheckpointDir()}/table-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def large_enough(df: DataFrame, keys: list[str], least: int) -> DataFrame:
    """FIL15: rows of groups of at least so many."""
    return df.join(df.groupBy(*keys).agg(F.count("*").alias("n_")).where(F.col("n_") >= least).select(*keys), keys, "left_semi")


def window_members(rows: DataFrame, spans: list[tuple[str, float, float, bool]], least: int = GROUP) -> DataFrame:
    """DIS1: (gene, sibling, at, requested, carried columns): a row for each window that a read lies in."""
    own = F.array(*(F.when((F.col("V_SHM") >= a) & (F.col("V_SHM") < b), F.struct(F.lit(k).alias("at"), F.lit(name).alias("sibling"), F.lit(want).alias("requested"))) for k, (name, a, b, want) in enumerate(spans)))
    out = rows.select(F.col("v_call").alias("gene"), F.explode(F.filter(own, lambda x: x.isNotNull())).alias("w"), *CARRIED).select("gene", "w.*", *CARRIED)
    return large_enough(out, ["gene", "sibling"], least)


def cluster_members(rows: DataFrame, least: int = GROUP, most: int = CLUSTERED, copies: int = 1, seed: int = 1) -> DataFrame:
    """DIS2: clusters of a sample of each gene's reads by average linkage of V without the CDR3; with copies over 1, reads
    with that many copies are sampled first (SRT7)."""
    first = F.col("copies") >= copies if copies > 1 else None
    chosen = sample(v_without_cdr3(rows).withColumn("gene", F.col("v_call")), ["gene"], "sequence_id", most, first, seed).select("gene", "V_no_CDR3", *CARRIED).checkpoint()
    found = clustered(chosen.select("gene", "sequence_id", "V_no_CDR3"), ["gene"], "sequence_id", "V_no_CDR3", least)
    held = large_enough(found, ["gene", "cluster"], least)
    number = held.select("gene", "cluster").distinct().withColumn("c", F.row_number().over(Window.partitionBy("gene").orderBy("cluster")))
    out = held.join(number, ["gene", "cluster"]).join(chosen.select("gene", *CARRIED), ["gene", "sequence_id"])
    return out.select("gene", (F.col("c") + 1000).alias("at"), F.concat(F.lit("cl"), "c").alias("sibling"), F.lit(False).alias("requested"), *CARRIED)


def exact_members(rows: DataFrame, least: int) -> DataFrame:
    """DIS3: reads of V sequences that occur least times."""
    often = rows.groupBy(F.col("v_call").alias("gene"), "V_nt").agg(F.count("*").alias("n")).where(F.col("n") >= least)
    often = often.withColumn("c", F.row_number().over(Window.partitionBy("gene").orderBy("V_nt")))
    out = rows.withColumn("gene", F.col("v_call")).join(often, ["gene", "V_nt"])
    return out.select("gene", (F.col("c") + 10_000).alias("at"), F.concat(F.lit("ex"), "c").alias("sibling"), F.lit(False).alias("requested"), *CARRIED)


def database_members(rows: DataFrame, database: DataFrame, least: int = EXPRESSED) -> DataFrame:
    """DIS4: exact reads of database genes that have least of them."""
    exact = rows.where("V_errors = 0").withColumn("gene", F.col("v_call")).join(database.select("gene"), "gene", "left_semi")
    out = exact.select("gene", F.lit(1_000_000).alias("at"), F.lit("db").alias("sibling"), F.lit(False).alias("requested"), *CARRIED)
    return large_enough(out, ["gene"], least)


def snapped(sequence: Column, known: Column) -> Column:
    """DIS5: the database's sequence if one is the other's prefix."""
    return F.when(F.startswith(sequence, known) | F.startswith(known, sequence), known).otherwise(sequence)


def few_of_each(df: DataFrame, keys: list[str], row: str, n: int, seed: int = 1, room: int = 4) -> DataFrame:
    """sample() written, of which only rows with low hashes are sorted and exchanged: of a key's rows room times as many as are
    wanted. Where that leaves a key too few, as with many equal rows, all rows are."""
    sizes = written(df.groupBy(*keys).agg(F.count("*").alias("size_")))
    share = F.least(F.lit(1.0), F.lit(float(room * n)) / F.col("size_"))
    low = df.join(small(sizes), keys).where(F.xxhash64(F.lit(seed), *keys, row) / 2.0**64 + 0.5 <= share).drop("size_")
    out = written(sample(low, keys, row, n, seed=seed))
    short = sizes.join(out.groupBy(*keys).agg(F.count("*").alias("got")), keys, "left").where(F.coalesce("got", F.lit(0)) < F.least("size_", F.lit(n)))
    return written(sample(df, keys, row, n, seed=seed)) if short.head(1) else out


def sibling_sequences(members: DataFrame, database: DataFrame, threshold: float = 0.6, most: int = CONSENSUS, seed: int = 1) -> DataFrame:
    """(gene, sibling, at, requested, sequence): the consensus of at most so many reads of each sibling, snapped to the database.
    Siblings named db and ex have the database's and their reads' sequence."""
    keys = ["gene", "sibling", "at", "requested"]
    exact = F.startswith("sibling", F.lit("ex"))
    some = members.where((F.col("sibling") != "db") & ~exact).select(*keys, "sequence_id", "V_nt")
    chosen = few_of_each(some, keys[:2], "sequence_id", most, seed)

    def run(key, pdf: pd.DataFrame) -> pd.DataFrame:
        found = iterative_consensus(pdf.sort_values("k")["V_nt"].tolist(), threshold, most=most)
        return pd.DataFrame([(*key, found)], columns=[*keys, "sequence"])

    made = chosen.groupBy(*keys).applyInPandas(run, "gene string, sibling string, at int, requested boolean, sequence string")
    made = made.unionByName(members.where(exact).groupBy(*keys).agg(F.min("V_nt").alias("sequence")))  # all are equal
    known = small(database.select("gene", F.col("sequence").alias("known")))
    made = made.join(known, "gene", "left").withColumn("sequence", F.when(F.startswith("sibling", F.lit("ex")), F.col("sequence")).otherwise(F.coalesce(snapped(F.col("sequence"), F.col("known")), F.col("sequence"))))
    again = members.where("sibling = 'db'").select(*keys).distinct().join(known, "gene").withColumnRenamed("known", "sequence")
    return made.select(*keys, "sequence").unionByName(again.select(*keys, "sequence"))


def merged_siblings(found: DataFrame) -> DataFrame:
    """(gene, name, sequence, requested): siblings that are alike but for N and length, joined in order (MRG1)."""
    rows = found.select("gene", "at", F.col("sibling").alias("name"), "sequence", "requested")
    return folded(rows, ["gene"], "at", "gene string, at int, name string, sequence string, requested boolean", siblings).drop("at")


def most_frequent(df: DataFrame, keys: list[str], c: str, count: Column | None = None) -> DataFrame:
    """(keys, c): the most frequent value of c, of equals the least. count is that of the rows by default."""
    counts = df.groupBy(*keys, c).agg((F.count("*") if count is None else count).alias("n"))
    return counts.groupBy(*keys).agg(F.min_by(c, F.struct((-F.col("n")).alias("n"), F.col(c).alias("v"))).alias(c))


def group_info(df: DataFrame, keys: list[str], d_coverage: float = 70.0, d_evalue: float = 1e-4) -> DataFrame:
    """AGG3: counts of each group of reads; the D counts only take reads with a good D."""
    good = (F.col("D_errors") == 0) & (F.col("D_covered") >= d_coverage) & (F.col("d_support") <= d_evalue) & (F.col("d_call") != "")
    text = lambda c: F.when(F.col(c) != "", F.col(c))
    return df.groupBy(*keys).agg(F.count("*").alias("count"), F.count_distinct(text("cdr3")).alias("unique_CDR3"), F.count_distinct(text("j_call")).alias("unique_J"), F.count_distinct(F.when(good, F.col("d_call"))).alias("unique_D"), F.count_distinct(text("barcode")).alias("unique_barcodes"))


def evaluated(rows: DataFrame, merged: DataFrame, members: DataFrame, database: DataFrame, distance: int = 6, max_n: int = 0) -> DataFrame:
    """DIS6: a candidate for each merged sibling: what supports it, how it differs from the database, and its name (FIL13, FIL14)."""
    key = ["gene", "name"]
    merged = merged.where(n_bases(F.col("sequence")) <= max_n)
    # reads of the siblings that were merged, each once (SET5)
    of = merged.select(*key, F.explode(F.split("name", ";")).alias("sibling"))
    group = members.drop("V_nt", "at", "requested").join(small(of), ["gene", "sibling"]).dropDuplicates([*key, "sequence_id"])
    # exchanged once, and kept as counts
    group = written(group.groupBy(*key, "locus", "V_CDR3_start", "j_call", "cdr3").agg(F.count("*").alias("reads")))
    text = lambda c: F.when(F.col(c) != "", F.col(c))
    window = group.groupBy(*key).agg(F.sum("reads").alias("cluster_size"), F.count_distinct(text("j_call")).alias("Js"), F.count_distinct(text("cdr3")).alias("CDR3s"))
    own = window.join(most_frequent(group, key, "locus", F.sum("reads")), key).join(most_frequent(group, key, "V_CDR3_start", F.sum("reads")), key)
    start = most_frequent(rows.withColumn("gene", F.col("v_call")), ["gene"], "V_CDR3_start").withColumnRenamed("V_CDR3_start", "cut")
    named = merged.join(start, "gene").withColumn("V_no_CDR3", F.left("sequence", F.greatest("cut", F.lit(0))))
    exact = v_without_cdr3(rows).withColumn("gene", F.col("v_call")).join(small(named.select(*key, "V_no_CDR3")), ["gene", "V_no_CDR3"])
    info = group_info(exact, key)
    # prefixes are looked up under the gene, as it stands before both
    wanted = merged.select(*key, F.concat_ws("|", "gene", "sequence").alias("p"))
    longest = wanted.agg(F.max(F.length("p"))).first()[0] or 0
    starts = rows.groupBy(F.left(F.concat_ws("|", "v_call", "VDJ_nt"), F.lit(longest)).alias("text")).agg(F.count("*").alias("reads"))  # what is behind doesn't matter
    full = starting_with(starts, "text", small(wanted), "p").groupBy(*key).agg(F.sum("reads").alias("full_exact"))
    # CDR3s that reads outside the group have too
    total = rows.where("cdr3 <> ''").groupBy("cdr3").agg(F.count("*").alias("total"))
    inside = group.where("cdr3 <> ''").groupBy(*key, "cdr3").agg(F.sum("reads").alias("inside"))
    seen = exact.where("cdr3 <> ''").select(*key, "cdr3").distinct().join(total, "cdr3").join(inside, [*key, "cdr3"], "left")
    shared = seen.groupBy(*key).agg(F.sum((F.col("total") > F.coalesce("inside", F.lit(0))).cast("long")).alias("shared"))
    known = small(database.select("gene", F.col("sequence").alias("known")))
    out = merged.join(own, key).join(info, key, "left").join(full, key, "left").join(shared, key, "left").join(clonotype_counts(exact, key, distance), key, "left").join(known, "gene", "left")
    out = out.na.fill(0, ["count", "unique_CDR3", "unique_J", "unique_D", "unique_barcodes", "full_exact", "shared", "clonotypes"])
    out = described(out.withColumn("database_diff", edit_distance(F.col("sequence"), F.col("known"))), "known", "sequence", "database_changes")
    out = out.where("database_diff IS NULL OR database_diff = 0 OR count >= 2")
    ratio = lambda a, b: safe_divide(F.col(a).cast("double"), F.col(b).cast("double"))
    return out.select(
        F.when(F.col("database_diff") == 0, F.col("gene")).otherwise(unique_name(F.col("gene"), F.col("sequence"))).alias("name"), F.col("gene").alias("source"), F.col("locus").alias("chain"), F.col("name").alias("cluster"),
        "cluster_size", "Js", "CDR3s", F.col("count").alias("exact"), "full_exact", F.col("unique_barcodes").alias("barcodes_exact"), F.col("unique_D").alias("Ds_exact"), F.col("unique_J").alias("Js_exact"),
        F.col("unique_CDR3").alias("CDR3s_exact"), "clonotypes", ratio("count", "unique_CDR3").alias("CDR3_exact_ratio"), ratio("shared", "unique_CDR3").alias("CDR3_shared_ratio"), n_bases(F.col("sequence")).alias("N_bases"),
        "database_diff", "database_changes", has_stop(F.col("sequence")).cast("int").alias("has_stop"), F.col("V_CDR3_start").alias("CDR3_start"), F.col("sequence").alias("consensus"),
    )


def discover(rows: DataFrame, database: DataFrame, spans=None, cluster: bool = True, cluster_exact: int = 0, ignore_j: bool = False, **limits) -> DataFrame:
    """The candidate table of novel and known V genes: windows, clusters and exact sequences, merged and evaluated."""
    rows = rows.where("v_call <> ''") if ignore_j else rows.where("v_call <> '' AND J_SHM = 0")
    # computed columns are used by many branches, so they are written once
    rows = written(rows.select([c for c in READ if c in rows.columns]))
    members = window_members(rows, spans or windows()).unionByName(database_members(rows, database))
    if cluster:
        members = members.unionByName(written(cluster_members(rows)))
    if cluster_exact:
        members = members.unionByName(exact_members(rows, cluster_exact))
    # members aren't written: there are several for each read, and all but the clusters' follow from the reads
    merged = written(merged_siblings(sibling_sequences(members, database)))
    return evaluated(rows, merged, members, database, **limits)


def core(c: Column, start: int | None, end: int | None) -> Column:
    """DIS8: Python's c[start:end]."""
    n = F.length(c)
    place = lambda k, default: default if k is None else F.least(F.lit(k), n) if k >= 0 else F.greatest(n + k, F.lit(0))
    a, b = place(start, F.lit(0)), place(end, n)
    return F.substring(c, a + 1, F.greatest(b - a, F.lit(0)))


def without_contained(candidates: DataFrame, c: str = "sequence") -> DataFrame:
    """JOI7: candidates that no longer one holds."""
    both = substrings(candidates.select(F.col(c).alias("needle")), candidates.select(F.col(c).alias("haystack"))).where("needle <> haystack")
    return candidates.join(both.select(F.col("needle").alias(c)).distinct(), c, "left_anti")


def nearest_in_order(candidates: DataFrame, database: DataFrame) -> DataFrame:
    """JOI11: (sequence, db_distance, db_name): the nearest of database (_row, name, sequence), of equals the first."""
    db = small(database.select(F.col("_row").alias("r"), F.col("name").alias("d"), F.col("sequence").alias("s")))
    best = F.min(F.struct(edit_distance(F.col("sequence"), F.col("s")).alias("n"), "r", "d"))
    return candidates.select("sequence").distinct().join(db, F.length("s") >= 0).groupBy("sequence").agg(best.alias("b")).select("sequence", F.col("b.n").alias("db_distance"), F.col("b.d").alias("db_name"))


def known_extension(candidates: DataFrame, database: DataFrame, gene: str) -> DataFrame:
    """DIS9: candidates (sequence) that lie in a database gene, the first: full is its sequence for V and J; for D, missing
    is what it has before and behind."""
    held = substrings(candidates.select(F.col("sequence").alias("needle")), database.select(F.col("sequence").alias("haystack"))).join(database.select("_row", F.col("name").alias("held_by"), F.col("sequence").alias("haystack")), "haystack")
    first = held.groupBy("needle").agg(F.min(F.struct("_row", "held_by", "haystack")).alias("b")).select(F.col("needle").alias("sequence"), "b.held_by", "b.haystack")
    at = F.instr(F.col("haystack"), F.col("sequence"))
    around = F.concat(F.left("haystack", at - 1), F.lit("..."), F.substring("haystack", at + F.length("sequence"), F.length("haystack")))
    return first.select("sequence", "held_by", F.when(F.lit(gene != "D"), F.col("haystack")).alias("full"), F.when(F.lit(gene == "D"), around).alias("missing"))


def occurrences(candidates: DataFrame, rows: DataFrame, columns: list[str], other: str, perfect: bool = True) -> DataFrame:
    """(sequence, exact_occ, others, CDR3s): reads in one of whose columns a candidate lies, their other genes and CDR3s."""
    good = rows.where(F.col(f"{other.upper()}_errors") == 0) if perfect else rows
    texts = good.select(F.explode(F.array_distinct(F.array(*(F.coalesce(c, F.lit("")) for c in columns)))).alias("haystack"), "sequence_id", F.col(f"{other.lower()}_call").alias("o"), "cdr3").where("haystack <> ''")
    hits = texts.join(substrings(candidates.select(F.col("sequence").alias("needle")).distinct(), texts.select("haystack")), "haystack")
    reads = hits.dropDuplicates(["needle", "sequence_id"])
    return reads.groupBy(F.col("needle").alias("sequence")).agg(F.count("*").alias("exact_occ"), F.count_distinct(F.when(F.col("o") != "", F.col("o"))).alias("others"), F.count_distinct(F.when(F.col("cdr3") != "", F.col("cdr3"))).alias("CDR3s"))


def discover_simple(rows: DataFrame, gene: str, column: str, search: list[str], database: DataFrame | None = None, occurrences_least: int = 3, length: int = 5, core_slice: tuple[int | None, int | None] = (None, None), j_coverage: float | None = None, ratio: float | None = 0.2, cross_mapping: float | None = None, least: int | None = None, whitelist: DataFrame | None = None) -> DataFrame:
    """DIS7: candidates of J, D or V genes from the sequences of column that occur often, with the database's whitelisted sequences
    (SET3), without those that others hold (JOI7) or with an N; overlapping D's are merged (MRG3). They are named
    after the nearest or holding database gene (JOI11, DIS9), counted in the search columns (JOI5) and filtered by
    allele ratio (MRG4) and count."""
    other = "J" if gene == "V" else "V"
    least = {"J": 1, "D": 10, "V": 100}[gene] if least is None else least
    own = rows.where(F.col(f"{other}_errors") == 0)  # FIL7
    if j_coverage is not None:
        own = own.where(F.col("J_covered") >= j_coverage)
    own = own.select("sequence_id", f"{other.lower()}_call", f"{other}_errors", "cdr3", *dict.fromkeys([column, *search])).checkpoint()
    found = own.select(core(F.col(column), *core_slice).alias("sequence")).where(F.length("sequence") >= length).groupBy("sequence").agg(F.count("*").alias("max_count")).where(F.col("max_count") >= occurrences_least)
    if whitelist is not None:
        missing = whitelist.select("sequence").distinct().join(found.select("sequence"), "sequence", "left_anti")
        found = found.unionByName(missing.withColumn("max_count", F.lit(0).cast("long")))
    found = without_contained(found).where(n_bases(F.col("sequence")) == 0).checkpoint()
    if gene == "D":
        numbered = found.select(F.lit(gene).alias("kind"), F.struct((-F.col("max_count")).alias("n"), "sequence").alias("at"), "sequence", "max_count")
        text = numbered.withColumn("at", F.format_string("%020d%s", F.col("at.n") + (1 << 40), F.col("sequence")))
        found = folded(text, ["kind"], "at", "kind string, at string, sequence string, max_count long", overlapping).select("sequence", "max_count")
    if database is None:
        found = found.select("sequence", unique_name(F.lit(gene), F.col("sequence")).alias("name"), F.lit(None).cast("int").alias("db_distance"), F.lit(None).cast("string").alias("missing"))
    else:
        found = found.join(nearest_in_order(found, database), "sequence").join(known_extension(found, database, gene), "sequence", "left")
        exact, held = F.col("db_distance") == 0, F.col("held_by").isNotNull()
        name = F.when(exact, F.col("db_name")).when(held, F.col("held_by")).otherwise(unique_name(F.col("db_name"), F.col("sequence")))
        found = found.select(F.when(~exact & held, F.coalesce("full", "sequence")).otherwise(F.col("sequence")).alias("sequence"), name.alias("name"), F.when(~exact & held & F.col("full").isNotNull(), 0).otherwise(F.col("db_distance")).alias("db_distance"), F.when(~exact, F.col("missing")).alias("missing"))
    counted = found.join(occurrences(found, own, search, other), "sequence", "left").na.fill(0, ["exact_occ", "others", "CDR3s"]).withColumnRenamed("CDR3s", "unique_CDR3")
    columns = "kind string, sequence string, name string, db_distance int, missing string, exact_occ long, others long, unique_CDR3 long, at string"
    rows_ = counted.withColumns({"kind": F.lit(gene), "at": F.concat_ws("|", "name", "sequence")}).select("kind", "sequence", "name", "db_distance", "missing", "exact_occ", "others", "unique_CDR3", "at")
    if ratio or cross_mapping:
        rows_ = folded(rows_, ["kind"], "at", columns, allele_ratio(ratio, cross_mapping))
    kept = rows_.where((F.col("exact_occ") >= least) | (F.col("db_distance") == 0))

    def named(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("at")
        return pdf.assign(name=letter_named(pdf["name"].tolist())).astype(object).where(lambda d: d.notna(), None)

    return kept.groupBy("kind").applyInPandas(named, columns).drop("kind", "at")


def upstream(rows: DataFrame, column: str, threshold: float = 0.75, v_shm: float = 1.0, most: int = CONSENSUS) -> DataFrame:
    """DIS10: (gene, rows, consensus) of a region before V, from reads with little mutation; of a gene's reads those at least as
    long as the tenth longest (AGG18) count."""
    own = rows.where((F.col("V_SHM") <= v_shm) & (F.length(column) > 0)).select(F.col("v_call").alias("gene"), "sequence_id", F.col(column).alias("text"))
    place = F.row_number().over(Window.partitionBy("gene").orderBy(F.desc(F.length("text")), "sequence_id"))
    limit = own.withColumn("k", place).where("k <= 10").groupBy("gene").agg(F.min(F.length("text")).alias("least"))
    chosen = sample(own.join(limit, "gene").where(F.length("text") >= F.col("least")), ["gene"], "sequence_id", most)

    def run(key, pdf: pd.DataFrame) -> pd.DataFrame:
        texts = pdf.sort_values("k")["text"].tolist()
        # regions end at V, so they are compared from their ends
        return pd.DataFrame([(key[0], len(texts), iterative_consensus([t[::-1] for t in texts], threshold, most=most)[::-1])], columns=["gene", "rows", "consensus"])

    return chosen.groupBy("gene").applyInPandas(run, "gene string, rows long, consensus string")
