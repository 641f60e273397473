"""A query for each family of operators over the driver's tables, and the same in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import sequence as fn
from ..operators import database as db
from ..operators import expression as ex
from ..operators import filters as fl
from ..operators import preprocess as pre
from ..operators import similarity as sim
from ..shipping import ship
from .adapter import CANDIDATES, R, rearrangements

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None):
    """Registers a function of the rearrangement table, and its SQL over the CTE r."""

    def put(f):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship(spark)
            return f(rearrangements(spark, sf_dir))

        QUERIES[name] = run
        if sql:
            SQL[name] = f"WITH {R} {sql}" if not sql.startswith(",") else f"WITH {R}{sql}"
        return f

    return put


GOOD = "v_call <> '' AND j_call <> '' AND stop_codon = 'F' AND v_support <= 0.001 AND V_covered >= 90 AND J_covered >= 60"


def usage_sql(gene: str) -> str:
    others = ", ".join(f"count(DISTINCT nullif({g.lower()}_call, '')) AS unique_{g}" for g in "VDJ" if g != gene)
    call = f"{gene.lower()}_call"
    return f"SELECT {call} AS gene, count(*) AS count, count(DISTINCT nullif(cdr3, '')) AS unique_CDR3, {others} FROM r WHERE {call} <> '' AND {GOOD} GROUP BY 1"


for _g in "VDJ":
    query(f"AGG1_gene_usage_{_g.lower()}", usage_sql(_g))(lambda r, g=_g: ex.gene_usage(fl.quality_filter(r), g))

query("FIL1_quality_filter", f"SELECT sequence_id, v_call, j_call, cdr3 FROM r WHERE {GOOD}")(lambda r: fl.quality_filter(r).select("sequence_id", "v_call", "j_call", "cdr3"))
_steps = [("has_vj_assignment", "v_call <> '' AND j_call <> ''"), ("has_no_stop", "stop_codon = 'F'"), ("good_v_evalue", "v_support <= 0.001"), ("good_v_coverage", "V_covered >= 90"), ("good_j_coverage", "J_covered >= 60"), ("has_cdr3", "cdr3 <> ''")]
query("FIL1_statistics", "SELECT count(*) AS total, " + ", ".join(f"count(*) FILTER (WHERE {' AND '.join(c for _, c in _steps[: k + 1])}) AS {n}" for k, (n, _) in enumerate(_steps)) + " FROM r")(fl.quality_statistics)
query("FIL2_exact_v", "SELECT sequence_id, v_call FROM r WHERE V_errors = 0")(lambda r: fl.exact_v(r).select("sequence_id", "v_call"))
query("FIL3_unmutated_j", "SELECT sequence_id, j_call FROM r WHERE J_SHM = 0")(lambda r: fl.unmutated_j(r).select("sequence_id", "j_call"))
query("FIL5_d_match", "SELECT sequence_id, d_call FROM r WHERE D_errors = 0 AND D_covered >= 70 AND d_support <= 0.0001")(lambda r: fl.d_match(r).select("sequence_id", "d_call"))
query("FIL9_restricted", "SELECT sequence_id, v_call FROM r WHERE v_call IN (SELECT v_call FROM r WHERE j_call LIKE 'IGHJ3%' AND D_errors = 0)")(lambda r: fl.restricted(r, "v_call", r.where("j_call LIKE 'IGHJ3%' AND D_errors = 0"), "v_call").select("sequence_id", "v_call"))
query("FIL10_shm_window", "SELECT v_call, count(*) AS count FROM r WHERE V_SHM >= 2 AND V_SHM < 6 GROUP BY 1")(lambda r: fl.shm_window(r, 2, 6).groupBy("v_call").agg(F.count("*").alias("count")))
query("FIL17_shm_limits", "SELECT sequence_id FROM r WHERE V_SHM <= 5 AND J_SHM <= 1")(lambda r: r.where("V_SHM <= 5 AND J_SHM <= 1").select("sequence_id"))
query("AUG2_v_identity", "SELECT sequence_id, round(100 - V_SHM, 1) AS v_identity FROM r")(lambda r: r.select("sequence_id", F.round(100 - F.col("V_SHM"), 1).alias("v_identity")))
query("AUG16_cdr3_length", "SELECT length(cdr3) AS CDR3_length, count(*) AS count FROM r GROUP BY 1")(lambda r: r.groupBy(F.length("cdr3").alias("CDR3_length")).agg(F.count("*").alias("count")))
CODON = "'FFLLSSSSYY**CC*WLLLLPPPPHHQQRRRRIIIMTTTTNNKKSSRRVVVVAAAADDEEGGGG'"
_at = "(strpos('TCAG', substring(cdr3, {0}, 1)) - 1)"
_codon = "[CASE WHEN 3 * i <= length(cdr3) THEN substring(" + CODON + f", 1 + 16 * {_at.format('3 * i - 2')} + 4 * {_at.format('3 * i - 1')} + {_at.format('3 * i')}, 1) ELSE '*' END FOR i IN range(1, (length(cdr3) + 2) // 3 + 1)]"
query("FN1_translation", f"SELECT DISTINCT cdr3, array_to_string({_codon}, '') AS cdr3_aa, contains(array_to_string({_codon}, ''), '*') AS has_stop FROM r")(lambda r: r.select("cdr3").distinct().select("cdr3", fn.nt_to_aa(F.col("cdr3")).alias("cdr3_aa"), fn.has_stop(F.col("cdr3")).alias("has_stop")))
query("FN2_reverse_complement", "SELECT DISTINCT cdr3, reverse(translate(cdr3, 'ACGTURYSWKMBDHVN', 'TGCAAYRSWMKVHDBN')) AS rc FROM r")(lambda r: r.select("cdr3").distinct().select("cdr3", fn.reverse_complement(F.col("cdr3")).alias("rc")))
query("MRG6_sequence_hash", "SELECT DISTINCT V_nt, 'S' || lpad(cast(('0x' || right(md5(V_nt), 4))::BIGINT % 10000 AS varchar), 4, '0') AS hash FROM r")(lambda r: r.select("V_nt").distinct().select("V_nt", fn.sequence_hash(F.col("V_nt")).alias("hash")))
query("FN13_gene_name", "SELECT split_part(v_call, '*', 1) AS gene, count(*) AS count FROM r GROUP BY 1")(lambda r: r.groupBy(fn.gene_name(F.col("v_call")).alias("gene")).agg(F.count("*").alias("count")))
query("AGG4_shared_cdr3", ", k AS (SELECT v_call, cdr3, count(*) AS n FROM r WHERE cdr3 <> '' GROUP BY 1, 2), t AS (SELECT cdr3, sum(n) AS n FROM k GROUP BY 1) SELECT v_call, count(*) AS unique_CDR3, count(*) FILTER (WHERE t.n > k.n) AS shared FROM k JOIN t USING (cdr3) GROUP BY 1")(lambda r: ex.shared_cdr3(r, "v_call"))
query("AGG5_mode", "SELECT v_call, cdr3, n FROM (SELECT *, row_number() OVER (PARTITION BY v_call ORDER BY n DESC, cdr3) AS k FROM (SELECT v_call, cdr3, count(*) AS n FROM r GROUP BY 1, 2)) WHERE k = 1")(lambda r: ex.mode(r, "v_call", "cdr3"))
query("AGG6_representative", """, x AS (SELECT *, count(*) OVER g AS n, sum(copies) OVER g AS total, sum(copies) OVER (PARTITION BY v_call, j_call, cdr3, VDJ_nt) AS own FROM r WHERE cdr3 <> '' WINDOW g AS (PARTITION BY v_call, j_call, cdr3)),
 y AS (SELECT *, row_number() OVER (PARTITION BY v_call, j_call, cdr3 ORDER BY CASE WHEN n > 2 THEN -own ELSE 0 END, sequence_id) AS k FROM x) SELECT v_call, j_call, cdr3, VDJ_nt, total::BIGINT AS copies FROM y WHERE k = 1""")(lambda r: sim.representative(r.where("cdr3 <> ''"), ["v_call", "j_call", "cdr3"], "sequence_id").select("v_call", "j_call", "cdr3", "VDJ_nt", "copies"))
query("AGG7_coexpression", "SELECT v_call, j_call, count(*) AS count FROM r WHERE v_call <> '' AND j_call <> '' GROUP BY 1, 2")(lambda r: ex.coexpression(r.where("v_call <> '' AND j_call <> ''"), "v_call", "j_call"))
query("AGG8_allele_matrix", "SELECT v_call, count(*) FILTER (WHERE d_call = 'IGHD1*01') AS a1, count(*) FILTER (WHERE d_call = 'IGHD1*02') AS a2 FROM r GROUP BY 1")(lambda r: ex.allele_matrix(r, "v_call", "d_call", ["IGHD1*01", "IGHD1*02"]).toDF("v_call", "a1", "a2"))
query("AGG9_averages", "SELECT v_call, round(avg(V_SHM), 6) AS avg_v, round(avg(J_SHM), 6) AS avg_j, count(*) AS size FROM r GROUP BY 1")(lambda r: r.groupBy("v_call").agg(F.round(F.avg("V_SHM"), 6).alias("avg_v"), F.round(F.avg("J_SHM"), 6).alias("avg_j"), F.count("*").alias("size")))
query("AGG13_prefix_equivalence", """, s AS (SELECT DISTINCT cdr3 FROM r WHERE cdr3 <> ''), f AS (SELECT cdr3, CASE WHEN starts_with(cdr3, lag(cdr3) OVER (ORDER BY cdr3)) THEN 0 ELSE 1 END AS fresh FROM s),
 g AS (SELECT cdr3, sum(fresh) OVER (ORDER BY cdr3) AS run FROM f) SELECT cdr3, count(*) OVER (PARTITION BY run) AS run_size FROM g""")(lambda r: ex.prefix_equivalence(r.where("cdr3 <> ''").select("cdr3").distinct(), "cdr3"))
query("AGG14_frequent", "SELECT cdr3, count(*) AS count FROM r WHERE length(cdr3) >= 12 GROUP BY 1 HAVING count(*) >= 3")(lambda r: ex.frequent(r, "cdr3", 3, 12))
query("AGG17_histogram", "SELECT v_call, cast(floor(V_SHM) AS int) AS bin, count(*) AS count FROM r WHERE V_SHM >= 0 AND V_SHM < 20 GROUP BY 1, 2")(lambda r: ex.histogram(r, "v_call", "V_SHM", 20))
query("AGG18_nth_longest", "SELECT v_call, min(n) AS length FROM (SELECT v_call, length(cdr3) AS n, row_number() OVER (PARTITION BY v_call ORDER BY length(cdr3) DESC) AS k FROM r) WHERE k <= 10 GROUP BY 1")(lambda r: ex.nth_longest(r, "v_call", "cdr3"))
query("MRG4_allele_ratio", f", u AS ({usage_sql('V')}) SELECT gene, count, unique_CDR3 FROM (SELECT *, max(unique_CDR3) OVER (PARTITION BY split_part(gene, '*', 1)) AS top FROM u) WHERE unique_CDR3 >= 0.2 * top")(lambda r: ex.above_allele_ratio(ex.gene_usage(fl.quality_filter(r), "V"), 0.2).select("gene", "count", "unique_CDR3"))
query("JOI17_all_genes", f", u AS ({usage_sql('V')}) SELECT g.gene, coalesce(count, 0) AS count, coalesce(unique_CDR3, 0) AS unique_CDR3 FROM (SELECT DISTINCT v_call AS gene FROM r) g LEFT JOIN u ON g.gene = u.gene")(lambda r: ex.with_all_genes(ex.gene_usage(fl.quality_filter(r), "V"), r.select(F.col("v_call").alias("gene"))).select("gene", "count", "unique_CDR3"))
query("JOI1_germline_lookup", ", g AS (SELECT v_call, min(V_nt) AS germline FROM r WHERE V_errors = 0 GROUP BY 1) SELECT r.v_call, count(*) AS n, sum(levenshtein(V_nt, germline))::BIGINT AS distance FROM r JOIN g ON r.v_call = g.v_call GROUP BY 1")(
    lambda r: r.join(r.where("V_errors = 0").groupBy("v_call").agg(F.min("V_nt").alias("germline")), "v_call").groupBy("v_call").agg(F.count("*").alias("n"), F.sum(fn.edit_distance(F.col("V_nt"), F.col("germline")).cast("long")).alias("distance")))
query("JOI3_intersection", ", a AS (SELECT v_call, j_call, cdr3, count(*) FILTER (WHERE library = 'O') AS x, count(*) FILTER (WHERE library = 'F') AS y FROM r GROUP BY 1, 2, 3) SELECT v_call, j_call, cdr3, least(x, y) AS count FROM a WHERE x > 0 AND y > 0")(lambda r: db.intersection(r.where("library = 'O'"), r.where("library = 'F'"), ["v_call", "j_call", "cdr3"]))
query("JOI15_common_v", "SELECT V_nt, count(DISTINCT j_call) AS datasets, count(*) AS rows FROM r GROUP BY 1 HAVING count(DISTINCT j_call) >= 2")(lambda r: db.common_sequences(r, "V_nt", "j_call", 2))
query("JOI5_substrings", ", n AS (SELECT DISTINCT cdr3 AS needle FROM r WHERE cdr3 <> ''), h AS (SELECT DISTINCT VDJ_nt AS haystack FROM r) SELECT needle, haystack FROM n JOIN h ON contains(haystack, needle)")(lambda r: db.substrings(r.select(F.col("cdr3").alias("needle")), r.select(F.col("VDJ_nt").alias("haystack"))))
query("JOI6_prefix_join", ", k AS (SELECT DISTINCT V_nt AS candidate FROM r WHERE V_errors = 0) SELECT candidate, count(*) AS full_exact FROM r JOIN k ON starts_with(VDJ_nt, candidate) GROUP BY 1")(lambda r: db.starting_with(r.select("VDJ_nt"), "VDJ_nt", r.where("V_errors = 0").select(F.col("V_nt").alias("candidate")).distinct(), "candidate").groupBy("candidate").agg(F.count("*").alias("full_exact")))
query("SET3_missing", "SELECT DISTINCT VDJ_nt FROM r WHERE library = 'O' AND VDJ_nt NOT IN (SELECT VDJ_nt FROM r WHERE library = 'F' AND V_errors < 2)")(
    lambda r: r.where("library = 'O'").select("VDJ_nt").distinct().join(r.where("library = 'F' AND V_errors < 2").select("VDJ_nt"), "VDJ_nt", "left_anti"))
query("SET2_differences", ", a AS (SELECT DISTINCT V_nt FROM r WHERE V_errors < 3), b AS (SELECT DISTINCT V_nt FROM r WHERE V_errors > 1) SELECT coalesce(a.V_nt, b.V_nt) AS V_nt, CASE WHEN a.V_nt IS NULL THEN 'b' WHEN b.V_nt IS NULL THEN 'a' ELSE 'both' END AS side FROM a FULL JOIN b ON a.V_nt = b.V_nt")(
    lambda r: r.where("V_errors < 3").select("V_nt").distinct().withColumn("a", F.lit(1)).join(r.where("V_errors > 1").select("V_nt").distinct().withColumn("b", F.lit(1)), "V_nt", "full_outer").select("V_nt", F.when(F.col("a").isNull(), "b").when(F.col("b").isNull(), "a").otherwise("both").alias("side")))
query("SRT6_subsample", "SELECT v_call, sequence_id, k FROM (SELECT *, row_number() OVER (PARTITION BY v_call ORDER BY md5('1' || sequence_id), sequence_id)::INT AS k FROM r) WHERE k <= 20")(
    lambda r: r.withColumn("k", F.row_number().over(Window.partitionBy("v_call").orderBy(F.md5(F.concat(F.lit("1"), "sequence_id")), "sequence_id"))).where("k <= 20").select("v_call", "sequence_id", "k"))
query("SRT1_natural_order", "SELECT DISTINCT v_call, 'ighv' || lpad(regexp_extract(v_call, 'IGHV([0-9]+)', 1), 12, '0') || '-' || lpad(regexp_extract(v_call, '-([0-9]+)', 1), 12, '0') || '*' || lpad(regexp_extract(v_call, '[*]([0-9]+)', 1), 12, '0') AS key FROM r")(lambda r: r.select("v_call").distinct().select("v_call", db.natural_key(F.col("v_call")).alias("key")))
MUTATED = "CASE WHEN cdr3 = '' THEN '' ELSE concat(substring(cdr3, 1, V_errors), 'A', substring(cdr3, V_errors + 2)) END"
query("SIM6_within_one", f", s AS (SELECT DISTINCT v_call, j_call, {MUTATED} AS c FROM r WHERE cdr3 <> '') SELECT x.v_call, x.j_call, x.c AS a, y.c AS b FROM s x JOIN s y ON x.v_call = y.v_call AND x.j_call = y.j_call AND length(x.c) = length(y.c) AND x.c < y.c WHERE hamming(x.c, y.c) = 1")(
    lambda r: sim.within_one(r.where("cdr3 <> ''").select("v_call", "j_call", F.expr(MUTATED).alias("c")), ["v_call", "j_call"], "c"))
query("SIM8_clonotypes", f""", s AS (SELECT DISTINCT j_call, {MUTATED} AS c FROM r WHERE cdr3 <> ''),
 l AS (SELECT x.j_call, x.c AS a, y.c AS b FROM s x JOIN s y ON x.j_call = y.j_call AND length(x.c) = length(y.c) WHERE hamming(x.c, y.c) = 1),
 t(j_call, a, b) AS (SELECT j_call, c, c FROM s UNION SELECT t.j_call, t.a, l.b FROM t JOIN l ON t.j_call = l.j_call AND t.b = l.a)
 SELECT j_call, a AS cdr3, min(b) AS root FROM t GROUP BY 1, 2""")(lambda r: sim.clonotypes(r.select("j_call", F.expr(MUTATED).alias("cdr3")), ("j_call",)))
SQL["SIM8_clonotypes"] = SQL["SIM8_clonotypes"].replace("WITH ", "WITH RECURSIVE ", 1)
#: A fifth of the length may differ, and what is before base 3 or behind base 6 must be equal.
query("SIM8_core_clonotypes", f""", s AS (SELECT DISTINCT v_call, {MUTATED} AS c FROM r WHERE cdr3 <> ''),
 l AS (SELECT x.v_call, x.c AS a, y.c AS b FROM s x JOIN s y ON x.v_call = y.v_call AND length(x.c) = length(y.c) AND x.c <> y.c WHERE hamming(x.c, y.c) <= (length(x.c) - 3) * 0.2 AND (left(x.c, 3) = left(y.c, 3) OR substring(x.c, 7) = substring(y.c, 7))),
 t(v_call, a, b) AS (SELECT v_call, c, c FROM s UNION SELECT t.v_call, t.a, l.b FROM t JOIN l ON t.v_call = l.v_call AND t.b = l.a)
 SELECT v_call, a AS cdr3, min(b) AS root FROM t GROUP BY 1, 2""")(lambda r: sim.clonotypes(r.select("v_call", F.expr(MUTATED).alias("cdr3")), ("v_call",), mismatches=0.2, core_start=3, core_end=6))
SQL["SIM8_core_clonotypes"] = SQL["SIM8_core_clonotypes"].replace("WITH ", "WITH RECURSIVE ", 1)
query("SIM3_similar_cdr3", ", s AS (SELECT DISTINCT v_call, cdr3 FROM r WHERE cdr3 <> '') SELECT x.v_call, x.cdr3 AS a, y.cdr3 AS b FROM s x JOIN s y ON x.v_call = y.v_call AND length(x.cdr3) = length(y.cdr3) AND x.cdr3 < y.cdr3 WHERE hamming(x.cdr3, y.cdr3) <= 5")(
    lambda r: (lambda s: s.withColumnRenamed("cdr3", "a").join(s.withColumnRenamed("cdr3", "b"), "v_call").where((F.col("a") < F.col("b")) & fn.similar_cdr3(F.col("a"), F.col("b"), 5)))(r.where("cdr3 <> ''").select("v_call", "cdr3").distinct()))
query("SIM1_edit_distance", ", s AS (SELECT DISTINCT v_call, V_nt FROM r) SELECT x.v_call, x.V_nt AS a, y.V_nt AS b, least(levenshtein(x.V_nt, y.V_nt), 11)::INT AS d FROM s x JOIN s y ON x.v_call = y.v_call AND x.V_nt < y.V_nt")(
    lambda r: (lambda s: s.withColumnRenamed("V_nt", "a").join(s.withColumnRenamed("V_nt", "b"), "v_call").where("a < b").withColumn("d", fn.edit_distance(F.col("a"), F.col("b"), 10)))(r.select("v_call", "V_nt").distinct()))
query("JOI2_clonoquery", """, q AS (SELECT DISTINCT v_call, j_call, cdr3 FROM r WHERE library = 'F' AND V_errors = 0), x AS (SELECT v_call, j_call, cdr3, sequence_id FROM r WHERE library = 'O')
 SELECT q.v_call, q.j_call, q.cdr3, x.sequence_id AS match FROM q LEFT JOIN x ON q.v_call = x.v_call AND q.j_call = x.j_call AND length(q.cdr3) = length(x.cdr3) AND (q.cdr3 = x.cdr3 OR length(q.cdr3) > 0 AND hamming(q.cdr3, CASE WHEN length(q.cdr3) = length(x.cdr3) THEN x.cdr3 ELSE q.cdr3 END) <= 2)""")(
    lambda r: sim.clonoquery(r.where("library = 'F' AND V_errors = 0").select("v_call", "j_call", "cdr3").distinct(), r.where("library = 'O'"), 2).select("v_call", "j_call", "cdr3", F.col("sequence_id_ref").alias("match")))
query("SIM13_mindiffrate", """, o AS (SELECT *, first_value(cdr3) OVER (PARTITION BY v_call, j_call, length(cdr3) ORDER BY V_SHM, sequence_id) AS root FROM r WHERE cdr3 <> '')
 SELECT sequence_id, round(levenshtein(root, cdr3) / length(cdr3)::DOUBLE * 100, 1) AS rate FROM o""")(lambda r: r.where("cdr3 <> ''").withColumn("root", F.first("cdr3").over(Window.partitionBy("v_call", "j_call", F.length("cdr3")).orderBy("V_SHM", "sequence_id"))).select("sequence_id", F.round(F.levenshtein("root", "cdr3") / F.length("cdr3") * 100, 1).alias("rate")))
query("PRE3_dereplicate", "SELECT VDJ_nt AS sequence, count(*) AS size, min(sequence_id) AS name FROM r GROUP BY 1")(lambda r: pre.dereplicate(r.select(F.col("VDJ_nt").alias("sequence"), F.col("sequence_id").alias("name"), F.col("sequence_id").alias("_row"))).select("sequence", "size", "name"))
query("PRE1_barcode_split", "SELECT left(VDJ_nt, 4) AS barcode, substring(VDJ_nt, 5) AS body, count(*) AS count FROM r GROUP BY 1, 2")(lambda r: r.groupBy(pre.barcode(F.col("VDJ_nt"), 4).alias("barcode"), pre.unbarcoded(F.col("VDJ_nt"), 4).alias("body")).agg(F.count("*").alias("count")))
query("PRE2_trim_g", "SELECT DISTINCT VDJ_nt, ltrim(VDJ_nt, 'G') AS trimmed FROM r")(lambda r: r.select("VDJ_nt", pre.trim_g(F.col("VDJ_nt")).alias("trimmed")).distinct())
query("PRE6_neighbours", ", c AS (SELECT DISTINCT cdr3 FROM r WHERE cdr3 <> '') SELECT DISTINCT cdr3, left(cdr3, i::INT - 1) || b || substring(cdr3, i + 1) AS neighbour FROM (SELECT cdr3, unnest(range(1, length(cdr3) + 1)) AS i FROM c), (SELECT unnest(['A', 'C', 'G', 'T']) AS b)")(lambda r: pre.hamming_neighbours(r, "cdr3"))
query("PRE10_barcode_statistics", ", n AS (SELECT barcode, count(*) AS n FROM r GROUP BY 1) SELECT count(*) AS unique_barcodes, count(*) FILTER (WHERE n = 1) AS singletons, count(*) FILTER (WHERE n = 2) AS pairs, count(*) FILTER (WHERE n > 2) AS larger FROM n")(pre.barcode_statistics)
query("PRE11_length_histogram", "SELECT length(VDJ_nt) AS length, count(*) AS frequency FROM r GROUP BY 1")(lambda r: pre.length_histogram(r, "VDJ_nt"))
query("PRE13_names_by_sequence", "SELECT V_nt, string_agg(v_call, ',' ORDER BY v_call) AS names FROM (SELECT DISTINCT V_nt, v_call FROM r) GROUP BY 1")(lambda r: pre.names_by_sequence(r.select("V_nt", "v_call").distinct(), "v_call", "V_nt"))


def candidates(r: DataFrame) -> DataFrame:
    w = Window.partitionBy("source").orderBy("consensus")
    c = r.groupBy(F.col("v_call").alias("source"), F.col("V_nt").alias("consensus")).agg(F.count("*").alias("cluster_size"), ex.distinct_nonempty("cdr3").alias("CDR3s_exact"), ex.distinct_nonempty("j_call").alias("Js_exact"), ex.distinct_nonempty("d_call").alias("Ds_exact"), F.sum((F.col("V_errors") == 0).cast("long")).alias("exact"))
    return c.withColumn("name", F.concat("source", F.lit("_"), F.dense_rank().over(w)))


_gene = "split_part({0}.source, '*', 1)"
_reasons = """CASE WHEN x.cluster_size >= y.cluster_size AND starts_with(x.consensus, y.consensus) THEN 'identical_to'
 WHEN g AND y.CDR3s_exact::DOUBLE / nullif(x.CDR3s_exact, 0) < 0.12 THEN 'clonotype_ratio' WHEN g AND y.exact::DOUBLE / nullif(x.exact, 0) < 0.1 THEN 'exact_ratio'
 WHEN g AND x.cluster_size >= y.cluster_size AND x.Ds_exact >= 10 AND y.Ds_exact::DOUBLE / x.Ds_exact < 0.35 THEN 'unique_D_ratio' END"""
EDGES = f", {CANDIDATES}, e AS (SELECT * FROM (SELECT x.name AS reference, y.name AS candidate, {_reasons.replace('g AND', _gene.format('x') + ' = ' + _gene.format('y') + ' AND')} AS reason FROM c x JOIN c y ON x.name <> y.name) WHERE reason IS NOT NULL)"
query("DIS_candidates", f", {CANDIDATES} SELECT name, source, consensus, cluster_size, CDR3s_exact, Js_exact, Ds_exact, exact::BIGINT AS exact FROM c")(lambda r: candidates(r).select("name", "source", "consensus", "cluster_size", "CDR3s_exact", "Js_exact", "Ds_exact", "exact"))
query("FIL12_candidate_marks", f", {CANDIDATES} SELECT name, concat_ws(';', CASE WHEN CDR3s_exact < 20 THEN 'too_low_CDR3s_exact' END, CASE WHEN Js_exact < 10 THEN 'too_low_Js_exact' END) AS why_filtered FROM c")(
    lambda r: fl.marked(candidates(r), {"too_low_CDR3s_exact": F.col("CDR3s_exact") < 20, "too_low_Js_exact": F.col("Js_exact") < 10}).select("name", F.array_join("why_filtered", ";").alias("why_filtered")))
query("GER_edges", EDGES + " SELECT reference, candidate, reason FROM e")(lambda r: db.elimination_edges(candidates(r)))
GREEDY = EDGES + """, o AS (SELECT name, row_number() OVER (ORDER BY name) AS i FROM c), h AS (SELECT r.i, list(q.i) AS hits FROM e JOIN o r ON r.name = reference JOIN o q ON q.name = candidate GROUP BY 1),
 g(i, gone) AS (SELECT 0::BIGINT, []::BIGINT[] UNION ALL SELECT g.i + 1, CASE WHEN h.i IS NULL OR list_contains(gone, g.i + 1) THEN gone ELSE list_distinct(gone || hits) END FROM g LEFT JOIN h ON h.i = g.i + 1 WHERE g.i < (SELECT count(*) FROM o)),
 f AS (SELECT gone FROM g WHERE i = (SELECT count(*) FROM o)) SELECT name FROM o, f WHERE NOT list_contains(gone, i)"""
query("GER7_survivors", GREEDY)(lambda r: (lambda c: db.survivors(c, db.elimination_edges(c)))(candidates(r)))
SQL["GER7_survivors"] = SQL["GER7_survivors"].replace("WITH ", "WITH RECURSIVE ", 1)
query("JOI10_closest", f", {CANDIDATES}, w AS (SELECT name, consensus FROM c WHERE source LIKE '%*01'), d AS (SELECT c.name, levenshtein(c.consensus, w.consensus) AS distance, w.name AS closest FROM c CROSS JOIN w), k AS (SELECT *, row_number() OVER (PARTITION BY name ORDER BY distance, closest) AS k FROM d) SELECT name, distance::INT AS distance, closest FROM k WHERE k = 1")(
    lambda r: (lambda c: db.nearest(c.select("name", F.col("consensus").alias("sequence")), c.where("source LIKE '%*01'").select("name", F.col("consensus").alias("sequence"))))(candidates(r)))
#: Known sequences, and new ones put together from the beginning of one and the end of another.
CHIMERAS = ", k AS (SELECT DISTINCT V_nt AS sequence FROM r WHERE V_errors < 2), n AS (SELECT V_nt, lead(V_nt) OVER (ORDER BY V_nt) AS after FROM (SELECT DISTINCT V_nt FROM r WHERE V_errors < 3)), q AS (SELECT left(V_nt, 14) || right(after, 15) AS sequence FROM n WHERE after IS NOT NULL), x AS (SELECT q.sequence, i, k1.sequence AS p, k2.sequence AS s FROM (SELECT sequence, unnest(range(10, length(sequence) - 9)) AS i FROM q) q JOIN k k1 ON starts_with(k1.sequence, left(q.sequence, i::INT)) JOIN k k2 ON suffix(k2.sequence, substring(q.sequence, i + 1)))"


def chimeras(r: DataFrame) -> DataFrame:
    known = r.where("V_errors < 2").select(F.col("V_nt").alias("name"), F.col("V_nt").alias("sequence")).distinct()
    after = F.lead("V_nt").over(Window.orderBy("V_nt"))  # a few hundred sequences
    new = r.where("V_errors < 3").select("V_nt").distinct().withColumn("after", after).where("after IS NOT NULL")
    new = new.select(F.concat(F.left("V_nt", F.lit(14)), F.right("after", F.lit(15))).alias("sequence"))
    found = db.chimeras(new.select(F.col("sequence").alias("name"), "sequence"), known)
    return found.select(F.col("name").alias("sequence"), "k", "prefix_of", "suffix_of")


query("JOI13_chimeras", CHIMERAS + " SELECT sequence, i::INT AS k, min(p) AS prefix_of, min(s) AS suffix_of FROM x WHERE i = (SELECT min(y.i) FROM x y WHERE y.sequence = x.sequence) GROUP BY 1, 2")(chimeras)
query("HAP1_expressed_alleles", ", u AS (SELECT v_call AS gene, count(*) AS count FROM r WHERE library = 'O' GROUP BY 1) SELECT gene, count FROM (SELECT *, max(count) OVER (PARTITION BY split_part(gene, '*', 1)) AS top FROM u) WHERE count >= 0.1 * top")(lambda r: db.expressed_alleles(r.where("library = 'O'").groupBy(F.col("v_call").alias("gene")).agg(F.count("*").alias("count"))))
query("HAP2_heterozygous", ", u AS (SELECT split_part(j_call, '*', 1) AS g, j_call, count(*) AS n FROM r WHERE j_call <> '' GROUP BY 1, 2), e AS (SELECT * FROM (SELECT *, max(n) OVER (PARTITION BY g) AS top FROM u) WHERE n >= 0.1 * top) SELECT g AS gene, sum(n)::BIGINT AS total FROM e GROUP BY 1 HAVING count(*) = 2 ORDER BY total DESC, gene LIMIT 5")(lambda r: db.heterozygous(r.where("j_call <> ''").groupBy(F.col("j_call").alias("gene")).agg(F.count("*").alias("count"))))
