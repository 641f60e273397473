"""Queries of augment, discovery, haplotypes and comparisons over the assigned table, with their SQL where it can say the same."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import cdr3 as c3
from ..functions import sequence as fn
from ..operators import augment as aug
from ..operators import clustering as cl
from ..operators import compare as cmp
from ..operators import consensus as cs
from ..operators import database as db
from ..operators import discovery as dis
from ..operators import filters as fl
from ..operators import haplotypes as hap
from ..shipping import ship
from ..sources import reads as rd
from ..sources import tables as tb
from .adapter import R, rearrangements
from .assigned import A, assigned, germline

QUERIES: dict = {}
SQL: dict[str, str] = {}


def prepared(spark: SparkSession) -> None:
    ship(spark)
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if spark.sparkContext.getCheckpointDir() is None:
        import tempfile

        # on a cluster the setting is there; without it, as in tests, a local folder does
        spark.sparkContext.setCheckpointDir(folder or "file://" + tempfile.mkdtemp(prefix="lymphora-"))


def query(name: str, sql: str | None = None, rows: bool = False):
    """Registers f(spark, table) over the assigned table, or with rows over the rearrangements."""

    def put(f):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            prepared(spark)
            return f(spark, (rearrangements if rows else assigned)(spark, sf_dir))

        QUERIES[name] = run
        if sql:
            base = R if rows else A
            SQL[name] = f"WITH {'RECURSIVE ' if 'RECURSIVE ' in sql[:12] else ''}{base}{sql.removeprefix('RECURSIVE ')}" if sql.startswith((",", "RECURSIVE ,")) else f"WITH {base} {sql}"
        return f

    return put


CLEAN = "ltrim({0}, '%')"


@query("AUG1_clean_calls", f"SELECT {CLEAN.format('v_call')} AS v_call, {CLEAN.format('d_call')} AS d_call, {CLEAN.format('j_call')} AS j_call, count(*) AS n FROM a GROUP BY 1, 2, 3")
def clean_calls(spark, a):
    return a.groupBy(*(aug.clean_call(F.col(c)).alias(c) for c in ("v_call", "d_call", "j_call"))).agg(F.count("*").alias("n"))


@query("AUG2_mutation", "SELECT sequence_id, round(100.0 - v_identity, 6) AS V_SHM, round(100.0 - j_identity, 6) AS J_SHM FROM a")
def mutation(spark, a):
    return a.select("sequence_id", F.round(100.0 - F.col("v_identity"), 6).alias("V_SHM"), F.round(100.0 - F.col("j_identity"), 6).alias("J_SHM"))


@query("AUG3_header", "SELECT sequence_id AS header, split_part(sequence_id, ';', 1) AS sequence_id, regexp_extract(sequence_id, ';size=([0-9]+)', 1)::INT AS count, regexp_extract(sequence_id, ';barcode=([^;]*)', 1) AS barcode FROM a")
def header(spark, a):
    return a.select(F.col("sequence_id").alias("header"), *(c.alias(n) for n, c in aug.header_fields(F.col("sequence_id")).items()))


def errors_sql(g: str) -> str:
    q, s = f"{g}_germline_alignment", f"{g}_sequence_alignment"
    return f"CASE WHEN {q} <> '' AND {s} <> '' THEN hamming(CASE WHEN {q} = '' OR {s} = '' THEN 'x' ELSE {q} END, CASE WHEN {q} = '' OR {s} = '' THEN 'x' ELSE {s} END)::INT END AS {g.upper()}_errors"


@query("AUG4_errors", f"SELECT sequence_id, {', '.join(map(errors_sql, 'vdj'))} FROM a")
def errors(spark, a):
    return a.select("sequence_id", *(aug.errors(F.col(f"{g}_germline_alignment"), F.col(f"{g}_sequence_alignment")).alias(f"{g.upper()}_errors") for g in "vdj"))


@query("AUG5_covered", "SELECT sequence_id, round(length(replace(v_germline_alignment, '-', '')) / 60.0 * 100, 6) AS V_covered, CASE WHEN d_call <> '' THEN round(length(replace(d_germline_alignment, '-', '')) / 18.0 * 100, 6) END AS D_covered, round(length(replace(j_germline_alignment, '-', '')) / 26.0 * 100, 6) AS J_covered FROM a")
def covered(spark, a):
    return augment_of(spark, a, "V_covered", "D_covered", "J_covered", shown=lambda c: F.round(c, 6))


def augment_of(spark, a, *columns, shown=lambda c: c):
    x = a.withColumn("header", F.col("sequence_id"))
    out = aug.augmented(x, germline(spark, "v"), germline(spark, "d"), germline(spark, "j"))
    return out.select(F.col("header").alias("sequence_id"), *(shown(F.col(c)).alias(c) for c in columns))


GENE = ", g AS (SELECT DISTINCT v_no, v_sub, gv FROM a2)"
REGION = {"FR1": ("fwr1", 4, 12), "CDR1": ("cdr1", 13, 21), "FR2": ("fwr2", 22, 30), "CDR2": ("cdr2", 31, 36), "FR3": ("fwr3", 37, 45)}
STOPS = "('TAA', 'TAG', 'TGA')"
SOUND = " AND ".join(f"substring(gv, {k}, 3) NOT IN {STOPS}" for k in range(4, 45, 3))
KNOWN = f", g AS (SELECT concat('%IGHV', 1 + v_no, '-', 1 + v_sub, '*01') AS v_call, any_value(gv) AS gv FROM a2 GROUP BY 1 HAVING {SOUND.replace('gv', 'any_value(gv)')})"


@query("AUG6_region_mutation", KNOWN + " SELECT sequence_id, " + ", ".join(f"round(100.0 * levenshtein(substring(gv, {x}, {y - x + 1}), substring(sequence, {c}_start, {c}_end - {c}_start + 1)) / {y - x + 1}, 6) AS {r}_SHM" for r, (c, x, y) in REGION.items()) + " FROM a LEFT JOIN g USING (v_call)")
def region_mutation(spark, a):
    return augment_of(spark, a, *(f"{r}_SHM" for r in REGION), shown=lambda c: F.round(c, 6))


@query("AUG7_amino_acid_mutation")
def amino_acid_mutation(spark, a):
    return augment_of(spark, a, *(f"{r}_aa_mut" for r in REGION), "V_aa_mut", shown=lambda c: F.round(c, 6))


#: All V genes end in YYCAR and J's motif begins at base 12, so the CDR3 is what lies between. Rows of a short V alignment are rescued.
CDR3 = """, m AS (SELECT *, 4 + length(replace(v_sequence_alignment, '-', '')) + CASE WHEN v_germline_end < 60 THEN 54 - v_germline_end ELSE -6 END AS b, j_sequence_start - 1 + 8 AS e FROM a)"""


@query("AUG8_cdr3", CDR3 + " SELECT sequence_id, CASE WHEN locus = 'IGH' THEN b + 1 END::INT AS cdr3_start, CASE WHEN locus = 'IGH' THEN e END::INT AS cdr3_end, CASE WHEN locus = 'IGH' THEN substring(sequence, b + 1, e - b) ELSE '' END AS cdr3, CASE WHEN locus = 'IGH' THEN b + 1 - v_sequence_start ELSE 0 END::INT AS V_CDR3_start FROM m")
def cdr3(spark, a):
    # J genes whose first motif lies elsewhere are left to pytest
    return augment_of(spark, a, "cdr3_start", "cdr3_end", "cdr3", "V_CDR3_start")


@query("AUG9_query_position", "SELECT sequence_id, CASE WHEN v_germline_start = 21 THEN 4 ELSE 4 + length(replace(substring(v_sequence_alignment, 1, 21 - v_germline_start), '-', '')) END::INT AS p20 FROM a")
def query_position(spark, a):
    return a.select("sequence_id", aug.query_position("v", F.lit(20)).alias("p20"))


@query("AUG11_fwr4")
def fwr4(spark, a):
    return augment_of(spark, a, "fwr4_start", "fwr4_end", "fwr4", "fwr4_aa", "FR4_SHM", "J_aa_mut")


@query("AUG13_one_decimal", "SELECT sequence_id, printf('%.1f', j_identity) AS J_SHM FROM a")
def one_decimal(spark, a):
    return tb.shown(a.select("sequence_id", F.col("j_identity").alias("J_SHM")))


@query("AUG14_regions", KNOWN + " SELECT replace(v_call, '%', '') AS gene, " + ", ".join(f"substring(gv, {x}, {y - x + 1}) AS {r}_nt" for r, (_, x, y) in REGION.items()) + " FROM g")
def regions(spark, a):
    return aug.regions(germline(spark, "v")).where("FR1_nt IS NOT NULL").select("gene", *(f"{r}_nt" for r in REGION))


@query("AUG15_virtual_columns", "SELECT sequence_id, substring(sequence, v_sequence_start, j_sequence_end - v_sequence_start + 1) AS VDJ_nt, replace(v_sequence_alignment, '-', '') AS V_nt, replace(d_sequence_alignment, '-', '') AS D_region, replace(j_sequence_alignment, '-', '') AS J_nt FROM a")
def virtual(spark, a):
    return a.select("sequence_id", *(tb.computed(c).alias(c) for c in ("VDJ_nt", "V_nt", "D_region", "J_nt")))


@query("AUG17_v_without_cdr3", "SELECT sequence_id, CASE WHEN V_errors = 0 THEN V_nt ELSE left(V_nt, V_errors * 5) END AS V_no_CDR3 FROM r", rows=True)
def without_cdr3(spark, r):
    return aug.v_without_cdr3(r.withColumn("V_CDR3_start", F.col("V_errors") * 5)).select("sequence_id", "V_no_CDR3")


@query("FN4_find_cdr3")
def find_cdr3(spark, a):
    return a.select("sequence_id", *(c3.find_cdr3(F.col("sequence"), x).alias(x) for x in ("IGH", "IGK", "IGL")))


@query("FN5_cdr3_start", ", g AS (SELECT DISTINCT v_no, v_sub FROM a1) SELECT concat('IGHV', 1 + v_no, '-', 1 + v_sub, '*01') AS gene, 54 AS cdr3_start FROM g")
def v_start(spark, a):
    return germline(spark, "v").select("gene", c3.cdr3_start(F.col("sequence"), "IGH").alias("cdr3_start"))


@query("FN6_cdr3_end")
def j_end(spark, a):
    return germline(spark, "j").select("gene", c3.cdr3_end(F.col("sequence"), "IGH").alias("cdr3_end"))


@query("FN7_merged_pairs", ", p AS (SELECT key, left(sequence, 70) AS f, substring(sequence, 41) AS b FROM a5) SELECT key AS name, f || substring(b, 31) AS sequence FROM p")
def merged_pairs(spark, a):
    a = a.withColumn("key", F.substring_index("sequence_id", ";", 1))
    back = a.select(F.col("key").alias("name"), fn.reverse_complement(F.substring("sequence", 41, 1000)).alias("sequence"))
    return rd.merged_pairs(a.select(F.col("key").alias("name"), F.left("sequence", F.lit(70)).alias("sequence")), back, 30)


@query("FN9_changes")
def changes(spark, a):
    own = a.select(aug.clean_call(F.col("v_call")).alias("gene"), F.replace("v_sequence_alignment", F.lit("-"), F.lit("")).alias("query")).distinct()
    return cs.described(own.join(germline(spark, "v").select("gene", "sequence"), "gene"), "sequence", "query").select("gene", "query", "changes")


@query("FN11_safe_divide", "SELECT v_call, CASE WHEN sum(J_errors) = 0 THEN 0 ELSE sum(V_errors) / sum(J_errors)::DOUBLE END AS ratio FROM r WHERE J_errors = 0 OR V_errors > 1 GROUP BY 1", rows=True)
def divided(spark, r):
    return r.where("J_errors = 0 OR V_errors > 1").groupBy("v_call").agg(fn.safe_divide(F.sum("V_errors").cast("double"), F.sum("J_errors").cast("double")).alias("ratio"))


@query("FN14_repeated_sequences", ", g AS (SELECT v_call, any_value(V_nt) AS s FROM (SELECT DISTINCT v_call, V_nt FROM r WHERE V_errors = 1) GROUP BY 1 HAVING count(*) = 1), w AS (SELECT v_call AS name, first_value(v_call) OVER (PARTITION BY s ORDER BY v_call) AS first FROM g) SELECT name, first FROM w WHERE name <> first", rows=True)
def repeated(spark, r):
    g = r.where("V_errors = 1").select("v_call", "V_nt").distinct().groupBy("v_call").agg(F.count("*").alias("n"), F.min("V_nt").alias("sequence")).where("n = 1")
    return cmp.repeated_sequences(g.select(F.col("v_call").alias("_row"), F.col("v_call").alias("name"), "sequence"))


@query("FIL4_usable_cdr3", "SELECT sequence_id FROM r WHERE cdr3 <> '' AND NOT contains(V_nt, 'TAG')", rows=True)
def usable(spark, r):
    return fl.usable_cdr3(r.withColumn("aa", F.replace("V_nt", F.lit("TAG"), F.lit("*"))), "aa").select("sequence_id")


@query("FIL6_count_filter", "SELECT sequence_id FROM r WHERE d_support <= 0.0004 AND D_covered >= 60 AND D_errors <= 1", rows=True)
def count_filter(spark, r):
    return fl.count_filter(r, 0.0004, 60, 1).select("sequence_id")


@query("FIL7_other_gene", "SELECT sequence_id FROM r WHERE J_covered >= 90 AND V_errors = 0", rows=True)
def other_gene(spark, r):
    return r.where((F.col("J_covered") >= 90) & (F.col("V_errors") == 0)).select("sequence_id")


@query("FIL8_minimum_count", "SELECT sequence_id FROM r WHERE copies >= 4", rows=True)
def minimum_count(spark, r):
    return fl.frequent_rows(r, 4, "copies").select("sequence_id")


@query("FIL11_minimum_length", "SELECT sequence_id FROM r WHERE length(VDJ_nt) >= 42", rows=True)
def minimum_length(spark, r):
    return fl.long_enough(r, 42, "VDJ_nt").select("sequence_id")


@query("FIL14_n_bases", "SELECT sequence_id, length(x) - length(replace(x, 'N', '')) AS n FROM (SELECT sequence_id, replace(V_nt, 'TT', 'NT') AS x FROM r)", rows=True)
def bases(spark, r):
    return r.select("sequence_id", fl.n_bases(F.replace("V_nt", F.lit("TT"), F.lit("NT"))).alias("n"))


@query("FIL15_group_sizes", "SELECT sequence_id, v_call FROM r QUALIFY count(*) OVER (PARTITION BY v_call, cdr3) >= 4", rows=True)
def group_sizes(spark, r):
    return dis.large_enough(r, ["v_call", "cdr3"], 4).select("sequence_id", "v_call")


@query("FIL16_gates", "SELECT count(*) AS total, count(*) FILTER (WHERE V_errors < 4) AS merged, count(*) FILTER (WHERE V_errors < 3) AS trimmed FROM r", rows=True)
def gated(spark, r):
    return fl.gates(r.agg(F.count("*").alias("total"), F.sum((F.col("V_errors") < 4).cast("long")).alias("merged"), F.sum((F.col("V_errors") < 3).cast("long")).alias("trimmed")))


@query("PRE8_repeated_names", "SELECT barcode, cdr3 AS name, count(*) AS n FROM r GROUP BY 1, 2 HAVING count(*) > 1", rows=True)
def names(spark, r):
    return rd.repeated_names(r.select("barcode", F.col("cdr3").alias("name")))


@query("PRE9_trimmed", "SELECT sequence_id, substring(VDJ_nt, 3) AS sequence FROM r WHERE regexp_matches(VDJ_nt, '^[AG]C')", rows=True)
def trimmed(spark, r):
    return rd.trimmed(r.select("sequence_id", F.col("VDJ_nt").alias("sequence")), ["RC"], [], stranded=True)


@query("JOI7_not_contained", ", s AS (SELECT DISTINCT cdr3 AS sequence FROM r WHERE cdr3 <> '' UNION SELECT DISTINCT substring(cdr3, 2, 8) FROM r WHERE cdr3 <> '' AND V_errors = 0) SELECT sequence FROM s WHERE NOT EXISTS (SELECT 1 FROM s x WHERE x.sequence <> s.sequence AND contains(x.sequence, s.sequence))", rows=True)
def not_contained(spark, r):
    own = r.where("cdr3 <> ''")
    both = own.select(F.col("cdr3").alias("sequence")).unionByName(own.where("V_errors = 0").select(F.substring("cdr3", 2, 8).alias("sequence")))
    return dis.without_contained(both.distinct())


PREFIXES = ", q AS (SELECT DISTINCT left(V_nt, 10 + 5 * V_errors) AS q FROM r WHERE V_errors < 3), k AS (SELECT v_call AS name, min(left(V_nt, 20)) AS sequence FROM r WHERE V_errors = 1 GROUP BY 1), m AS (SELECT q, name FROM q JOIN k ON starts_with(q, sequence) OR starts_with(sequence, q))"


def prefix_tables(r):
    q = r.where("V_errors < 3").select(F.left("V_nt", F.col("V_errors") * 5 + 10).alias("q")).distinct()
    return q, r.where("V_errors = 1").groupBy(F.col("v_call").alias("name")).agg(F.min(F.left("V_nt", F.lit(20))).alias("sequence"))


@query("JOI8_prefix_lookup", PREFIXES + " SELECT q, CASE WHEN count(name) = 1 THEN min(name) END AS name FROM q LEFT JOIN m USING (q) GROUP BY 1", rows=True)
def prefix_lookup(spark, r):
    return cmp.prefix_lookup(*prefix_tables(r))


@query("JOI9_is_new", PREFIXES + " SELECT q AS sequence, NOT EXISTS (SELECT 1 FROM m WHERE m.q = q.q) AS new FROM q", rows=True)
def is_new(spark, r):
    q, k = prefix_tables(r)
    return cmp.is_new(q.withColumnRenamed("q", "sequence"), k)


@query("JOI11_nearest_in_order", ", d AS (SELECT v_call AS name, min(V_nt) AS s FROM r WHERE V_errors = 0 GROUP BY 1), q AS (SELECT DISTINCT V_nt AS sequence FROM r), x AS (SELECT sequence, levenshtein(sequence, s) AS n, name, row_number() OVER (PARTITION BY sequence ORDER BY levenshtein(sequence, s), name DESC) AS k FROM q CROSS JOIN d) SELECT sequence, n::INT AS db_distance, name AS db_name FROM x WHERE k = 1", rows=True)
def nearest_in_order(spark, r):
    from pyspark.sql.window import Window

    d = r.where("V_errors = 0").groupBy(F.col("v_call").alias("name")).agg(F.min("V_nt").alias("sequence"))
    d = d.withColumn("_row", F.row_number().over(Window.orderBy(F.desc("name"))))  # a database of 105 genes
    return dis.nearest_in_order(r.select(F.col("V_nt").alias("sequence")), d)


@query("JOI12_whitelisted", ", c AS (SELECT DISTINCT V_nt AS consensus, V_errors FROM r), w AS (SELECT DISTINCT V_nt FROM r WHERE V_errors = 2) SELECT consensus, CASE WHEN consensus IN (SELECT V_nt FROM w) THEN 0 END AS whitelist_diff FROM (SELECT DISTINCT consensus FROM c)", rows=True)
def whitelisted(spark, r):
    return db.whitelisted(r.select(F.col("V_nt").alias("consensus")).distinct(), r.where("V_errors = 2").select(F.col("V_nt").alias("sequence")))


def databases(r):
    a = r.where("V_errors = 0").select(F.col("v_call").alias("name"), F.col("V_nt").alias("sequence")).distinct()
    b = r.where("V_errors = 1").select(F.concat("v_call", F.lit("_x")).alias("name"), F.concat(F.left("V_nt", F.lit(14)), F.lit("A"), F.substring("V_nt", 16, 100)).alias("sequence")).distinct()
    return a, b.unionByName(a.where("name LIKE 'IGHV1%'"))


@query("JOI14_paired_databases", rows=True)
def paired(spark, r):
    return cmp.paired(*databases(r))


@query("JOI16_common_candidates", ", d AS (SELECT DISTINCT j_call AS dataset, v_call AS source, v_call AS name, V_nt AS consensus FROM r WHERE j_call LIKE 'IGHJ1%' OR j_call LIKE 'IGHJ2%'), l AS (SELECT greatest((count(DISTINCT dataset) + 1) // 2, 2) AS n FROM d) SELECT consensus, min((dataset, source))[2] AS source, count(DISTINCT dataset) AS datasets, string_agg(name, ';' ORDER BY dataset, name) AS names FROM d GROUP BY 1 HAVING count(DISTINCT dataset) >= (SELECT n FROM l)", rows=True)
def common(spark, r):
    own = r.where("j_call LIKE 'IGHJ1%' OR j_call LIKE 'IGHJ2%'")
    return cmp.common_candidates(own.select(F.col("j_call").alias("dataset"), F.col("v_call").alias("source"), F.col("v_call").alias("name"), F.col("V_nt").alias("consensus")).distinct())


@query("AGG2_distinct_nonempty", "SELECT v_call, count(DISTINCT nullif(d_call, '')) AS ds FROM r GROUP BY 1", rows=True)
def distinct_values(spark, r):
    from ..operators.expression import distinct_nonempty

    return r.groupBy("v_call").agg(distinct_nonempty("d_call").alias("ds"))


@query("AGG3_group_info", "SELECT v_call, count(*) AS count, count(DISTINCT nullif(cdr3, '')) AS unique_CDR3, count(DISTINCT nullif(j_call, '')) AS unique_J, count(DISTINCT nullif(d_call, '')) FILTER (WHERE D_errors = 0 AND D_covered >= 70 AND d_support <= 0.0001) AS unique_D, count(DISTINCT nullif(barcode, '')) AS unique_barcodes FROM r GROUP BY 1", rows=True)
def info(spark, r):
    return dis.group_info(r, ["v_call"])


@query("AGG15_clonotype_usage", "SELECT v_call AS gene, count(*) AS count FROM (SELECT DISTINCT v_call, j_call, cdr3 FROM r WHERE cdr3 <> '') GROUP BY 1 HAVING count(*) >= 10", rows=True)
def usage(spark, r):
    return cmp.clonotype_usage(r.where("cdr3 <> ''").select("v_call", "j_call", "cdr3").distinct(), "V", 10)


@query("AGG16_ragged", ", k AS (SELECT library, V_SHM, row_number() OVER (PARTITION BY library ORDER BY sequence_id) AS k FROM r) SELECT k::INT AS k, max(V_SHM) FILTER (WHERE library = 'F') AS F, max(V_SHM) FILTER (WHERE library = 'O') AS O FROM k GROUP BY 1", rows=True)
def ragged(spark, r):
    return cmp.ragged(r, "library", "V_SHM", "sequence_id", ["F", "O"])


@query("AGG19_gained_lost", ", x AS (SELECT DISTINCT V_nt FROM r WHERE V_errors < 3), y AS (SELECT DISTINCT V_nt FROM r WHERE V_errors > 1) SELECT (SELECT count(*) FROM y) AS size, (SELECT count(*) FROM y ANTI JOIN x USING (V_nt)) AS gained, (SELECT count(*) FROM x ANTI JOIN y USING (V_nt)) AS lost", rows=True)
def gained(spark, r):
    return cmp.gained_lost(r.where("V_errors < 3"), r.where("V_errors > 1"), "V_nt")


@query("SRT2_external_order", ", g AS (SELECT DISTINCT v_call FROM r), o AS (SELECT 'IGHV' || i || '-1' AS gene, 10 - i AS rank FROM range(1, 5) t(i)) SELECT v_call, row_number() OVER (ORDER BY coalesce(rank, 1000000) * 1000 + split_part(v_call, '*', 2)::INT, v_call)::INT AS place FROM g LEFT JOIN o ON split_part(v_call, '*', 1) = gene", rows=True)
def external_order(spark, r):
    order = spark.createDataFrame([(f"IGHV{i}-1", 10 - i) for i in range(1, 5)], "gene string, rank int")
    rows = [x[0] for x in hap.ordered(r.select("v_call").distinct(), order, F.col("v_call")).collect()]
    return spark.createDataFrame([(v, k) for k, v in enumerate(rows, 1)], "v_call string, place int")


@query("SRT3_by_size", "SELECT v_call, j_call, count(*) AS n FROM r GROUP BY 1, 2", rows=True)
def sized(spark, r):
    return cmp.by_size(r, ["v_call", "j_call"])


@query("SRT4_first_groups", "SELECT v_call, j_call, count(*) AS n FROM r GROUP BY 1, 2 ORDER BY n DESC, v_call, j_call LIMIT 10", rows=True)
def first_groups(spark, r):
    return cmp.by_size(r, ["v_call", "j_call"], 10)


@query("SRT5_by_expression", "SELECT v_call AS name, count(*) AS n FROM r GROUP BY 1", rows=True)
def expressed(spark, r):
    return cmp.by_expression(r.groupBy(F.col("v_call").alias("name")).agg(F.count("*").alias("n")), "n")


@query("SRT7_preferential", rows=True)
def preferential(spark, r):
    return cl.sample(r.select("v_call", "sequence_id", "copies"), ["v_call"], "sequence_id", 20, F.col("copies") >= 5)


@query("SET1_union", rows=True)
def union(spark, r):
    a, b = ((t.withColumn("_row", F.col("name"))) for t in databases(r))
    return cmp.union(a, b).select("name", "sequence")


@query("SET4_concatenated", "SELECT DISTINCT v_call, V_nt FROM r WHERE V_errors < 2", rows=True)
def concatenated(spark, r):
    own = r.select("v_call", "V_nt", "V_errors").distinct()
    return cmp.all_candidates(own.where("V_errors = 0"), own.where("V_errors = 1")).select("v_call", "V_nt").distinct()


@query("SET5_latest", "SELECT V_nt, max(sequence_id) AS sequence_id FROM r GROUP BY 1", rows=True)
def latest(spark, r):
    return cmp.latest(r.select("V_nt", "sequence_id", F.col("sequence_id").alias("o")), "V_nt", "o").select("V_nt", "sequence_id")


@query("SIM4_components", "RECURSIVE , l AS (SELECT DISTINCT v_call AS a, d_call AS b FROM r WHERE V_errors = 1 AND d_call <> '' AND v_call < 'IGHV3'), e AS (SELECT a, b FROM l UNION SELECT b, a FROM l), t(a, b) AS (SELECT a, a FROM e UNION SELECT t.a, e.b FROM t JOIN e ON t.b = e.a) SELECT a AS node, min(b) AS component FROM t GROUP BY 1", rows=True)
def components(spark, r):
    links = r.where("V_errors = 1 AND d_call <> '' AND v_call < 'IGHV3'").select(F.col("v_call").alias("a"), F.col("d_call").alias("b")).distinct()
    return cl.components(links.select(F.col("a").alias("node")).unionByName(links.select(F.col("b").alias("node"))), links)


WORDS = "concat(substring(cdr3, 1, l_.k), 'A', substring(cdr3, l_.k + 2))"
NEAR = ", l_ AS (SELECT unnest([0, 3, 6]) AS k), s AS (SELECT DISTINCT v_call, " + WORDS + " AS c FROM r, l_ WHERE cdr3 <> '' AND V_errors = 0)"


def words(r):
    k = F.explode(F.array(F.lit(0), F.lit(3), F.lit(6))).alias("k")
    return r.where("cdr3 <> '' AND V_errors = 0").select("v_call", "cdr3", k).select("v_call", F.concat(F.left("cdr3", F.col("k")), F.lit("A"), F.substring("cdr3", F.col("k") + 2, F.length("cdr3"))).alias("c")).distinct()


@query("SIM7_within_two", NEAR + " SELECT x.v_call, x.c AS a, y.c AS b FROM s x JOIN s y ON x.v_call = y.v_call AND length(x.c) = length(y.c) AND x.c < y.c WHERE hamming(x.c, y.c) <= 2", rows=True)
def within_two(spark, r):
    return cl.near_pairs(words(r), ["v_call"], "c", 2)


@query("SIM5_single_linkage", "RECURSIVE " + NEAR + ", l AS (SELECT x.v_call, x.c AS a, y.c AS b FROM s x JOIN s y ON x.v_call = y.v_call AND x.c <> y.c WHERE levenshtein(x.c, y.c) <= 2), t(v_call, a, b) AS (SELECT v_call, c, c FROM s UNION SELECT t.v_call, t.a, l.b FROM t JOIN l ON t.v_call = l.v_call AND t.b = l.a) SELECT v_call, a AS c, min(b) AS root FROM t GROUP BY 1, 2", rows=True)
def single_linkage(spark, r):
    return cl.single_linkage(words(r), ["v_call"], "c", lambda a, b: F.levenshtein(a, b) <= 2)


@query("SIM9_clonotype_counts", "RECURSIVE , s AS (SELECT DISTINCT v_call, j_call, cdr3 AS c FROM r WHERE cdr3 <> ''), l AS (SELECT x.v_call, x.j_call, x.c AS a, y.c AS b FROM s x JOIN s y ON x.v_call = y.v_call AND x.j_call = y.j_call AND x.c <> y.c WHERE levenshtein(x.c, y.c) <= 6), t(v_call, j_call, a, b) AS (SELECT v_call, j_call, c, c FROM s UNION SELECT t.v_call, t.j_call, t.a, l.b FROM t JOIN l ON t.v_call = l.v_call AND t.j_call = l.j_call AND t.b = l.a), k AS (SELECT v_call, j_call, a, min(b) AS root FROM t GROUP BY ALL) SELECT v_call, count(*) AS clonotypes FROM (SELECT DISTINCT v_call, j_call, root FROM k) GROUP BY 1", rows=True)
def clonotype_counts(spark, r):
    return cl.clonotype_counts(r, ["v_call"])


SAMPLED = ", s AS (SELECT DISTINCT v_call, V_nt FROM r WHERE V_errors < 4)"


@query("SIM10_distances", SAMPLED + " SELECT x.v_call, x.V_nt AS a, y.V_nt AS b, least(levenshtein(x.V_nt, y.V_nt), 7)::INT AS distance FROM s x JOIN s y ON x.v_call = y.v_call AND x.V_nt < y.V_nt", rows=True)
def distances(spark, r):
    own = r.where("V_errors < 4").select("v_call", "V_nt").distinct()
    return cl.distances(own.withColumn("s", F.col("V_nt")), ["v_call"], "V_nt", "s").select("v_call", "a", "b", F.col("distance").cast("int").alias("distance"))


@query("SIM11_clusters", rows=True)
def clusters(spark, r):
    own = cl.sample(r.select("v_call", "sequence_id", "V_nt"), ["v_call"], "sequence_id", 60)
    return cl.clustered(own, ["v_call"], "sequence_id", "V_nt", 5)


@query("SIM12_dendrogram", rows=True)
def dendrogram(spark, r):
    own = r.where("V_errors = 0").select(F.substring_index("v_call", "-", 1).alias("family"), "v_call", "V_nt").groupBy("family", "v_call").agg(F.min("V_nt").alias("V_nt"))
    return cl.dendrogram(own, ["family"], "v_call", "V_nt")


def discovery_rows(spark, a):
    own = aug.augmented(a, germline(spark, "v"), germline(spark, "d"), germline(spark, "j"))
    own = own.withColumns({c: tb.computed(c) for c in ("V_nt", "VDJ_nt", "J_nt", "D_region")})
    return own.withColumns({"d_support": F.lit(0.0), "V_SHM": F.coalesce("V_SHM", F.lit(0.0))})


def reference_v(spark):
    return germline(spark, "v").select("gene", "sequence")


@query("DIS1_window_members", ", w AS (SELECT s.s::DOUBLE AS x, s.s + 2.0 AS y, s.s || '-' || (s.s + 2) AS sibling FROM range(0, 20, 2) s(s) UNION ALL SELECT 0, 100, 'all') SELECT v_call AS gene, sibling, count(*) AS n FROM r JOIN w ON V_SHM >= x AND V_SHM < y GROUP BY 1, 2 HAVING count(*) >= 5", rows=True)
def window_members(spark, r):
    return dis.window_members(r.withColumns({"locus": F.lit("IGH"), "V_CDR3_start": F.lit(0)}), dis.windows()).groupBy("gene", "sibling").agg(F.count("*").alias("n"))


@query("DIS3_exact_members", "SELECT v_call AS gene, V_nt, count(*) AS n FROM r GROUP BY 1, 2 HAVING count(*) >= 8", rows=True)
def exact_members(spark, r):
    return dis.exact_members(r.withColumns({"locus": F.lit("IGH"), "V_CDR3_start": F.lit(0)}), 8).groupBy("gene", "V_nt").agg(F.count("*").alias("n"))


@query("DIS4_database_members", "SELECT v_call AS gene, count(*) AS n FROM r WHERE V_errors = 0 AND v_call LIKE '%*01' GROUP BY 1 HAVING count(*) >= 10", rows=True)
def database_members(spark, r):
    known = r.where("v_call LIKE '%*01'").select(F.col("v_call").alias("gene")).distinct()
    return dis.database_members(r.withColumns({"locus": F.lit("IGH"), "V_CDR3_start": F.lit(0)}), known).groupBy("gene").agg(F.count("*").alias("n"))


@query("DIS2_cluster_members")
def cluster_members(spark, a):
    return dis.cluster_members(discovery_rows(spark, a).where("v_call LIKE 'IGHV1%'"), most=100).select("gene", "sibling", "sequence_id")


@query("DIS6_discover")
def discover(spark, a):
    return dis.discover(discovery_rows(spark, a), reference_v(spark), cluster=False, cluster_exact=20, ignore_j=True)


@query("DIS7_discover_j")
def discover_j(spark, a):
    rows = discovery_rows(spark, a)
    return dis.discover_simple(rows, "J", "J_nt", ["np2", "J_nt"], germline(spark, "j").selectExpr("gene AS name", "substring(sequence, 4, 20) AS sequence", "gene AS _row"))


@query("DIS7_discover_d")
def discover_d(spark, a):
    rows = discovery_rows(spark, a)
    return dis.discover_simple(rows, "D", "D_region", ["np1", "D_region", "np2"], germline(spark, "d").selectExpr("gene AS name", "sequence", "gene AS _row"), core_slice=(2, -2))


@query("DIS8_d_core", "SELECT DISTINCT d_sequence_alignment AS d, d_sequence_alignment[3:greatest(length(d_sequence_alignment) - 2, 0)] AS core FROM a")
def d_core(spark, a):
    return a.select(F.col("d_sequence_alignment").alias("d"), dis.core(F.col("d_sequence_alignment"), 2, -2).alias("core")).distinct()


@query("DIS9_known_extension")
def extension(spark, a):
    own = a.where("d_sequence_alignment <> ''").select(F.substring("d_sequence_alignment", 2, 8).alias("sequence")).distinct()
    return dis.known_extension(own, germline(spark, "d").selectExpr("gene AS name", "sequence", "gene AS _row"), "D").select("sequence", "held_by", "missing")


@query("DIS10_upstream")
def upstream(spark, a):
    rows = a.select(aug.clean_call(F.col("v_call")).alias("v_call"), "sequence_id", F.coalesce(100 - F.col("v_identity"), F.lit(0)).alias("V_SHM"), F.concat("np1", F.left("sequence", F.lit(4))).alias("UTR"))
    return dis.upstream(rows, "UTR")


@query("HAP3_cooccurrences", rows=True)
def cooccurrences(spark, r):
    j = hap.heterozygous([tuple(x) for x in hap.usage(r, "J").select("gene", "count").collect()])[0]
    return hap.cooccurrences(r, "J", j, "V", hap.usage(r, "V"))


@query("HAP4_haplotypes", rows=True)
def haplotypes(spark, r):
    return hap.haplotypes(r)


@query("GER8_germline_filter")
def germline_filter(spark, a):
    found = dis.discover(discovery_rows(spark, a), reference_v(spark), cluster=False, cluster_exact=20, ignore_j=True)
    _, kept = db.germline_filter([found.checkpoint()], germline(spark, "v").selectExpr("gene AS name", "sequence"), fl.candidate_marks(cdr3s=1))
    return kept.select("name", "source", "cluster_size", "whitelist_diff", "closest_whitelist", "chimera", "consensus")
