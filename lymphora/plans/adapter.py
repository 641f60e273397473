"""Rearrangement, germline and candidate tables derived from the star schema, as text that Spark and DuckDB share."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

_CDR3 = "substring(translate(md5(cast(l_partkey % 50 as varchar(10))), '0123456789abcdef', 'ACGTACGTACGTACGT'), 1, cast(9 + 3 * (l_partkey % 4) as int))"
#: name -> expression over lineitem
REARRANGEMENTS = {
    "sequence_id": "concat('r', l_orderkey, '_', l_linenumber, '_', l_partkey, '_', l_suppkey, '_', cast(floor(l_extendedprice * 100 + 0.5) as bigint))",
    "v_call": "concat('IGHV', 1 + l_partkey % 7, '-', 1 + l_suppkey % 5, '*0', 1 + l_linenumber % 3)",
    "d_call": "case when l_partkey % 11 = 0 then '' else concat('IGHD', 1 + l_partkey % 6, '*0', 1 + l_suppkey % 2) end",
    "j_call": "case when l_orderkey % 13 = 0 then '' else concat('IGHJ', 1 + l_orderkey % 6, '*0', 1 + l_linenumber % 2) end",
    "stop_codon": "case when l_returnflag = 'R' then 'T' else 'F' end",
    "V_errors": "cast(l_quantity as int) % 5", "J_errors": "cast(l_quantity as int) % 3", "D_errors": "cast(l_quantity as int) % 4",
    "V_SHM": "round(l_discount * 150, 1)", "J_SHM": "cast(cast(l_quantity as int) % 3 as double)",
    "V_covered": "round(100 - l_discount * 150, 1)", "J_covered": "cast(40 + l_orderkey % 60 as double)", "D_covered": "cast(50 + l_partkey % 50 as double)",
    "v_support": "round(l_tax / 40, 4)", "d_support": "round(l_tax / 100, 5)",
    "cdr3": f"case when l_orderkey % 17 = 0 then '' else {_CDR3} end",
    "barcode": "substring(translate(md5(cast(l_orderkey % 97 as varchar(10))), '0123456789abcdef', 'ACGTACGTACGTACGT'), 1, 4)",
    "V_nt": "substring(translate(md5(concat('V', l_partkey % 7, l_suppkey % 5, cast(l_quantity as int) % 5)), '0123456789abcdef', 'ACGTACGTACGTACGT'), 1, 30)",
    "VDJ_nt": f"concat(substring(translate(md5(concat('V', l_partkey % 7, l_suppkey % 5, cast(l_quantity as int) % 5)), '0123456789abcdef', 'ACGTACGTACGTACGT'), 1, 30), {_CDR3})",
    "copies": "cast(1 + cast(l_quantity as int) % 7 as int)",
    "library": "l_linestatus",
}
R = "r AS (SELECT " + ", ".join(f"{e} AS {n}" for n, e in REARRANGEMENTS.items()) + " FROM lineitem)"
#: Candidates: a row for each allele and V sequence
CANDIDATES = """c AS (SELECT concat(v_call, '_', dense_rank() OVER (PARTITION BY v_call ORDER BY V_nt)) AS name, v_call AS source, V_nt AS consensus,
 count(*) AS cluster_size, count(DISTINCT nullif(cdr3, '')) AS CDR3s_exact, count(DISTINCT nullif(j_call, '')) AS Js_exact, count(DISTINCT nullif(d_call, '')) AS Ds_exact,
 sum(case when V_errors = 0 then 1 else 0 end) AS exact FROM r GROUP BY v_call, V_nt)"""


def rearrangements(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/lineitem.parquet").selectExpr(*(f"{e} AS {n}" for n, e in REARRANGEMENTS.items()))
