"""An aligner's table and a germline database derived from the star schema, as text that Spark and DuckDB share."""

from __future__ import annotations

import hashlib
from functools import reduce
from itertools import product

from pyspark.sql import DataFrame, SparkSession


def bases(*parts: str) -> str:
    return f"translate(md5(concat({', '.join(parts)})), '0123456789abcdef', 'ACGTACGTACGTACGT')"


#: Steps of name -> expression; each may use the columns of the steps before.
STEPS = [
    {
        "v_no": "l_partkey % 7", "v_sub": "l_suppkey % 5", "j_no": "l_orderkey % 6", "d_no": "l_partkey % 6", "q": "cast(l_quantity as int)",
        "key": "concat('r', l_orderkey, '_', l_linenumber, '_', l_partkey, '_', l_suppkey, '_', cast(floor(l_extendedprice * 100 + 0.5) as bigint))",
        "locus": "case when l_linenumber = 7 then 'XYZ' else 'IGH' end",
    },
    {
        "gv": f"concat(substring({bases("'V'", 'v_no', 'v_sub')}, 1, 32), substring({bases("'W'", 'v_no', 'v_sub')}, 1, 13), 'TATTACTGTGCGAGA')",
        "gd": f"substring({bases("'D'", 'd_no')}, 1, 18)",
        "gj": f"concat(substring({bases("'J'", 'j_no')}, 1, 11), 'TGGGGCCAAGGGACC')",
        "np1": f"substring({bases("'N'", 'l_orderkey % 40')}, 1, 6)", "np2": f"substring({bases("'M'", 'l_orderkey % 30')}, 1, cast(3 + l_orderkey % 4 as int))",
        "cut": "cast(case when l_orderkey % 9 = 0 then 48 else 60 end as int)", "v_germline_start": "cast(1 + l_orderkey % 3 as int)",
    },
    {
        "v_germline_alignment": "concat(substring(gv, v_germline_start, 21 - v_germline_start), case when q % 4 = 0 then '-' else '' end, substring(gv, 21, cut - 20))",
        "v_sequence_alignment": "concat(substring(gv, v_germline_start, 10 - v_germline_start), case when q % 5 > 2 then 'A' else substring(gv, 10, 1) end, substring(gv, 11, 10), case when q % 4 = 0 then 'G' else '' end, substring(gv, 21, 9), case when q % 3 = 0 then '-' else substring(gv, 30, 1) end, substring(gv, 31, cut - 30))",
        "d_germline_alignment": "case when l_partkey % 11 = 0 then '' else substring(gd, 3, 12) end",
        "d_sequence_alignment": "case when l_partkey % 11 = 0 then '' when q % 4 = 1 then concat('T', substring(gd, 4, 11)) else substring(gd, 3, 12) end",
        "j_germline_alignment": "substring(gj, 4, 20)",
        "j_sequence_alignment": "concat(substring(gj, 4, 18), case when q % 6 = 1 then 'C' else substring(gj, 22, 1) end, substring(gj, 23, 1))",
    },
    {
        "tail": "case when cut < 60 then substring(gv, cut + 1, 60 - cut) else '' end", "v_part": "replace(v_sequence_alignment, '-', '')",
        "d_part": "replace(d_sequence_alignment, '-', '')", "j_part": "replace(j_sequence_alignment, '-', '')",
    },
    {"sequence": "concat('ACGT', v_part, tail, np1, d_part, np2, j_part, 'GGCC')"},
    {
        "sequence_id": "concat(key, ';size=', 1 + q % 7, ';barcode=', substring(np1, 1, 4), ';')",
        "v_call": "concat('%IGHV', 1 + v_no, '-', 1 + v_sub, '*01')", "d_call": "case when l_partkey % 11 = 0 then '' else concat('%IGHD', 1 + d_no, '*01') end",
        "j_call": "concat('%IGHJ', 1 + j_no, '*01')",
        "v_sequence_start": "5", "v_sequence_end": "cast(4 + length(v_part) as int)", "v_germline_end": "cut",
        "j_sequence_start": "cast(5 + length(sequence) - 4 - 4 - length(j_part) as int)", "j_sequence_end": "cast(length(sequence) - 4 as int)",
        "j_germline_start": "4", "j_germline_end": "23",
        "v_identity": "case when q % 10 = 0 then null else 100 - l_discount * 150 end", "j_identity": "cast(90 + q % 10 as double)",
        "cdr3": "''", "cdr3_aa": "''", "cdr3_start": "cast(null as int)", "cdr3_end": "cast(null as int)",
        **{f"{r}_start": f"cast(case when q % 8 = 0 then null else {4 + a} - v_germline_start + 1 end as int)" for r, a in (("fwr1", 4), ("cdr1", 13), ("fwr2", 22), ("cdr2", 31), ("fwr3", 37))},
        **{f"{r}_end": f"cast(case when q % 8 = 0 then null else {4 + b} - v_germline_start + 1 end as int)" for r, b in (("fwr1", 12), ("cdr1", 21), ("fwr2", 30), ("cdr2", 36), ("fwr3", 45))},
    },
]
COLUMNS = [
    "sequence_id", "sequence", "locus", "v_call", "d_call", "j_call", "np1", "np2", *(f"{g}_{s}_alignment" for g in "vdj" for s in ("germline", "sequence")),
    "v_germline_start", *(c for c in STEPS[-1] if c not in ("sequence_id", "v_call", "d_call", "j_call")),
]
A = (
    "a0 AS (SELECT * FROM lineitem), " + ", ".join(f"a{k} AS (SELECT *, {', '.join(f'{e} AS {n}' for n, e in step.items())} FROM a{k - 1})" for k, step in enumerate(STEPS, 1))
    + f", a AS (SELECT {', '.join(COLUMNS)} FROM a{len(STEPS)})"
)


#: The arguments of bases() above and how many values each has, from 0.
FEW = [("V", {"v_no": 7, "v_sub": 5}), ("W", {"v_no": 7, "v_sub": 5}), ("D", {"d_no": 6}), ("J", {"j_no": 6}), ("N", {"l_orderkey % 40": 40}), ("M", {"l_orderkey % 30": 30})]


def looked_up(e: str) -> str:
    """e with bases() of few arguments as a look-up, as translate takes longer than all else; other values are still computed."""
    for letter, parts in FEW:
        whole = bases(f"'{letter}'", *parts)
        texts = (hashlib.md5((letter + "".join(map(str, x))).encode()).hexdigest() for x in product(*(range(n) for n in parts.values())))
        known = ", ".join(f"'{''.join('ACGT'[int(c, 16) % 4] for c in x)}'" for x in texts)
        at = reduce(lambda a, b: f"({a}) * {b[1]} + {b[0]}", parts.items(), "0")
        e = e.replace(whole, f"case when {' and '.join(f'{c} >= 0' for c in parts)} then get(array({known}), cast({at} as int)) else {whole} end")
    return e


def assigned(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    return reduce(lambda d, step: d.selectExpr("*", *(f"{looked_up(e)} AS {n}" for n, e in step.items())), STEPS, df).select(COLUMNS)


def germline(spark: SparkSession, kind: str) -> DataFrame:
    """The database (gene, sequence) that the rows above are made of, V with the places of its regions."""
    if kind == "v":
        base = spark.range(35).selectExpr("id % 7 AS v_no", "id div 7 AS v_sub")
        places = (("fwr1", 4, 12), ("cdr1", 13, 21), ("fwr2", 22, 30), ("cdr2", 31, 36), ("fwr3", 37, 45))
        return base.selectExpr("concat('IGHV', 1 + v_no, '-', 1 + v_sub, '*01') AS gene", f"{STEPS[1]['gv']} AS sequence", *(f"{a} AS {r}_start" for r, a, _ in places), *(f"{b} AS {r}_end" for r, _, b in places))
    base = spark.range(6).withColumnRenamed("id", f"{kind}_no")
    return base.selectExpr(f"concat('IGH{kind.upper()}', 1 + {kind}_no, '*01') AS gene", f"{STEPS[1]['g' + kind]} AS sequence")
