"""Operator 5, chat formatting: expressions of Spark only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from .common import table

#: Template: a segment opens with "### ", its role and ": "; each of its turns ends with END.
OPEN, AFTER, END = "### ", ": ", "</turn>"
#: A text holds none of these after escaping, so OPEN and END can't occur in it. "\\" comes first, and last on the way back.
CODES = (("\\", "\\b"), ("#", "\\h"), ("<", "\\l"), (":", "\\c"))


def escape(c: Column) -> Column:
    for plain, code in CODES:
        c = F.replace(c, F.lit(plain), F.lit(code))
    return c


def unescape(c: Column) -> Column:
    for plain, code in reversed(CODES):
        c = F.replace(c, F.lit(code), F.lit(plain))
    return c


def format_conversations(df: DataFrame) -> DataFrame:
    """One row per conv_id: n_turns, formatted, loss_spans (0-based start and length in code points).

    Turns are sorted by turn, then role, then text (nulls first), so ties and repeated rows have one
    order. Adjacent turns with the same role share one header. A null role or text is empty; a null
    conv_id is a conversation of its own; an empty table gives no rows. Extra columns are ignored.
    The positions are running sums over the conversation's rows; the same exchange by conv_id then
    serves the grouping.
    """
    w = Window.partitionBy("conv_id").orderBy("turn", "role_", "text_")
    rows = df.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role_"), F.coalesce("text", F.lit("")).alias("text_"))
    rows = rows.withColumns({"k": F.row_number().over(w), "new": ~F.lag("role_").over(w).eqNullSafe(F.col("role_"))})
    rows = rows.withColumn("body", escape(F.col("text_")))
    rows = rows.withColumn("head", F.when(F.col("new"), F.concat(F.lit(OPEN), escape(F.col("role_")), F.lit(AFTER))).otherwise(""))
    size = F.char_length("head") + F.char_length("body") + len(END)
    rows = rows.withColumn("upto", F.sum(size.cast("long")).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    rows = rows.withColumn("start", F.col("upto") - len(END) - F.char_length("body"))
    turns = F.array_sort(F.collect_list(F.struct("k", "new", "role_", "head", "body", "start")))
    out = rows.groupBy("conv_id").agg(F.count("*").alias("n_turns"), turns.alias("turns"))
    firsts = F.filter(F.transform("turns", lambda t: F.when(t["new"], t["k"])), lambda k: k.isNotNull())
    out = out.withColumn("firsts", firsts)
    nexts = F.concat(F.slice("firsts", F.lit(2), F.size("firsts")), F.array((F.col("n_turns") + 1).cast("int")))
    segments = F.transform(F.arrays_zip(F.col("firsts").alias("a"), nexts.alias("b")), lambda s: F.slice("turns", s["a"], s["b"] - s["a"]))
    text = F.array_join(F.transform(segments, lambda s: F.concat(F.element_at(s, 1)["head"], F.array_join(F.transform(s, lambda t: F.concat(t["body"], F.lit(END))), ""))), "")
    spans = F.transform(F.filter("turns", lambda t: t["role_"] == "assistant"), lambda t: F.struct(t["start"].alias("start"), F.char_length(t["body"]).cast("long").alias("length")))
    return out.select("conv_id", "n_turns", text.alias("formatted"), spans.alias("loss_spans"))


def read_back(formatted: Column) -> Column:
    """Array of (role, text) parsed from the formatted text, unescaped."""
    parts = F.filter(F.split(formatted, OPEN), lambda p: p != "")
    parse = lambda p: F.transform(
        F.slice(F.split(F.substring(p, F.instr(p, AFTER) + len(AFTER), F.length(p)), END), F.lit(1), F.size(F.split(p, END)) - 1),
        lambda t: F.struct(unescape(F.substring_index(p, AFTER, 1)).alias("role"), unescape(t).alias("text")),
    )
    return F.flatten(F.transform(parts, parse))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op5: all conversations plus conversation -7, and digests of what is read back."""
    kind = T.StructType([T.StructField(n, k) for n, k in (("conv_id", T.LongType()), ("turn", T.LongType()), ("role", T.StringType()), ("text", T.StringType()))])
    said = r"\### Assistant: </turn> ok"
    more = spark.range(1).select(F.explode(F.array(*(F.struct(F.lit(-7).cast("long").alias("conv_id"), F.lit(i).cast("long").alias("turn"), F.lit(r).alias("role"), F.lit(said).alias("text")) for i, r in enumerate(("user", "assistant"))))).alias("x")).select("x.*")
    rows = table(spark, sf_dir, "conversations").select(*(F.col(f.name).cast(f.dataType) for f in kind))
    out = format_conversations(rows.unionByName(more)).withColumn("back", read_back(F.col("formatted")))
    loss = F.array_join(F.transform("loss_spans", lambda s: unescape(F.substring(F.col("formatted"), (s["start"] + 1).cast("int"), s["length"].cast("int")))), "")
    turns = F.array_join(F.transform("back", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    out = out.withColumn("loss", loss)
    return out.select("conv_id", F.size("back").cast("long").alias("n_turns"), F.sha2(turns, 256).alias("turns_sha256"), F.char_length("loss").cast("long").alias("loss_chars"), F.sha2(F.col("loss"), 256).alias("loss_sha256"), F.char_length("formatted").cast("long").alias("formatted_chars"))


SQL = r"""
WITH r AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
s AS (SELECT *, coalesce(lag(role) OVER w <> role, true) AS fresh,
  length(text) + length(text) - length(replace(text, '\', '')) + length(text) - length(replace(text, '#', '')) + length(text) - length(replace(text, '<', '')) + length(text) - length(replace(text, ':', '')) + 7 AS n FROM r
  WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text))
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  sum(n + CASE WHEN fresh THEN 6 + length(role) ELSE 0 END)::BIGINT AS formatted_chars
FROM s GROUP BY conv_id
"""
