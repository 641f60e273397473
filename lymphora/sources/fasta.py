"""FASTA and FASTQ as DataFrames (SRC1, SRC13, SRC14, SNK2)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def read_fasta(spark: SparkSession, path: str) -> DataFrame:
    """(_row, name, comment, sequence). A record is one text row, so a large file is read in parallel; gz is read too."""
    raw = spark.read.option("lineSep", "\n>").text(path).withColumn("_row", F.monotonically_increasing_id())
    text = F.regexp_replace("value", "^>|\r", "")
    head = F.substring_index(text, "\n", 1)
    body = F.when(F.instr(text, "\n") > 0, F.regexp_replace(F.substring(text, F.instr(text, "\n") + 1, F.length(text)), r"\s", "")).otherwise("")
    return raw.where(F.length(F.trim("value")) > 0).select("_row", F.substring_index(head, " ", 1).alias("name"), F.regexp_extract(head, "^[^ ]* (.*)$", 1).alias("comment"), body.alias("sequence"))


def read_fastq(spark: SparkSession, path: str) -> DataFrame:
    """FASTQ of four lines a record: (_row, name, comment, sequence, qualities).

    Lines are numbered within a file from the line counts of its splits, so a large plain file is read in parallel, and
    records are cut by number: a quality line may begin with @ too.
    """
    lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), (F.col("_metadata.file_block_start")).alias("block"), F.monotonically_increasing_id().alias("at"), F.regexp_replace("value", "\r$", "").alias("line"))
    # number of lines before each split, from a count of each: a row for each split of a file
    counts = lines.groupBy("file", "block").agg(F.count("*").alias("n"), F.min("at").alias("first"))
    before = counts.withColumn("before", F.coalesce(F.sum("n").over(Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    numbered = lines.join(before.drop("n"), ["file", "block"]).withColumn("i", F.col("before") + F.col("at") - F.col("first"))
    rec = numbered.groupBy("file", F.floor(F.col("i") / 4).alias("k")).agg(*(F.max(F.when(F.col("i") % 4 == k, F.col("line"))).alias(n) for k, n in ((0, "head"), (1, "sequence"), (2, "plus"), (3, "qualities"))))
    good = rec.where("head <> ''").withColumn("head", F.when(F.startswith("head", F.lit("@")) & F.startswith("plus", F.lit("+")), F.col("head")).otherwise(F.raise_error(F.lit("not a FASTQ record of four lines")).cast("string")))
    name = F.substring("head", 2, 1 << 20)
    return good.select(F.concat_ws(":", "file", F.lpad(F.col("k").cast("string"), 12, "0")).alias("_row"), F.substring_index(name, " ", 1).alias("name"), F.regexp_extract(name, "^[^ ]* (.*)$", 1).alias("comment"), "sequence", "qualities")


def problems(records: DataFrame) -> DataFrame:
    """SRC13: (problem, what) of empty records, repeated names and repeated sequences (case-insensitive)."""
    empty = records.where("sequence = ''").select(F.lit("empty").alias("problem"), F.col("name").alias("what"))
    names = records.groupBy("name").agg(F.count("*").alias("n")).where("n > 1").select(F.lit("name"), "name")
    seqs = records.where("sequence <> ''").groupBy(F.upper("sequence").alias("s")).agg(F.count("*").alias("n"), F.min("name").alias("name")).where("n > 1").select(F.lit("sequence"), "name")
    return empty.union(names).union(seqs)


def repaired(records: DataFrame) -> DataFrame:
    """SRC14: upper case, no empty or repeated sequence; repeated names get _1, _2 and so on."""
    up = records.withColumn("sequence", F.upper("sequence")).where("sequence <> ''")
    one = up.withColumn("k", F.row_number().over(Window.partitionBy("sequence").orderBy("_row"))).where("k = 1")
    n = F.row_number().over(Window.partitionBy("name").orderBy("_row")) - 1
    return one.withColumn("n", n).select("_row", F.when(F.col("n") > 0, F.concat("name", F.lit("_"), "n")).otherwise(F.col("name")).alias("name"), "comment", "sequence")


def write_fasta(records: DataFrame, path: str) -> None:
    records.select(F.concat(F.lit(">"), "name", F.lit("\n"), "sequence").alias("value")).write.text(path)
