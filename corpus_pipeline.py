"""The corpus pipeline: quality, near duplicates, repeated passages, mixture, tokens. Part of lymphora.llm."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lymphora.llm import bpe, jaccard, mixing, quality, suffixes
from lymphora.llm.common import cut, lean, small_batches, table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: Bytes of a passage that goes if it starts elsewhere too. Fifty words of prose are 250 bytes and more.
PASSAGE = 200
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def documents(docs: DataFrame) -> DataFrame:
    small_batches(docs.sparkSession)
    return docs.select("doc_id", "text", "lang", "source", F.col("n_chars").cast("long"))


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier predicts as 1. A row is judged by its doc_id's text; rows with a
    null doc_id, or of one doc_id that is rejected, go as their scores say."""
    docs = documents(docs)
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    sent = spark.sparkContext.broadcast(model)  # under 2 MB, see quality.score

    @lean
    def run(parts):
        for pdf in parts:
            yield pdf[sent.value.score(quality.features(list(pdf["text"]))).round(6) >= quality.REJECT]

    return docs.mapInPandas(run, docs.schema)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the least doc_id of each group of near duplicates; of repeated rows, one, and of different
    texts of one doc_id, those that are no near duplicates. Rows without a doc_id stay."""
    docs = documents(docs)
    known = docs.where("doc_id IS NOT NULL").withColumn("k2", F.xxhash64("text"))
    # a doc_id's first text goes by the doc_id; others by a hash, as components takes rows of one doc_id as one
    own = known.select("doc_id", "k2").distinct().withColumn("n", F.row_number().over(Window.partitionBy("doc_id").orderBy("k2")))
    own = cut(own.withColumn("row", F.when(F.col("n") == 1, F.col("doc_id")).otherwise(F.xxhash64("doc_id", "k2", "n"))), "rows")
    more = own.where("n > 1").select("doc_id", "k2", "row")
    if more.limit(1).count():
        rows = cut(known.dropDuplicates(["doc_id", "k2"]).join(own.select("doc_id", "k2", "row"), ["doc_id", "k2"]), "texts")
        groups = jaccard.components(rows.select(F.col("row").alias("doc_id"), "text")).select(F.col("doc_id").alias("row"), "component_id")
        best = groups.join(own, "row").groupBy("component_id").agg(F.min_by("row", F.struct("doc_id", "n")).alias("row"))
        kept = rows.join(best.select("row"), "row", "left_semi")
    else:
        roots = jaccard.components(known).where("doc_id = component_id").select("doc_id").distinct()
        kept = known.join(roots, "doc_id", "left_semi").dropDuplicates(["doc_id"])
    return kept.select(*COLUMNS).unionByName(docs.where("doc_id IS NULL"))


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document without the bytes of strings of PASSAGE bytes that start elsewhere too. A character that a cut
    leaves in part goes as a whole; a document of which nothing is left stays, with an empty text."""
    docs = documents(docs)

    @lean
    def run(parts):
        for pdf in parts:
            text = []
            for t, a, b in zip(pdf["text"], pdf["firsts"], pdf["ends"]):
                if a is None:
                    text.append(t)
                else:
                    raw = t.encode("utf-8", "surrogatepass")
                    text.append(suffixes.kept(raw, suffixes.united(a.tolist(), b.tolist())).decode("utf-8", "ignore"))
            yield pdf.assign(text=text, n_chars=[None if t is None else len(t) for t in text])[COLUMNS]

    some, rest = suffixes.removals(docs, "lang", "source", "n_chars", length=PASSAGE)
    return some.select(*COLUMNS, "firsts", "ends").mapInPandas(run, SCHEMA).unionByName(rest.select(COLUMNS))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mixture by source: a row for each row of docs and round (at most 3) in which words of it are taken,
    with those words. What is between two words of one run stays; between runs there is a newline."""
    docs = documents(docs)
    taken = mixing.mix_documents(docs)
    rounds = taken.select(*mixing.KEY, "first", "words", F.explode(F.sequence(F.lit(1).cast("long"), F.col("times"))).alias("round"))
    rounds = rounds.groupBy(*mixing.KEY, "round").agg(F.array_sort(F.collect_list(F.struct("first", "words"))).alias("runs"))

    @lean
    def run(parts):
        for pdf in parts:
            text = [mixing.words_of(t, [(r["first"], r["words"]) for r in runs]) for t, runs in zip(pdf["text"], pdf["runs"])]
            yield pdf.assign(text=text, n_chars=[len(t) for t in text])[COLUMNS]

    return mixing.numbered(docs).join(rounds.hint("merge"), mixing.KEY).select(*COLUMNS, "runs").mapInPandas(run, SCHEMA)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every row, and the digest of what they decode to."""
    return bpe.digest_documents(documents(docs))


STAGES = [("quality", keep_quality), ("near_duplicates", one_of_each_group), ("repeats", without_repeats), ("mixture", mixed), ("tokens", encoded)]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = cut(docs, name)
    return docs
