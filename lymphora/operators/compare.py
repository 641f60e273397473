"""Comparison of sequence databases and candidate tables (JOI8, JOI9, JOI14, JOI16, FN14, FN15, SET1, SET4, SET5, AGG15, AGG16, AGG19, SRT3-SRT5)."""

from __future__ import annotations

from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.sequence import hamming
from .consensus import folded, prefixes
from .database import starting_with


def prefix_matches(queries: DataFrame, known: DataFrame) -> DataFrame:
    """(q, name, value) of queries (q) and rows (name, sequence) where either begins with the other. Both ways are equi-joins
    on prefixes."""
    own = queries.select("q").distinct()
    down = starting_with(own, "q", known.select("name", F.col("sequence").alias("k")), "k").select("q", "name", F.col("k").alias("sequence"))
    up = starting_with(known.select("name", "sequence"), "sequence", own.select(F.col("q").alias("k")), "k").select(F.col("k").alias("q"), "name", "sequence")
    return down.unionByName(up).distinct()


def prefix_lookup(queries: DataFrame, known: DataFrame) -> DataFrame:
    """JOI8: (q, name): the one known row that is a prefix of q or that q is a prefix of; null if there are none or several."""
    found = prefix_matches(queries, known).groupBy("q").agg(F.count("*").alias("n"), F.min("name").alias("name"))
    return queries.select("q").distinct().join(found.where("n = 1").select("q", "name"), "q", "left")


def is_new(candidates: DataFrame, known: DataFrame, c: str = "sequence") -> DataFrame:
    """JOI9: candidates with the column new: no known sequence is a prefix of theirs, or the other way round."""
    hit = prefix_matches(candidates.select(F.col(c).alias("q")), known).select(F.col("q").alias(c), F.lit(False).alias("new")).distinct()
    return candidates.join(hit, c, "left").withColumn("new", F.coalesce("new", F.lit(True)))


def repeated_names(records: DataFrame) -> DataFrame:
    """FN14: names that occur more than once."""
    return records.groupBy("name").agg(F.count("*").alias("n")).where("n > 1")


def repeated_sequences(records: DataFrame) -> DataFrame:
    """FN14: (name, first): records (_row, name, sequence) whose sequence an earlier record, first, has."""
    w = Window.partitionBy("sequence").orderBy("_row")
    return records.withColumns({"first": F.first("name").over(w), "k": F.row_number().over(w)}).where("k > 1").select("name", "first")


def cost(a: Column, b: Column) -> Column:
    """Of two sequences: five for each mismatch at the better end, one for each base of their lengths' difference."""
    n = F.least(F.length(a), F.length(b))
    ends = F.least(hamming(F.left(a, n), F.left(b, n)), hamming(F.right(a, n), F.right(b, n)))
    return 5 * ends + F.abs(F.length(a) - F.length(b))


def assignment(costs: np.ndarray) -> list[tuple[int, int]]:
    """Pairs (row, column) of least total cost, min(rows, columns) of them: shortest augmenting paths with potentials
    (Jonker and Volgenant 1987)."""
    if costs.shape[0] > costs.shape[1]:
        return sorted((i, j) for j, i in assignment(costs.T))
    n, m = costs.shape
    u, v = np.zeros(n), np.zeros(m)
    owner = np.full(m, -1)
    for row in range(n):
        least, come, done = np.full(m, np.inf), np.full(m, -1), np.zeros(m, bool)
        at, j, reached = row, -1, 0.0
        while True:
            slack = reached + costs[at] - u[at] - v
            better = ~done & (slack < least)
            least[better], come[better] = slack[better], j
            free = np.where(done, np.inf, least)
            j = int(free.argmin())
            reached = float(free[j])
            done[j] = True
            if owner[j] < 0:
                break
            at = owner[j]
        inside = done.copy()
        inside[j] = False
        u[row] += reached
        for k in np.flatnonzero(inside):
            u[owner[k]] += reached - least[k]
            v[k] -= reached - least[k]
        while j >= 0:
            before = come[j]
            owner[j] = owner[before] if before >= 0 else row
            j = before
    return sorted((int(owner[j]), j) for j in range(m) if owner[j] >= 0)


def ends(left: DataFrame, right: DataFrame, most: int) -> DataFrame:
    """(a, b) that may cost most at most: with so many fifths of mismatches, one of as many pieces and one more, cut from the
    better end, is equal (pigeonhole; records have as many bases as there are pieces at least)."""
    parts = most // 5 + 1
    lengths = left.select(F.length("sa").alias("n")).unionByName(right.select(F.length("sb").alias("n")))
    size = max(1, (lengths.agg(F.min("n")).first()[0] or 0) // parts)

    def cut(df: DataFrame, name: str) -> DataFrame:
        def pieces(end: str, s: Column) -> Column:
            return F.transform(F.sequence(F.lit(0), F.lit(parts - 1)), lambda k: F.struct(F.lit(end).alias("end"), k.alias("k"), F.substring(s, k * size + 1, F.lit(size)).alias("piece")))

        return df.select(name, F.explode(F.concat(pieces("front", F.col(f"s{name}")), pieces("back", F.reverse(f"s{name}")))).alias("p")).select(name, "p.*").where("piece <> ''")

    return cut(left, "a").join(cut(right, "b"), ["end", "k", "piece"]).select("a", "b").distinct()


def paired(a: DataFrame, b: DataFrame, most: int = 20) -> DataFrame:
    """JOI14, SET2: (a, b, kind, difference): records (name, sequence) of two databases that are the same, or renamed or changed
    (a matching of least cost, none above most), or in one only. Pairs beyond most can't be matched, so only sequences that
    share an end piece are compared, and only they reach the driver."""
    x, y = (d.select(F.col("name").alias(n), F.col("sequence").alias(f"s{n}")) for d, n in ((a, "a"), (b, "b")))
    rank = lambda n: F.row_number().over(Window.partitionBy(f"s{n}").orderBy(n))
    x, y = x.withColumn("k", rank("a")), y.withColumn("k", rank("b"))
    same = x.select("a", F.col("sa").alias("s"), "k").join(y.select("b", F.col("sb").alias("s"), "k"), ["s", "k"]).select("a", "b")
    left, right = x.join(same, "a", "left_anti"), y.join(same, "b", "left_anti")
    near = left.join(ends(left, right, most), "a").join(right, "b")
    near = near.withColumn("cost", cost(F.col("sa"), F.col("sb"))).where(F.col("cost") <= most)
    rows = near.select("a", "b", "cost", F.col("sa"), F.col("sb")).collect()
    names_a, names_b = sorted({r[0] for r in rows}), sorted({r[1] for r in rows})
    costs = np.full((len(names_a), len(names_b)), 10.0**6)
    for r in rows:
        costs[names_a.index(r[0]), names_b.index(r[1])] = r[2]
    text = {(r[0], r[1]): (r[3], r[4]) for r in rows}
    found = [(names_a[i], names_b[j]) for i, j in (assignment(costs) if rows else []) if costs[i, j] <= most]
    similar = [(p, q, "similar", difference(*text[p, q])) for p, q in found]
    spark = a.sparkSession
    matched = spark.createDataFrame(similar, "a string, b string, kind string, difference string")
    none = F.lit(None).cast("string")
    only_a = left.join(matched, "a", "left_anti").select("a", none.alias("b"), F.lit("a").alias("kind"), none.alias("difference"))
    only_b = right.join(matched, "b", "left_anti").select(none.alias("a"), "b", F.lit("b").alias("kind"), none.alias("difference"))
    return same.select("a", "b", F.when(F.col("a") == F.col("b"), "same").otherwise("renamed").alias("kind"), none.alias("difference")).unionByName(matched).unionByName(only_a).unionByName(only_b)


def exit_code(pairs: DataFrame) -> int:
    """0 if two databases agree, 1 if only names differ, else 2."""
    kinds = {r[0] for r in pairs.select("kind").distinct().collect()}
    return 2 if kinds & {"a", "b", "similar"} else 1 if "renamed" in kinds else 0


def difference(a: str, b: str) -> str:
    """FN15: b against a: {A → C} for a changed base, {-ACG} and {+ACG} for an end that one lacks."""
    n = min(len(a), len(b))
    front = sum(x != y for x, y in zip(a[:n], b[:n])) <= sum(x != y for x, y in zip(a[len(a) - n :], b[len(b) - n :]))
    end = lambda s: (s[n:] if front else s[: len(s) - n])
    middle = lambda s: (s[:n] if front else s[len(s) - n :])
    extra = f"{{-{end(a)}}}" if end(a) else f"{{+{end(b)}}}" if end(b) else ""
    body = "".join(x if x == y else f"{{{x} → {y}}}" for x, y in zip(middle(a), middle(b)))
    return body + extra if front else extra + body


def union(*tables: DataFrame) -> DataFrame:
    """SET1: records (name, sequence) of all tables in order, of two that are each other's prefix the first. Records whose
    first letters differ never meet, so each task folds those of one beginning."""
    rows = reduce(DataFrame.unionByName, (t.select(F.lit(k).alias("file"), "_row", "name", F.upper("sequence").alias("sequence")) for k, t in enumerate(tables)))
    shortest = rows.agg(F.min(F.length("sequence"))).first()[0] or 1
    rows = rows.select(F.left("sequence", F.lit(min(shortest, 12))).alias("start"), F.format_string("%06d:%s", "file", F.lpad(F.col("_row").cast("string"), 20, "0")).alias("at"), "name", "sequence")
    return folded(rows, ["start"], "at", "start string, at string, name string, sequence string", prefixes).drop("start")


def all_candidates(*tables: DataFrame) -> DataFrame:
    """SET4."""
    return reduce(lambda x, y: x.unionByName(y, allowMissingColumns=True), tables)


def latest(df: DataFrame, key: str, order: str) -> DataFrame:
    """SET5: of rows with one key the last."""
    return df.groupBy(key).agg(F.max_by(F.struct(*[c for c in df.columns if c != key]), order).alias("r")).select(key, "r.*")


def common_candidates(datasets: DataFrame, least: int | None = None) -> DataFrame:
    """JOI16: consensus sequences of candidates (dataset, source, name, consensus) in at least half of the data sets, two at least:
    the first data set's source, and all names."""
    if least is None:
        n = datasets.agg(F.count_distinct("dataset")).first()[0] or 0
        least = max((n + 1) // 2, 2)
    first = F.min(F.struct("dataset", "source"))["source"]
    names = F.array_join(F.transform(F.array_sort(F.collect_set(F.struct("dataset", "name"))), lambda x: x["name"]), ";")
    return datasets.groupBy("consensus").agg(first.alias("source"), F.count_distinct("dataset").alias("datasets"), names.alias("names")).where(F.col("datasets") >= least)


def clonotype_usage(clonotypes: DataFrame, gene: str, least: int = 1) -> DataFrame:
    """AGG15: clonotypes of each V or J gene, the most frequent first."""
    return clonotypes.groupBy(F.col(f"{gene.lower()}_call").alias("gene")).agg(F.count("*").alias("count")).where(F.col("count") >= least).orderBy(F.desc("count"), "gene")


def ragged(df: DataFrame, key: str, value: str, order: str, keys: list[str] | None = None) -> DataFrame:
    """AGG16: a column of each key's values in order, with nulls behind the shorter ones; row k holds the k-th of each."""
    keys = keys or sorted(r[0] for r in df.select(key).distinct().collect())
    ranked = df.select(key, value, F.row_number().over(Window.partitionBy(key).orderBy(order)).alias("k"))
    return ranked.groupBy("k").pivot(key, keys).agg(F.first(value))


def gained_lost(before: DataFrame, after: DataFrame, c: str = "sequence") -> DataFrame:
    """AGG19: one row: size, gained, lost, between two iterations of a database."""
    x, y = (d.select(c).distinct().withColumn(n, F.lit(1)) for d, n in ((before, "x"), (after, "y")))
    both = x.join(y, c, "full_outer")
    return both.agg(F.count("y").alias("size"), F.coalesce(F.sum((F.col("x").isNull()).cast("long")), F.lit(0)).alias("gained"), F.coalesce(F.sum((F.col("y").isNull()).cast("long")), F.lit(0)).alias("lost"))


def by_size(df: DataFrame, keys: list[str], limit: int | None = None) -> DataFrame:
    """SRT3, SRT4: groups (keys, n), the largest first, ties by key; the first limit of them."""
    out = df.groupBy(*keys).agg(F.count("*").alias("n")).orderBy(F.desc("n"), *keys)
    return out if limit is None else out.limit(limit)


def by_expression(df: DataFrame, expression: str, name: str = "name") -> DataFrame:
    """SRT5: the most expressed first, ties by name."""
    return df.orderBy(F.desc(expression), name)
