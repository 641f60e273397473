"""Linkage of sequences: single linkage, components, distances, average-linkage trees (SIM4-SIM7, SIM9-SIM12)."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.sequence import edit_distance, hamming


def components(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """SIM4: (node, component) for rows (node) and links (a, b): the least node that links reach.

    Large-star and small-star steps (Kiveris et al. 2014) in turn until the links stay the same: a number of rounds that
    grows with the logarithm of the longest chain. Only minima and joins touch a node's links.
    """
    e = links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct().checkpoint()
    mark = None
    while True:
        both = e.unionByName(e.selectExpr("v AS u", "u AS v"))
        least = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
        large = both.where("v > u").join(least, "u").selectExpr("v AS u", "m AS v").where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").selectExpr("v AS u", "m AS v").unionByName(low.selectExpr("u", "m AS v"))
        e = small.where("u <> v").distinct().checkpoint()
        now = tuple(e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if now == mark or not now[0]:
            break
        mark = now
    roots = e.groupBy("u").agg(F.min("v").alias("component")).withColumnRenamed("u", "node")
    return nodes.select("node").distinct().join(roots, "node", "left").select("node", F.coalesce("component", "node").alias("component"))


def near_pairs(df: DataFrame, keys: list[str], c: str, mismatches: float, core_start: int = 0) -> DataFrame:
    """SIM6, SIM7: pairs (keys, a, b), a < b, of distinct values of c of equal lengths within so many mismatches, or within that
    share of the length behind core_start if mismatches is under 1.

    Of one more pieces than mismatches of two such values one is equal (pigeonhole), so they are joined on a piece and its
    place; the distance is tested on what meets.
    """
    own = df.select(*keys, F.col(c).alias("x")).distinct().where(F.length("x") > 0)
    most = F.lit(int(mismatches)) if mismatches >= 1 or mismatches == 0 else F.greatest(F.floor((F.length("x") - core_start) * mismatches), F.lit(0))
    parts = F.least(most.cast("int") + 1, F.length("x"))
    edge = lambda k: F.floor(F.length("x") * k / parts).cast("int")
    # where mismatches may be everywhere, all values of a length meet
    all_ = F.when(most >= F.length("x"), F.array(F.struct(F.lit(-1).alias("k__"), F.length("x").alias("n__"), F.lit("").alias("piece__"))))
    pieces = F.transform(F.sequence(F.lit(0), parts - 1), lambda k: F.struct(k.alias("k__"), F.length("x").alias("n__"), F.substring(F.col("x"), edge(k) + 1, edge(k + 1) - edge(k)).alias("piece__")))
    cut = own.select(*keys, "x", most.cast("int").alias("most__"), F.explode(F.coalesce(all_, pieces)).alias("p")).select(*keys, "x", "most__", "p.*")
    met = cut.withColumnRenamed("x", "a").join(cut.drop("most__").withColumnRenamed("x", "b"), [*keys, "k__", "n__", "piece__"]).where("a < b")
    return met.where(hamming(F.col("a"), F.col("b")) <= F.col("most__")).select(*keys, "a", "b").distinct()


def single_linkage(df: DataFrame, keys: list[str], c: str, linked) -> DataFrame:
    """SIM5: (keys, c, root) of distinct values under keys, linked by a predicate of two Columns. All pairs under a key are
    tested, as the predicate may be anything; give keys that part the rows well, or use near_pairs."""
    own = df.select(*keys, c).distinct()
    pairs = own.select(*keys, F.col(c).alias("a")).join(own.select(*keys, F.col(c).alias("b")), keys).where("a < b")
    return rooted(own, keys, c, pairs.where(linked(F.col("a"), F.col("b"))))


def rooted(own: DataFrame, keys: list[str], c: str, pairs: DataFrame) -> DataFrame:
    """(keys, c, root): root is the least value of c that pairs (keys, a, b) reach."""
    node = lambda x: F.to_json(F.struct(F.array(*(F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys)).alias("k"), F.col(x).alias("v")))
    nodes = own.withColumn("node", node(c))
    found = components(nodes, pairs.select(node("a").alias("a"), node("b").alias("b")))
    # components are named by their least node, whose value is least too, as the keys in front are equal
    return nodes.join(found, "node").select(*keys, c, F.get_json_object("component", "$.v").alias("root"))


def clonotype_counts(df: DataFrame, keys: list[str], distance: int = 6) -> DataFrame:
    """SIM9: (keys, clonotypes): components of distinct CDR3s within an edit distance, counted under each J and summed.

    Values within an edit distance of d that are cut into d + 1 pieces share one at places that differ by d at most, so
    they are joined on pieces; values too short for that meet by their lengths.
    """
    own = df.where("cdr3 <> ''").select(*keys, "j_call", "cdr3").distinct()
    size = (distance + 1) * 2  # shorter values have pieces of one letter or none
    short = own.where(F.length("cdr3") < size + distance)
    parts = distance + 1
    edge = lambda k: F.floor(F.length("cdr3") * k / parts).cast("int")
    cuts = F.transform(F.sequence(F.lit(0), F.lit(parts - 1)), lambda k: F.substring(F.col("cdr3"), edge(k) + 1, edge(k + 1) - edge(k)))
    lengths = F.floor(F.length("cdr3") / parts).cast("int")
    # all substrings of the other value that a piece can be, by length
    grams = F.flatten(F.transform(F.sequence(F.lit(-distance), F.lit(distance)), lambda d: F.flatten(F.transform(F.array(F.lit(0), F.lit(1)), lambda extra: _grams(F.col("cdr3"), F.floor((F.length("cdr3") + d) / parts).cast("int") + extra)))))
    by = [*keys, "j_call"]
    left = own.select(*by, F.col("cdr3").alias("a"), F.explode(F.array_distinct(cuts)).alias("piece")).where("piece <> ''")
    right = own.select(*by, F.col("cdr3").alias("b"), F.explode(F.array_distinct(grams)).alias("piece")).where("piece <> ''")
    met = left.join(right, [*by, "piece"]).select(*by, "a", "b").distinct()
    few = short.select(*by, F.col("cdr3").alias("a")).join(own.select(*by, F.col("cdr3").alias("b")), by).where(F.abs(F.length("a") - F.length("b")) <= distance)
    pairs = met.unionByName(few).where(F.col("a") != F.col("b")).select(*by, F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    roots = rooted(own, by, "cdr3", pairs.where(edit_distance(F.col("a"), F.col("b"), distance) <= distance))
    return roots.select(*by, "root").distinct().groupBy(*keys).agg(F.count("*").alias("clonotypes"))


def _grams(c: Column, n: Column) -> Column:
    """All substrings of length n, none for n < 1 or beyond the length."""
    return F.when((n >= 1) & (n <= F.length(c)), F.transform(F.sequence(F.lit(1), F.length(c) - n + 1), lambda i: F.substring(c, i, n))).otherwise(F.array().cast("array<string>"))


def sample(df: DataFrame, keys: list[str], row: str, n: int, first: Column | None = None, seed: int = 1) -> DataFrame:
    """SRT6, SRT7: at most n rows of each key by a seeded hash of row, those where first holds before others; k is the place."""
    order = [F.xxhash64(F.lit(seed), *keys, row), F.col(row)]
    w = Window.partitionBy(*keys).orderBy(*([F.coalesce(first, F.lit(False)).cast("int").desc()] if first is not None else []), *order)
    return df.withColumn("k", F.row_number().over(w)).where(F.col("k") <= n)


def distances(df: DataFrame, keys: list[str], row: str, c: str, band: float = 0.2) -> DataFrame:
    """SIM10: (keys, a, b, distance) of all pairs of rows of a key, a < b by row, capped at one more than the band of the longest
    value. For samples of bounded size: rows grow with their square. Equal values are measured once."""
    own = df.select(*keys, F.col(row).alias("r"), F.col(c).alias("s")).withColumn("most", F.max(F.floor(F.length("s") * band)).over(Window.partitionBy(*keys)).cast("int"))
    kinds = own.select(*keys, "s", "most").distinct()
    pairs = kinds.withColumnRenamed("s", "x").join(kinds.select(*keys, F.col("s").alias("y")), keys).where("x < y")
    d = F.levenshtein("x", "y")
    known = pairs.select(*keys, "x", "y", F.least(d, F.col("most") + 1).alias("distance"))
    a, b = (own.select(*keys, F.col("r").alias(n), F.col("s").alias(f"s_{n}")) for n in "ab")
    both = a.join(b, keys).where("a < b").withColumns({"x": F.least("s_a", "s_b"), "y": F.greatest("s_a", "s_b")})
    return both.join(known, [*keys, "x", "y"], "left").select(*keys, "a", "b", F.coalesce("distance", F.lit(0)).alias("distance"))


def linkage(matrix: np.ndarray, method: str = "average") -> np.ndarray:
    """SIM12: rows (left, right, distance, size) of an agglomerative clustering: single, complete, average or weighted.
    Leaves are numbered first, then merged clusters in order."""
    n = len(matrix)
    d = matrix.astype(float).copy()
    np.fill_diagonal(d, np.inf)
    name, size, out = list(range(n)), [1] * n, []
    alive = np.ones(n, bool)
    for step in range(n - 1):
        i, j = divmod(int(d.argmin()), n)
        i, j = min(i, j), max(i, j)
        left, right = sorted((name[i], name[j]))
        out.append((left, right, d[i, j], size[i] + size[j]))
        if method == "single":
            new = np.minimum(d[i], d[j])
        elif method == "complete":
            new = np.maximum(d[i], d[j])
        elif method == "weighted":
            new = (d[i] + d[j]) / 2
        else:
            new = (size[i] * d[i] + size[j] * d[j]) / (size[i] + size[j])
        alive[j] = False
        new[~alive] = np.inf
        new[i] = np.inf
        d[i], d[:, i] = new, new
        d[j], d[:, j] = np.inf, np.inf
        name[i], size[i] = n + step, size[i] + size[j]
    return np.array(out, float).reshape(-1, 4)


def tree_clusters(link: np.ndarray, n: int, least: int = 5, ratio: float = 0.8) -> list[int]:
    """SIM11: cluster numbers of n leaves; 0 is the rest. Inner nodes are visited from left to right; one whose distance
    is well above the last visited one's, with large enough sides, gives its left leaves a number of their own."""
    if n < 2:
        return [0] * n
    numbers, number, before = [0] * n, 1, link[:, 2].max()
    leaves = lambda k: [k] if k < n else leaves(int(link[k - n, 0])) + leaves(int(link[k - n, 1]))
    count = lambda k: 1 if k < n else int(link[k - n, 3])
    todo: list[tuple[int, bool]] = [(n + len(link) - 1, False)]
    while todo:
        node, seen = todo.pop()
        if node < n:
            continue
        left, right, dist, _ = link[node - n]
        if not seen:
            todo += [(int(right), False), (node, True), (int(left), False)]
            continue
        if dist > 0 and before / dist < ratio and count(int(left)) >= least and count(int(right)) >= least:
            for k in leaves(int(left)):
                numbers[k] = numbers[k] or number
            number += 1
        before = dist
    return numbers


def clustered(df: DataFrame, keys: list[str], row: str, c: str, least: int = 5) -> DataFrame:
    """SIM10, SIM11: (keys, row, cluster) by average linkage of c. df holds a bounded sample of each key's rows."""
    pairs = distances(df, keys, row, c).groupBy(*keys).agg(F.collect_list(F.struct("a", "b", "distance")).alias("pairs"))
    rows = df.groupBy(*keys).agg(F.sort_array(F.collect_set(row)).alias("rows")).join(pairs, keys, "left")
    kind = df.schema[row].dataType.simpleString()

    @F.udf(f"array<struct<row:{kind},cluster:int>>")
    def run(names, pairs):
        at = {r: k for k, r in enumerate(names)}
        m = np.zeros((len(names), len(names)))
        for a, b, d in pairs or ():
            m[at[a], at[b]] = m[at[b], at[a]] = d
        return list(zip(names, tree_clusters(linkage(m), len(names), least)))

    out = rows.select(*keys, F.explode(run("rows", "pairs")).alias("x"))
    return out.select(*keys, F.col("x.row").alias(row), "x.cluster")


def dendrogram(df: DataFrame, keys: list[str], row: str, c: str, method: str = "average") -> DataFrame:
    """SIM12: (keys, step, left, right, distance, size), the rows that a dendrogram is drawn from."""
    pairs = distances(df, keys, row, c, band=1.0).groupBy(*keys).agg(F.collect_list(F.struct("a", "b", "distance")).alias("pairs"))
    rows = df.groupBy(*keys).agg(F.sort_array(F.collect_set(row)).alias("rows")).join(pairs, keys, "left")

    @F.udf("array<struct<step:int,left:int,right:int,distance:double,size:int>>")
    def run(names, pairs):
        at = {r: k for k, r in enumerate(names)}
        m = np.zeros((len(names), len(names)))
        for a, b, d in pairs or ():
            m[at[a], at[b]] = m[at[b], at[a]] = d
        return [(k, int(x), int(y), float(d), int(z)) for k, (x, y, d, z) in enumerate(linkage(m, method))]

    return rows.select(*keys, F.explode(run("rows", "pairs")).alias("x")).select(*keys, "x.*")
