"""Operator 7, near duplicates of embeddings by dual traversal of cover trees."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import connected_components, cut, lean, small_batches, table

COSINE = 0.93
#: Vectors of a leaf, vectors of a chunk (a task compares two chunks of one label), slack for rounding.
LEAF, CHUNK, SLACK = 24, 2048, 1e-9


class Node:
    """A ball: center (a unit vector), radius that covers all below, rows below, and children (none in a leaf)."""

    __slots__ = ("center", "radius", "children", "rows", "centers", "radii")

    def __init__(self, center, radius, children, rows):
        self.center, self.radius, self.children, self.rows = center, radius, children, rows
        if children:
            self.centers = np.stack([c.center for c in children])
            self.radii = np.array([c.radius for c in children])


def distance(cos: np.ndarray) -> np.ndarray:
    """Euclidean distance of unit vectors."""
    return np.sqrt(np.maximum(2 - 2 * cos, 0))


def build(x: np.ndarray, rows: np.ndarray, at: int, scale: float) -> Node:
    """A cover tree of rows of unit vectors x, with center x[at]. The next level's centers are a net of
    half the scale: none lies in another's ball, all rows do in some. A center stays one below (nesting)."""
    d = distance(x[rows] @ x[at])
    radius = float(d.max())
    if len(rows) <= LEAF or radius < 1e-7:
        return Node(x[at], radius, None, rows)
    scale = min(scale, radius) / 2
    children, left, d_left, center = [], rows, d, at
    while len(left):
        near = d_left <= scale
        children.append((center, left[near]))
        left = left[~near]
        if len(left):
            center = left[0]
            d_left = distance(x[left] @ x[center])
    # single points that no ball joins are gathered in leaves, in balls around their first
    lone = [c for c, own in children if len(own) == 1]
    nodes = [build(x, own, c, scale) for c, own in children if len(own) > 1]
    for k in range(0, len(lone), LEAF):
        own = np.array(lone[k : k + LEAF])
        nodes.append(Node(x[own[0]], float(distance(x[own] @ x[own[0]]).max()), None, own))
    if len(nodes) == 1:
        return nodes[0]
    return Node(x[at], radius, nodes, rows)


class Links:
    """Links between two trees' rows, or within one tree if b is a: for each row how many vectors it is linked with
    on the other side (copies counted), and a spanning forest of the links. Rows of b come after those of a.

    Dual traversal: a node pair goes if its centers lie farther apart than both radii and the threshold's distance;
    if even the farthest points of two nodes are linked, they are counted as a whole.
    """

    def __init__(self, a: Node, b: Node, xa: np.ndarray, xb: np.ndarray, ca: np.ndarray, cb: np.ndarray, cosine: float = COSINE):
        self.same = a is b
        self.shift = 0 if self.same else len(xa)
        self.count = np.zeros(self.shift + len(xb), np.int64)
        self.label = np.arange(len(self.count))
        self.forest: list[tuple[int, int]] = []
        self.copies = ca, cb
        limit = float(np.sqrt(2 - 2 * cosine))
        todo = [(a, b)]
        while todo:
            a, b = todo.pop()
            if a.children is None and b.children is None:
                self.compared(a, b, xa[a.rows] @ xb[b.rows].T >= cosine)
                continue
            below_a, below_b = a.children or [a], b.children or [b]
            mid_a, ra = (a.centers, a.radii) if a.children else (a.center[None], np.array([a.radius]))
            mid_b, rb = (b.centers, b.radii) if b.children else (b.center[None], np.array([b.radius]))
            apart, both = distance(mid_a @ mid_b.T), ra[:, None] + rb[None]
            sure = apart + both <= limit - SLACK
            for p, q in zip(*np.nonzero(sure)):
                self.whole(below_a[p], below_b[q])
            todo.extend((below_a[p], below_b[q]) for p, q in zip(*np.nonzero(~sure & (apart <= both + limit + SLACK))))

    def joined(self, rows: np.ndarray) -> None:
        own = np.unique(self.label[rows])
        if len(own) > 1:
            self.forest += [(int(own[0]), int(k)) for k in own[1:]]
            self.label[np.isin(self.label, own)] = own[0]

    def whole(self, a: Node, b: Node) -> None:
        ca, cb = self.copies
        self.count[a.rows] += cb[b.rows].sum() - (ca[a.rows] if self.same and a is b else 0)
        if not self.same:
            self.count[self.shift + b.rows] += ca[a.rows].sum()
        self.joined(np.concatenate((a.rows, self.shift + b.rows)))

    def compared(self, a: Node, b: Node, hits: np.ndarray) -> None:
        ca, cb = self.copies
        if self.same and a is b:
            np.fill_diagonal(hits, False)
        self.count[a.rows] += hits @ cb[b.rows]
        if not self.same:
            self.count[self.shift + b.rows] += hits.T @ ca[a.rows]
        other = self.shift + b.rows
        for k in np.flatnonzero((hits & (self.label[a.rows][:, None] != self.label[other][None])).any(axis=1)):
            self.joined(np.append(other[hits[k]], a.rows[k]))


def normalised(column: pd.Series) -> tuple[list, np.ndarray]:
    """Unit vectors in double precision as bytes; None for null, zero, null or non-finite components."""
    out = []
    for v in column:
        if v is None or not len(v):  # null or empty
            out.append(None)
            continue
        x = np.array([np.nan if c is None else c for c in v], np.float64) if v.dtype == object else np.asarray(v, np.float64)
        top = np.abs(x).max()
        if not np.isfinite(x).all() or top == 0:
            out.append(None)
            continue
        x = x / top
        out.append((x / np.linalg.norm(x)).tobytes())
    return out


def near_duplicates(vectors: DataFrame, cosine: float = COSINE) -> DataFrame:
    """(vec_id, n_links, component_id) for every row of vectors.

    Rows whose vector is null, empty, zero or holds null or non-finite components, and those without a label or
    vec_id, are linked with nothing; a row without a vec_id has a null component. Vectors of different lengths are never
    linked. Each of repeated rows is a vector of its own, linked with the others. An empty table gives no rows; other
    columns are not read.

    Equal directions of a label are one class. A label's classes are dealt by hash into chunks of about CHUNK, and
    a task traverses the cover trees of two chunks, so that a label with most rows is many tasks. A task returns
    sums and a spanning forest, so what is exchanged grows with the classes and not with the links.
    """
    @lean
    def unit(parts):
        for pdf in parts:
            yield pd.DataFrame({"vec_id": pdf["vec_id"], "label": pdf["label"], "unit": normalised(pdf["embedding"])})

    rows = vectors.select("vec_id", F.col("label").cast("long").alias("label"), "embedding").mapInPandas(unit, "vec_id long, label long, unit binary")
    rows = cut(rows, "units")
    usable = F.expr("label IS NOT NULL AND vec_id IS NOT NULL AND unit IS NOT NULL")
    units, key = rows.where(usable), ["label", "unit"]
    classes = cut(units.groupBy(*key).agg(F.min("vec_id").alias("first"), F.count("*").alias("copies")).withColumn("class", F.xxhash64("label", "unit")), "classes")
    members = units.join(classes, key).select("vec_id", "class", "copies", F.col("first"))
    # one row for each label and vector length
    counts = classes.groupBy("label", F.length("unit").alias("size")).agg(F.ceil(F.count("*") / CHUNK).cast("int").alias("chunks"))
    dealt = classes.withColumn("size", F.length("unit")).join(counts, ["label", "size"]).withColumn("chunk", F.pmod(F.xxhash64("class"), F.col("chunks")).cast("int"))
    others = F.transform(F.sequence(F.lit(0), F.col("chunks") - 1), lambda c: F.struct(F.least(c, F.col("chunk")).alias("p"), F.greatest(c, F.col("chunk")).alias("q")))
    columns = ["label", "size", "class", "first", "copies", "unit", "chunk"]
    sides = dealt.select(*columns, F.explode(others).alias("pq")).select(*columns, "pq.p", "pq.q")

    def compare(pdf: pd.DataFrame) -> pd.DataFrame:
        p, q = pdf["p"].iloc[0], pdf["q"].iloc[0]
        sides_ = []
        for c in (p, q) if p != q else (p,):
            own = pdf[pdf["chunk"] == c].sort_values(["first", "class"])
            if not len(own):
                return pd.DataFrame({"a": pd.Series(dtype="int64"), "b": pd.Series(dtype="Int64"), "n": pd.Series(dtype="int64")})
            x = np.frombuffer(b"".join(own["unit"]), np.float64).reshape(len(own), -1)
            sides_.append((own["class"].to_numpy(), own["copies"].to_numpy(), x, build(x, np.arange(len(x)), 0, 2.0)))
        (na, ca, xa, ta), (nb, cb, xb, tb) = sides_[0], sides_[-1]
        found = Links(ta, tb, xa, xb, ca, cb, cosine)
        who = na if found.same else np.concatenate((na, nb))
        some = np.flatnonzero(found.count)
        i, j = np.array(found.forest, np.int64).reshape(-1, 2).T
        return pd.DataFrame({"a": np.concatenate((who[some], who[i])), "b": pd.array([None] * len(some) + who[j].tolist(), "Int64"), "n": np.concatenate((found.count[some], np.zeros(len(i), np.int64)))})

    found = cut(sides.groupBy("label", "size", "p", "q").applyInPandas(compare, "a long, b long, n long"), "links")
    beyond = found.where("b IS NULL").groupBy(F.col("a").alias("class")).agg(F.sum("n").alias("beyond"))
    roots = connected_components(found.where("b IS NOT NULL").selectExpr("a AS src", "b AS dst")).withColumnRenamed("node", "class")
    least = classes.select("class", "first").join(roots, "class").groupBy("component").agg(F.min("first").alias("least"))
    roots = roots.join(least, "component").select("class", "least")
    known = members.join(beyond, "class", "left").join(roots, "class", "left")
    known = known.select("vec_id", (F.col("copies") - 1 + F.coalesce("beyond", F.lit(0))).alias("n_links"), F.coalesce("least", "first").alias("component_id"))
    return known.unionByName(rows.where(~usable).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op7: a row for each vector."""
    small_batches(spark, 2000)
    return near_duplicates(table(spark, sf_dir, "embeddings")).withColumn("kept", F.expr("vec_id <=> component_id"))


SQL = """
WITH RECURSIVE v AS (SELECT vec_id, label, embedding::DOUBLE[] AS e, sqrt(list_sum(list_transform(embedding::DOUBLE[], lambda x: x * x))) AS n FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL),
l AS (SELECT x.vec_id AS a, y.vec_id AS b FROM v x JOIN v y ON x.label = y.label AND x.vec_id <> y.vec_id AND len(x.e) = len(y.e)
  WHERE x.n > 0 AND y.n > 0 AND list_dot_product(x.e, y.e) / (x.n * y.n) >= 0.93),
r(a, b) AS (SELECT vec_id, vec_id FROM embeddings UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a),
c AS (SELECT a, min(b) AS root FROM r GROUP BY a), k AS (SELECT a, count(*) AS n FROM l GROUP BY a)
SELECT vec_id, coalesce(k.n, 0)::BIGINT AS n_links, root::BIGINT AS component_id, vec_id = root AS kept
FROM embeddings JOIN c ON vec_id = c.a LEFT JOIN k ON vec_id = k.a
"""
