"""Operator 1, n-gram Jaccard join with signature trees.

1. Shingles that occur in one text only can't be shared. Half of the shingle space (hashes below 2**63) is
   exchanged as packed 32-bit rests by bucket; a text with more lonely shingles than it may miss links with
   nothing. Only the others go on.
2. Texts with the same set are one class.
3. Classes with the same least shingle under a few permutations are blocks. In a block, a signature tree is
   traversed against itself; links that join two components are kept (a spanning forest).
4. Exact completion. A class goes on only if, as in step 1, enough of its shingles occur in other components
   too. Of those that are left, any two that link share one of their 25 % least shingles. Components that share
   shingles often enough, and whose sizes allow it, are compared by dual traversal of their trees; what the
   bitmaps leave is verified on the sets. A shingle in the prefixes of more than COMMON classes isn't joined on:
   its classes are compared by dual traversal too, SIDE with SIDE, so that no join grows with the square of them.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import connected_components, cut, lean, mix, shingle_sets, small_batches, table

#: Two sets link when UNION * their intersection >= LEAST * their union.
LEAST, UNION = 75, 100
#: Documents for each bucket of the exchange, permutations, sets of a block at most, bits of a bitmap, components compared with one at once.
SHARE, ROUNDS, BLOCK, BITS, SIDE = 4096, 2, 1024, 4096, 512
FAN = 16
COMMON = 32
#: Of the hashes, those below are tested in steps 1 and 4.
HALF = np.uint64(1 << 63)


def allowed(n: np.ndarray) -> np.ndarray:
    """How many shingles of a set of n a linked set can lack at most."""
    return n - -(-n * LEAST // UNION)


def linked(a: np.ndarray, b: np.ndarray) -> bool:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return UNION * both >= LEAST * (len(a) + len(b) - both)


def bitmap(s: np.ndarray) -> np.ndarray:
    bits = np.zeros(BITS, np.uint8)
    bits[(s >> np.uint64(20)).astype(np.int64) % BITS] = 1
    return np.packbits(bits).view(np.uint64)


class Tree:
    """A signature tree over sets, in an order in which like sets are neighbours.

    Level 0 has each set's bitmap, size (twice) and slack: size less bits. A node above OR-combines FAN
    bitmaps and has the range of their sizes and their largest slack. With components given, also their range:
    two nodes that hold one and the same component only need no look.
    """

    def __init__(self, bitmaps: np.ndarray, size: np.ndarray, component: np.ndarray | None = None):
        self.count = len(size)
        self.components = None if component is None else [(component, component)]
        self.levels = [(bitmaps, size, size, size - np.bitwise_count(bitmaps).sum(axis=1, dtype=np.int64))]
        while len(bitmaps) > 1:
            edge = np.arange(0, len(bitmaps), FAN)
            bitmaps = np.bitwise_or.reduceat(bitmaps, edge, axis=0)
            _, low, high, slack = self.levels[-1]
            self.levels.append((bitmaps, np.minimum.reduceat(low, edge), np.maximum.reduceat(high, edge), np.maximum.reduceat(slack, edge)))
            if component is not None:
                first, last = self.components[-1]
                self.components.append((np.minimum.reduceat(first, edge), np.maximum.reduceat(last, edge)))


def possible(a: Tree, b: Tree, level_a: int, level_b: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Whether nodes i of a and j of b can hold a linked pair, by the largest possible overlap.

    Each bit of a set that is not in j's bitmap stands for a shingle that no set below j has, so an overlap
    is at most the set's slack plus the bits common to both nodes. A link of sizes m and n takes an overlap
    of LEAST / (UNION + LEAST) * (m + n).
    """
    pa, low_a, high_a, slack_a = (v[i] for v in a.levels[level_a])
    pb, low_b, high_b, slack_b = (v[j] for v in b.levels[level_b])
    ok = (UNION * high_a >= LEAST * low_b) & (UNION * high_b >= LEAST * low_a)
    if a.components and b.components:
        (first_a, last_a), (first_b, last_b) = a.components[level_a], b.components[level_b]
        ok &= (first_a[i] != last_a[i]) | (first_b[j] != last_b[j]) | (first_a[i] != first_b[j])
    at = np.flatnonzero(ok)
    if len(at):
        common = np.bitwise_count(pa[at] & pb[at]).sum(axis=1, dtype=np.int64)
        most = np.minimum(np.minimum(slack_a[at], slack_b[at]) + common, np.minimum(high_a[at], high_b[at]))
        ok[at] = (UNION + LEAST) * most >= LEAST * (low_a[at] + low_b[at])
    return ok


def traverse(a: Tree, b: Tree, test):
    """Pairs (i, j) of a and b that pass test: all of them, or if a is b a spanning forest of them.
    Node pairs wait on a stack; FAN * FAN pairs of children are looked at together."""
    same = a is b
    root = list(range(a.count))

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    todo = [(len(a.levels) - 1, len(b.levels) - 1, 0, 0)]
    while todo:
        la, lb, i, j = todo.pop()
        if la == lb == 0:
            if same:
                x, y = find(i), find(j)
                if x != y and test(i, j):
                    root[max(x, y)] = min(x, y)
                    yield i, j
            elif test(i, j):
                yield i, j
            continue
        na, nb = max(la - 1, 0), max(lb - 1, 0)
        ci = np.arange(i * FAN, min((i + 1) * FAN, len(a.levels[na][1]))) if la else np.array([i])
        cj = np.arange(j * FAN, min((j + 1) * FAN, len(b.levels[nb][1]))) if lb else np.array([j])
        x, y = np.repeat(ci, len(cj)), np.tile(cj, len(ci))
        if same:
            x, y = x[x <= y], y[x <= y]
            if na == 0:
                x, y = x[x < y], y[x < y]
        if not len(x):
            continue
        if same and na == 0:  # pairs of one component need no look
            ok = np.array([not _joined(find, na, p, q, a.count) for p, q in zip(x.tolist(), y.tolist())])
            x, y = x[ok], y[ok]
        ok = possible(a, b, na, nb, x, y)
        # neighbours first: they join components early
        rest = sorted(zip((np.abs(x - y)[ok]).tolist(), x[ok].tolist(), y[ok].tolist()), reverse=True)
        todo.extend((na, nb, p, q) for _, p, q in rest)


def _joined(find, level: int, p: int, q: int, n: int) -> bool:
    span = FAN**level
    own = {find(k) for k in range(p * span, min((p + 1) * span, n))} | {find(k) for k in range(q * span, min((q + 1) * span, n))}
    return len(own) == 1 and (level == 0 or p != q)


def pack(*arrays: np.ndarray) -> bytes:
    return zstandard.compress(b"".join(x.tobytes() for x in (np.array([len(a) for a in arrays], "<u4"), *arrays)), 1)


def unpack(raw: bytes, *kinds: str) -> list[np.ndarray]:
    raw = zstandard.decompress(raw)
    at, out = 4 * len(kinds), []
    for n, k in zip(np.frombuffer(raw, "<u4", len(kinds)).tolist(), kinds):
        out.append(np.frombuffer(raw, k, n, at))
        at += out[-1].nbytes
    return out


def dealt(who: np.ndarray, sets: list[np.ndarray], buckets: int) -> list[tuple]:
    """(bucket, load) of the tested half of the sets: a load has ids, their numbers of hashes, and 32 bits of each hash."""
    tested = [s[: np.searchsorted(s, HALF)] for s in sets]
    if not sum(map(len, tested)):
        return []
    h = mix(np.concatenate(tested))
    of = np.repeat(np.arange(len(sets)), [len(t) for t in tested])
    b = ((h >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)
    order = np.lexsort((of, b))
    h, b, of = (h[order] & np.uint64(0xFFFFFFFF)).astype("<u4"), b[order], of[order]
    cuts = np.flatnonzero(np.concatenate(([True], b[1:] != b[:-1], [True])))
    out = []
    for x, y in zip(cuts, cuts[1:]):
        at, count = np.unique(of[x:y], return_counts=True)
        out.append((int(b[x]), pack(*(w[at].astype("<i8") for w in who), count.astype("<i4"), h[x:y])))
    return out


def shared_by_bucket(sent: DataFrame, roots: bool) -> DataFrame:
    """(id, shared): how many tested hashes of each id are also another id's or, with roots, another root's."""
    kinds = ("<i8", "<i8", "<i4", "<u4") if roots else ("<i8", "<i4", "<u4")

    def receive(pdf: pd.DataFrame) -> pd.DataFrame:
        loads = [unpack(x, *kinds) for x in pdf["load"]]
        who = np.concatenate([np.repeat(x[0], x[-2]) for x in loads])
        root = np.concatenate([np.repeat(x[1], x[-2]) for x in loads]) if roots else who
        h = np.concatenate([x[-1] for x in loads])
        order = np.argsort(h, kind="stable")
        start = np.flatnonzero(np.concatenate(([True], h[order][1:] != h[order][:-1])))
        r = root[order]
        # a copy outside this batch counts as another: both have the hash
        several = np.minimum.reduceat(r, start) != np.maximum.reduceat(r, start) if roots else np.diff(np.append(start, len(h))) > 1
        mark = np.repeat(several, np.diff(np.append(start, len(h))))
        ids, count = np.unique(who[order][mark], return_counts=True)
        return pd.DataFrame({"id": ids, "shared": count})

    return sent.groupBy("bucket").applyInPandas(receive, "id long, shared long").groupBy("id").agg(F.sum("shared").alias("shared"))


#: Whether a set can have a link, from the number of its tested hashes that others have: those that nobody has are lonely.
MAY = f"tested - coalesce(shared, 0) <= n - ceil(n * {LEAST} / {UNION}D)"


def suspects(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(sizes, ids): sizes (doc_id, n), and ids (doc_id) of the documents that step 1 can't rule out."""
    buckets = max(16, -(-docs.count() // SHARE))

    @lean
    def send(parts):
        for pdf in parts:
            ids = pdf["doc_id"].to_numpy()
            sets = list(shingle_sets(list(pdf["text"])))
            n = np.array([len(s) for s in sets])
            first: dict[bytes, int] = {}
            twin = np.zeros(len(ids), bool)
            for i, s in enumerate(sets):
                k = first.setdefault(s.tobytes(), i)
                if k != i:
                    twin[i] = twin[k] = True
            # of copies in a batch one is sent; all of them are suspects already
            own = np.array([i for i in first.values() if n[i]], np.int64)
            m = np.array([np.searchsorted(s, HALF) for s in sets])
            rows = [(-1, pack(ids.astype("<i8"), n.astype("<i4"), m.astype("<i4"), twin.astype("u1")))]
            yield pd.DataFrame(rows + dealt([ids[own]], [sets[i] for i in own], buckets), columns=["bucket", "load"])

    sent = cut(docs.select("doc_id", "text").mapInPandas(send, "bucket int, load binary"), "shingles")

    @lean
    def facts(parts):
        for pdf in parts:
            for load in pdf["load"]:
                i, n, m, twin = unpack(load, "<i8", "<i4", "<i4", "u1")
                yield pd.DataFrame({"doc_id": i, "n": n.astype(np.int64), "tested": m, "twin": twin > 0})

    about = cut(sent.where("bucket < 0").mapInPandas(facts, "doc_id long, n long, tested int, twin boolean"), "sizes")
    shared = shared_by_bucket(sent.where("bucket >= 0"), False).withColumnRenamed("id", "doc_id")
    own = about.where("n > 0").join(shared, "doc_id", "left")
    return about.select("doc_id", "n"), own.where(f"twin OR {MAY}").select("doc_id").distinct()


def classes_of(docs: DataFrame, ids: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(members, classes, sets): members (doc_id, class), classes (class, n, keys), and sets (class, n, shingles)
    with the sorted hashes of classes, and of some that no class is named after."""
    @lean
    def hashed(parts):
        salts = mix(np.arange(7, 7 + ROUNDS, dtype=np.uint64))
        for pdf in parts:
            rows = []
            for i, s in zip(pdf["doc_id"], shingle_sets(list(pdf["text"]))):
                if len(s):
                    own = [int(x) for x in (np.sum(mix(s)).view(np.int64), np.sum(mix(s ^ np.uint64(0x5555))).view(np.int64))]
                    rows.append((i, len(s), *own, s.tobytes(), [int(mix(s ^ k).min().view(np.int64)) for k in salts]))
            if rows:
                yield pd.DataFrame(rows, columns=["doc_id", "n", "c1", "c2", "shingles", "keys"])

    found = cut(docs.select("doc_id", "text").join(ids, "doc_id", "left_semi").mapInPandas(hashed, "doc_id long, n long, c1 long, c2 long, shingles binary, keys array<long>"), "sets")
    slim = found.select("doc_id", "n", "c1", "c2", "keys")
    least = slim.groupBy("n", "c1", "c2").agg(F.min("doc_id").alias("class"), F.first("keys").alias("keys"))
    least = cut(least, "classes")
    members = cut(slim.drop("keys").join(least, ["n", "c1", "c2"]).select("doc_id", "class"), "members")
    return members, least.select("class", "n", "keys"), found.select(F.col("doc_id").alias("class"), "n", "shingles")


def in_order(pdf: pd.DataFrame) -> tuple[np.ndarray, list[np.ndarray]]:
    """Classes and their sets by their least shingles, so that like sets are neighbours."""
    sets = [np.frombuffer(s, np.uint64) for s in pdf["shingles"]]
    order = sorted(range(len(sets)), key=lambda k: (sets[k][:4].tolist(), len(sets[k]), pdf["class"].iloc[k]))
    return pdf["class"].to_numpy()[order], [sets[k] for k in order]


def block_links(classes: DataFrame, sets: DataFrame) -> DataFrame:
    """(a, b): spanning links found in blocks of classes with a common least shingle.

    A block over BLOCK classes is dealt by size order and hash; what that parts, other permutations and the
    completion join.
    """
    keys = classes.select("class", "n", F.posexplode("keys").alias("round", "key"))
    many = keys.groupBy("round", "key").agg(F.count("*").alias("c")).where("c > 1")
    dealt = keys.join(many, ["round", "key"]).withColumn("part", F.pmod(F.xxhash64("class", "round"), F.ceil(F.col("c") / BLOCK)).cast("int"))
    blocks = dealt.select("class", "round", "key", "part").join(sets.select("class", "shingles"), "class")

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        if len(pdf) < 2:
            return pd.DataFrame({"a": pd.Series(dtype="int64"), "b": pd.Series(dtype="int64")})
        who, sets = in_order(pdf)
        tree = Tree(np.stack([bitmap(x) for x in sets]), np.array([len(x) for x in sets]))
        pairs = [(who[i], who[j]) for i, j in traverse(tree, tree, lambda i, j: linked(sets[i], sets[j]))]
        return pd.DataFrame({"a": np.array([p[0] for p in pairs], np.int64), "b": np.array([p[1] for p in pairs], np.int64)})

    return blocks.groupBy("round", "key", "part").applyInPandas(run, "a long, b long")


def completing_links(classes: DataFrame, sets: DataFrame, roots: DataFrame) -> DataFrame:
    """(a, b): a link for each two components that have one and that no block has joined."""
    named = classes.select("class").join(roots, "class", "left").select("class", F.coalesce("component", "class").alias("root"))
    buckets = max(16, -(-named.count() // SHARE))

    @lean
    def send(parts):
        for pdf in parts:
            all_sets = [np.frombuffer(x, np.uint64) for x in pdf["shingles"]]
            who = [pdf["class"].to_numpy(), pdf["root"].to_numpy()]
            m = np.array([np.searchsorted(x, HALF) for x in all_sets])
            rows = [(-1, pack(*(w.astype("<i8") for w in who), pdf["n"].to_numpy().astype("<i4"), m.astype("<i4")))]
            yield pd.DataFrame(rows + dealt(who, all_sets, buckets), columns=["bucket", "load"])

    @lean
    def facts(parts):
        for pdf in parts:
            for load in pdf["load"]:
                i, root, n, m = unpack(load, "<i8", "<i8", "<i4", "<i4")
                yield pd.DataFrame({"class": i, "root": root, "n": n.astype(np.int64), "tested": m})

    sent = cut(named.join(sets, "class").mapInPandas(send, "bucket int, load binary"), "crossing")
    about = sent.where("bucket < 0").mapInPandas(facts, "class long, root long, n long, tested int")
    shared = shared_by_bucket(sent.where("bucket >= 0"), True).withColumnRenamed("id", "class")
    left_over = about.join(shared, "class", "left").where(MAY).select("class", "root")
    own = cut(sets.join(left_over, "class").dropDuplicates(["class"]), "rooted")

    @lean
    def spread(parts):
        for pdf in parts:
            yield pd.DataFrame({"class": pdf["class"], "root": pdf["root"], "n": pdf["n"], "tokens": [np.frombuffer(x, np.int64) for x in pdf["shingles"]]})

    tokens = own.select("class", "root", "n", "shingles").mapInPandas(spread, "class long, root long, n long, tokens array<long>").select("class", "root", "n", F.explode("tokens").alias("token"))
    # The order of all shingles: those of one component first, then by how many classes have them, then by hash.
    several = tokens.groupBy("token").agg(F.min("root").alias("x"), F.max("root").alias("y"), F.count("*").alias("df")).where("x < y").select("token", "df")
    crossing = tokens.join(several, "token")
    w = Window.partitionBy("class")
    ranked = crossing.withColumns({"k": F.row_number().over(w.orderBy("df", "token")), "own": F.count("*").over(w)})
    ranked = ranked.withColumn("p", F.expr(f"n - ceil(n * {LEAST} / {UNION}D) + 1")).where("n - own + k <= p")
    last = F.max(F.struct("df", "token")).over(w)
    tokens = cut(ranked.withColumn("last", last).select("class", "root", "n", "p", "last", "token"), "prefixes")
    held = tokens.join(tokens.groupBy("token").agg(F.count("*").alias("df")).where("df > 1"), "token")
    common = held.where(F.col("df") > COMMON)
    # How many common shingles a prefix has: two prefixes share the lesser number of them at most.
    x = held.where(F.col("df") <= COMMON).join(common.groupBy("class").agg(F.count("*").alias("h")), "class", "left").fillna(0, ["h"])
    x = x.select("token", "class", "root", "n", "p", "last", "h")
    y = x.select("token", *(F.col(c).alias(c + "2") for c in ("class", "root", "n", "p", "last", "h")))
    fits = f"root < root2 AND {UNION} * n >= {LEAST} * n2 AND {UNION} * n2 >= {LEAST} * n"
    both = x.join(y, "token").where(fits).groupBy("class", "class2", "root", "root2", "n", "n2", "p", "p2", "last", "last2").agg((F.count("*") + F.least(F.min("h"), F.min("h2"))).alias("c"))
    # Of the set whose prefix ends first, all p least shingles were looked up in the other's prefix: at most n - p + c are common.
    need = f"ceil((n + n2) * {LEAST} / {UNION + LEAST}D)"
    enough = f"CASE WHEN last < last2 THEN n - p + c >= {need} WHEN last > last2 THEN n2 - p2 + c >= {need} ELSE greatest(n - p, n2 - p2) + c >= {need} END"
    close = cut(both.where(enough).select("class", "class2", "root", F.col("root2").alias("other")), "pairs")
    pairs = close.selectExpr("root", "other", "class").distinct(), close.selectExpr("root", "other", "class2 AS class").distinct()
    signed = own.select("class", "n", "shingles").mapInPandas(lambda parts: (pd.DataFrame({"class": x["class"], "n": x["n"], "bitmap": [bitmap(np.frombuffer(v, np.uint64)).tobytes() for v in x["shingles"]]}) for x in parts), "class long, n long, bitmap binary")
    parts_of = close.groupBy("root").agg(F.ceil(F.count_distinct("other") / SIDE).alias("parts"))
    pairs = close.join(parts_of, "root").withColumn("part", F.pmod(F.xxhash64("other"), F.col("parts")))
    sides = (pairs.select("root", "part", F.col(c).alias("class"), F.lit(k).alias("side")).distinct() for k, c in enumerate(("class", "class2")))
    left, right = (x.join(signed, "class") for x in sides)

    def compare(pdf: pd.DataFrame) -> pd.DataFrame:
        two = []
        for k in (0, 1):
            x = pdf[pdf["side"] == k].sort_values(["n", "class"])
            two.append((x["class"].to_numpy(), Tree(np.frombuffer(b"".join(x["bitmap"]), np.uint64).reshape(len(x), -1), x["n"].to_numpy())))
        (na, ta), (nb, tb) = two
        found = list(traverse(ta, tb, lambda i, j: na[i] != nb[j]))
        return pd.DataFrame({"a": na[[i for i, _ in found]] if found else np.zeros(0, np.int64), "b": nb[[j for _, j in found]] if found else np.zeros(0, np.int64)})

    likely = left.unionByName(right).groupBy("root", "part").applyInPandas(compare, "a long, b long")
    likely = likely.join(close.selectExpr("class AS a", "class2 AS b"), ["a", "b"], "left_semi")

    def meet(pdf: pd.DataFrame) -> pd.DataFrame:
        sides = []
        for k in (0, 1) if (pdf["i"] != pdf["j"]).iloc[0] else (0, 0):
            x = pdf[pdf["side"] == k].sort_values(["root", "n", "class"])
            sides.append((x["class"].to_numpy(), x["root"].to_numpy(), Tree(np.frombuffer(b"".join(x["bitmap"]), np.uint64).reshape(len(x), -1), x["n"].to_numpy(), x["root"].to_numpy())))
        (na, ra, ta), (nb, rb, tb) = sides
        if not len(na) or not len(nb):
            return pd.DataFrame({"a": np.zeros(0, np.int64), "b": np.zeros(0, np.int64)})
        found = np.array([(min(na[i], nb[j]), max(na[i], nb[j])) for i, j in traverse(ta, tb, lambda i, j: ra[i] != rb[j])], np.int64).reshape(-1, 2)
        return pd.DataFrame(np.unique(found, axis=0), columns=["a", "b"])

    spread_out = common.withColumn("parts", F.ceil(F.col("df") / SIDE).cast("int")).withColumn("part", F.pmod(F.xxhash64("class"), F.col("parts")).cast("int"))
    spread_out = spread_out.select("token", "class", "root", "part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("other"))
    spread_out = spread_out.select("token", "class", "root", F.least("part", "other").alias("i"), F.greatest("part", "other").alias("j"), (F.col("part") > F.col("other")).cast("int").alias("side"))
    met = spread_out.join(signed, "class").groupBy("token", "i", "j").applyInPandas(meet, "a long, b long")
    likely = likely.unionByName(met).distinct()

    @lean
    def verify(parts):
        for pdf in parts:
            ok = [linked(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)) for x, y in zip(pdf["x"], pdf["y"])]
            yield pdf.loc[ok, ["a", "b"]]

    of = lambda side, c: own.select(F.col("class").alias(side), F.col("shingles").alias(c))
    return likely.join(of("a", "x"), "a").join(of("b", "y"), "b").mapInPandas(verify, "a long, b long")


def components(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row of docs.

    A null or empty text, or one of white space, has no shingles and is alone. Copies are linked with each
    other. Rows with the same doc_id are one document's texts: each has its own n_shingles, and all have the least
    component of them. A row without a doc_id is linked with nothing and has a null component. An empty
    table gives no rows; other columns are not read.
    """
    known = docs.where("doc_id IS NOT NULL").select("doc_id", "text")
    sizes, ids = suspects(known)
    members, classes, sets = classes_of(known, ids)
    first = cut(block_links(classes, sets), "links")
    roots = connected_components(first.selectExpr("a AS src", "b AS dst")).selectExpr("node AS class", "component")
    more = cut(completing_links(classes, sets, roots), "more")
    # a document with several texts links their classes
    own = members.groupBy("doc_id").agg(F.min("class").alias("dst"))
    texts = members.join(own, "doc_id").where("class <> dst").select(F.col("class").alias("src"), "dst")
    roots = connected_components(first.unionByName(more).selectExpr("a AS src", "b AS dst").unionByName(texts)).selectExpr("node AS class", "component")
    of = members.join(roots, "class", "left").groupBy("doc_id").agg(F.min(F.coalesce("component", "class")).alias("root"))
    out = sizes.join(of, "doc_id", "left").select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("root", "doc_id").alias("component_id"))

    @lean
    def counted(parts):
        for pdf in parts:
            yield pd.DataFrame({"n_shingles": [len(s) for s in shingle_sets(list(pdf["text"]))]})

    missing = docs.where("doc_id IS NULL").select("text").mapInPandas(counted, "n_shingles long")
    none = F.lit(None).cast("long")
    return out.unionByName(missing.select(none.alias("doc_id"), "n_shingles", none.alias("component_id")))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op1: near-duplicate classes of all documents."""
    small_batches(spark)
    return components(table(spark, sf_dir, "documents"))


SQL = r"""
WITH RECURSIVE d AS (SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w FROM documents),
s AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
  ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS g FROM d),
c AS (SELECT min(doc_id) AS id, len(any_value(g)) AS n, any_value(g) AS g FROM s WHERE len(g) > 0 GROUP BY list_sort(g)),
t AS (SELECT id, n, md5_number_lower(unnest(g)) AS h FROM c),
f AS (SELECT h, count(*) AS df FROM t GROUP BY h HAVING df > 1),
p AS (SELECT id, n, h, row_number() OVER (PARTITION BY id ORDER BY coalesce(df, 1), h) AS k, df FROM t LEFT JOIN f USING (h)),
q AS (SELECT DISTINCT x.id AS a, y.id AS b FROM p x JOIN p y ON x.h = y.h AND x.id < y.id AND 100 * x.n >= 75 * y.n AND 100 * y.n >= 75 * x.n
  WHERE x.df > 1 AND y.df > 1 AND x.k <= x.n - ceil(x.n * 0.75) + 1 AND y.k <= y.n - ceil(y.n * 0.75) + 1),
o AS (SELECT a, b, len(list_intersect(x.g, y.g)) AS common, x.n + y.n AS total FROM q JOIN c x ON a = x.id JOIN c y ON b = y.id),
l AS (SELECT a, b FROM o WHERE 100 * common >= 75 * (total - common)), e AS (SELECT a, b FROM l UNION SELECT b, a FROM l),
r(a, b) AS (SELECT id, id FROM c UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a),
z AS (SELECT a, min(b) AS root FROM r GROUP BY a),
m AS (SELECT list_sort(g) AS g, root FROM c JOIN z ON a = id)
SELECT doc_id, len(s.g)::BIGINT AS n_shingles, coalesce(root, doc_id)::BIGINT AS component_id FROM s LEFT JOIN m ON list_sort(s.g) = m.g AND len(s.g) > 0
"""
