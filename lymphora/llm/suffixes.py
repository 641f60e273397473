"""Operator 4, removal of repeated byte strings by a distributed merge sort of sparse suffixes.

Sorting every suffix would move several hundred bytes for each byte of text. So the suffix array is sparse:
each window of `length` bytes belongs to its minimizer, the least hash of its 32-byte grams, and equal windows
have equal minimizers. A run of neighbouring windows with one minimizer is a suffix that is cut where the run's
last window ends. Minimizers that occur once in the corpus can't be in a repeated window; their suffixes
stay out. The others are exchanged as front-coded sorted runs, in order of minimizer and bytes, and merged by
loser trees that never compare known prefixes again.

The merge's common prefixes decide: a suffix that shares k bytes with a neighbour has its first k - length + 1
windows in common with it. Copies that begin their runs alike, as all runs within a passage do, are settled so.
Only in groups of one minimizer where that leaves windows open (a passage's first run, text that repeats within
itself) are the windows compared by 64-bit hash. Minimizers with over HOT texts are split by a hash of the
aligned blocks around them, so that no group grows with a frequent passage.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import BYTE, cut, drop, held_by, lean, mix, powers, small_batches, table

#: Bytes of a string that is removed if it starts elsewhere too (op4's contract); bytes of a gram.
LENGTH, GRAM = 400, 32
#: Windows of a suffix at most, bytes of suffixes sorted at once, corpus bytes for each bucket of the merge.
MOST, FLUSH, BUCKET = 2048, 8 << 20, 4 << 20
#: Texts that hold a minimizer beyond which its windows are split by what is around them; bytes of windows hashed at once.
HOT, HASHED = 2000, 1 << 20
#: Minimizers at most that are sent to all tasks: those that make up over a MOST_SENT-th of all.
MOST_SENT = 4096
#: Bytes of minimizer and split in front of a suffix.
HEAD = 16


def sliding(x: np.ndarray, w: int, op) -> np.ndarray:
    """op (np.minimum or np.maximum) over each w neighbours: two scans over blocks of w."""
    n = len(x) - w + 1
    pad = -len(x) % w
    edge = np.concatenate((x, np.full(pad, x[-1], x.dtype))).reshape(-1, w)
    ahead = op.accumulate(edge, axis=1).ravel()
    behind = op.accumulate(edge[:, ::-1], axis=1)[:, ::-1].ravel()
    return op(behind[:n], ahead[w - 1 : w - 1 + n])


class Windows:
    """Grams and minimizers of some texts' bytes, laid end to end."""

    def __init__(self, docs: list[bytes], length: int):
        self.length = length
        self.buf = np.frombuffer(b"".join(docs), np.uint8)
        self.offset = np.concatenate(([0], np.cumsum([len(d) for d in docs]))).astype(np.int64)
        n = len(self.buf)
        self.count = max(0, n - length + 1)
        if not self.count:
            return
        power, inverse = powers(n + 1)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(BYTE[self.buf] * power[:n], out=self.sums[1:])
        self.doc = np.repeat(np.arange(len(docs), dtype=np.int32), np.diff(self.offset))
        self.grams = mix((self.sums[GRAM:] - self.sums[:-GRAM]) * inverse[: n - GRAM + 1]) | np.uint64(1)
        self.least = sliding(self.grams, length - GRAM + 1, np.minimum)
        self.least[self.doc[: self.count] != self.doc[length - 1 :]] = 0  # not in one text

    def anchors(self) -> tuple[np.ndarray, np.ndarray]:
        """Text and gram of each position whose gram is the least of some window."""
        w = self.length - GRAM + 1
        pad = np.zeros(w - 1, np.uint64)
        at = np.flatnonzero(sliding(np.concatenate((pad, self.least, pad)), w, np.maximum) == self.grams)
        return self.doc[at], self.grams[at]

    def runs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """First window, number of windows and minimizer of runs in one text, of MOST windows at most."""
        same = (self.least[1:] == self.least[:-1]) & (self.doc[1 : self.count] == self.doc[: self.count - 1])
        start = np.flatnonzero(np.concatenate(([True], ~same)))
        size = np.diff(np.append(start, self.count))
        parts = -(-size // MOST)
        which = np.repeat(np.arange(len(start)), parts)
        k = np.arange(len(which)) - np.repeat(np.cumsum(parts) - parts, parts)
        first = start[which] + k * MOST
        size = np.minimum(size[which] - k * MOST, MOST)
        real = self.least[first] != 0
        return first[real], size[real], self.least[first[real]]

    def around(self, first: int, size: int, gram: np.uint64) -> np.ndarray:
        """For windows with one minimizer a hash of the blocks in each, cut at multiples of a third of a window
        from the minimizer's first place in it: equal windows have equal hashes, and neighbours often do."""
        third = self.length // 3
        p = np.arange(first, first + size)
        at = first + np.flatnonzero(self.grams[first : first + size + self.length - GRAM] == gram)
        m = at[np.searchsorted(at, p)]
        low, high = m - (m - p) // third * third, m + (p + self.length - m) // third * third
        _, inverse = powers(len(self.buf) + 1)
        return mix((self.sums[high] - self.sums[low]) * inverse[low] + (high - low).astype(np.uint64))


def grouped(keys: list, texts: list, limit: int = 1 << 20):
    """Lists of (keys, bytes) of about limit bytes."""
    k, b, size = [], [], 0
    for key, t in zip(keys, texts):
        raw = (t or "").encode("utf-8", "surrogatepass")
        k.append(key)
        b.append(raw)
        size += len(raw)
        if size >= limit:
            yield k, b
            k, b, size = [], [], 0
    if k:
        yield k, b


def common(a: bytes, b: bytes, at: int) -> int:
    """Length of the common prefix of a and b, of which at bytes are known."""
    most = min(len(a), len(b))
    while at < most:
        end = min(at + 128, most)
        x, y = a[at:end], b[at:end]
        if x != y:
            d = int.from_bytes(x, "big") ^ int.from_bytes(y, "big")
            return end - (d.bit_length() + 7) // 8
        at = end
    return most


def front_code(items: list[tuple[bytes, int, int]]) -> bytes:
    """A sorted run of (suffix, id, times), each suffix without the prefix that it shares with the one before."""
    shared, tails, before = [], [], b""
    for s, _, _ in items:
        k = common(before, s, 0)
        shared.append(k)
        tails.append(s[k:])
        before = s
    head = [np.array([len(items)], "<u4"), np.array(shared, "<u4"), np.array([len(t) for t in tails], "<u4"), np.array([i for _, i, _ in items], "<i8"), np.array([t for _, _, t in items], "u1")]
    return zstandard.compress(b"".join(x.tobytes() for x in head) + b"".join(tails), 3)


def decoded(run: bytes):
    """(suffix, shared prefix, id, times) of a front-coded run, in order."""
    raw = zstandard.decompress(run)
    n = int(np.frombuffer(raw, "<u4", 1)[0])
    shared, size = np.frombuffer(raw, "<u4", n, 4).tolist(), np.frombuffer(raw, "<u4", n, 4 + 4 * n).tolist()
    ids, times = np.frombuffer(raw, "<i8", n, 4 + 8 * n).tolist(), np.frombuffer(raw, "u1", n, 4 + 16 * n).tolist()
    at, before = 4 + 17 * n, b""
    for k, z, i, t in zip(shared, size, ids, times):
        before = before[:k] + raw[at : at + z]
        at += z
        yield before, k, i, t


def merged(runs: list):
    """(suffix, prefix shared with the one before, id, times) of sorted runs, merged by a loser tree.

    Each contender carries the prefix that it shares with the last winner. The longer one is the smaller
    suffix; only on a tie are bytes compared, and only those beyond it. The loser then shares with the winner
    what that comparison found. An exhausted run shares -1 and loses to all.
    """
    size = 1
    while size < len(runs):
        size *= 2
    source = [decoded(r) for r in runs] + [iter(())] * (size - len(runs))
    none = (b"", -1, 0, 0)
    item = [next(s, none) for s in source]
    key = [x[0] for x in item]
    have = [min(x[1], 0) for x in item]
    tree = [0] * size

    def match(a: int, b: int) -> tuple[int, int]:
        ha, hb = have[a], have[b]
        if ha != hb:
            return (a, b) if ha > hb else (b, a)
        if ha < 0:
            return a, b
        x, y = key[a], key[b]
        h = common(x, y, ha)
        if h == len(x) or h < len(y) and x[h] < y[h]:
            have[b] = h
            return a, b
        have[a] = h
        return b, a

    winners = list(range(size))
    while len(winners) > 1:
        half, at = [], len(winners) // 2
        for k in range(at):
            w, tree[at + k] = match(winners[2 * k], winners[2 * k + 1])
            half.append(w)
        winners = half
    top = winners[0]
    while have[top] >= 0:
        yield key[top], have[top], item[top][2], item[top][3]
        item[top] = x = next(source[top], none)
        key[top], have[top] = x[0], x[1]
        k = (top + size) // 2
        while k:
            top, tree[k] = match(top, tree[k])
            k //= 2


def repeated_windows(runs: list, length: int) -> pd.DataFrame:
    """For suffixes of one bucket with repeated windows: id, number of windows, and first and end of each run of them.

    A group has one minimizer and one split. If common prefixes don't settle all its windows, they are hashed.
    """
    out = {"id": [], "n": [], "first": [], "end": []}
    open_: list[tuple[bytes, int, int, int]] = []
    size = 0

    def emit(i, n, firsts, ends):
        out["id"].append(i)
        out["n"].append(n)
        out["first"].append(np.asarray(firsts, np.int32))
        out["end"].append(np.asarray(ends, np.int32))

    def hashed():
        buf = np.frombuffer(b"".join(s for s, _, _, _ in open_), np.uint8)
        power, inverse = powers(len(buf) + 1)
        sums = np.zeros(len(buf) + 1, np.uint64)
        np.cumsum(BYTE[buf] * power[: len(buf)], out=sums[1:])
        n = np.array([len(s) - length + 1 for s, _, _, _ in open_])
        begin = np.cumsum(n) - n
        at = np.arange(n.sum()) + np.repeat(np.cumsum(n + length - 1) - (n + length - 1) - begin, n)
        h = mix((sums[at + length] - sums[at]) * inverse[at])
        order = np.argsort(h)
        equal = h[order][1:] == h[order][:-1]
        twice = np.zeros(len(h), bool)
        twice[order[1:][equal]] = True
        twice[order[:-1][equal]] = True
        for (_, _, i, known), a, z in zip(open_, begin.tolist(), n.tolist()):
            own = twice[a : a + z]
            own[:known] = True
            if own.any():
                edge = np.flatnonzero(np.diff(np.concatenate(([False], own, [False])).astype(np.int8)))
                emit(i, z, edge[::2], edge[1::2])
        open_.clear()

    def settle(group):
        """group: [suffix, prefix shared with the one before, id, times], in order, all different."""
        nonlocal size
        after = [g[1] for g in group[1:]] + [0]
        known = [len(s) - length + 1 if times > 1 else max(0, max(before, nxt) - length + 1) for (s, before, _, times), nxt in zip(group, after)]
        if all(k == len(g[0]) - length + 1 for k, g in zip(known, group)):
            for k, g in zip(known, group):
                emit(g[2], k, [0], [k])
        else:
            open_.extend((g[0], g[1], g[2], k) for k, g in zip(known, group))
            size += sum(len(g[0]) for g in group)
            if size >= HASHED:
                hashed()
                size = 0

    group: list[list] = []
    for s, shared, i, times in merged(runs):
        if group and shared < HEAD:
            settle(group)
            group = []
        if group and shared == len(s) == len(group[-1][0]) + HEAD:
            group[-1][3] += times
        else:
            group.append([s[HEAD:], shared - HEAD if group else 0, i, times])
    if group:
        settle(group)
    if open_:
        hashed()
    return pd.DataFrame({k: pd.Series(v, dtype=object if k in ("first", "end") else "int64") for k, v in out.items()})


def keyed(docs: DataFrame, *more: str) -> DataFrame:
    """With a key of doc_id and text, so that repeated rows and nulls keep apart from other rows."""
    return docs.select(F.coalesce("doc_id", F.lit(-1)).cast("long").alias("k1"), F.xxhash64("text").alias("k2"), "doc_id", "text", *more)


def repeated_spans(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """(k1, k2, firsts, ends), a table: byte ranges covered by strings of length bytes that start elsewhere too.

    A null text is empty. Texts under length bytes have none; matches don't cross texts; a text that occurs
    twice, also in repeated rows, is covered as a whole if it is long enough. Ranges may overlap. Rows without
    any are left out. Texts without a minimizer that another text has are not exchanged.
    """
    @lean
    def anchors(parts):
        for pdf in parts:
            rows = []
            for keys, raw in grouped(list(zip(pdf["k1"], pdf["k2"])), pdf["text"]):
                w = Windows(raw, length)
                if w.count:
                    of, gram = w.anchors()
                    cuts = np.searchsorted(of, np.arange(len(raw) + 1))
                    rows += [(*key, gram[a:b].view(np.int64)) for key, a, b in zip(keys, cuts, cuts[1:]) if b > a]
            if rows:
                yield pd.DataFrame(rows, columns=["k1", "k2", "grams"])

    base = keyed(docs).select("k1", "k2", "text")
    all_ = cut(base.mapInPandas(anchors, "k1 long, k2 long, grams array<long>"), "anchors")
    total = all_.agg(F.sum(F.size("grams").cast("long"))).first()[0] or 0
    # a text has two minimizers on average in each length - GRAM + 1 bytes
    buckets = max(16, -(-total * (length - GRAM + 2) // 2 // BUCKET))
    held = all_.select("k1", "k2", F.explode("grams").alias("gram"))
    counts = cut(held.groupBy("gram").agg(F.count("*").alias("n")).where("n > 1"), "often")
    often = counts.withColumn("hot", F.col("n") > HOT)
    # the most frequent, MOST_SENT at most by their counts, are sent to all tasks, as each would be one task's in a shuffle
    top = F.col("n") > total // MOST_SENT
    wide = held.join(F.broadcast(often.where(top).select("gram", F.col("hot").alias("top"))), "gram", "left")
    rest = wide.where("top IS NULL").join(often.where(~top).select("gram", "hot"), "gram").select("k1", "k2", "gram", "hot")
    wanted = wide.where("top IS NOT NULL").select("k1", "k2", "gram", F.col("top").alias("hot")).unionByName(rest)
    wanted = wanted.groupBy("k1", "k2").agg(F.collect_set("gram").alias("grams"), F.collect_set(F.when(F.col("hot"), F.col("gram"))).alias("hot"))
    wanted = cut(wanted, "wanted")
    drop(all_)
    drop(counts)

    @lean
    def suffixes(parts):
        sets: dict[int, dict[bytes, list]] = {}
        held_bytes = 0

        def flush():
            rows = [(b, front_code([(s, i, min(t, 2)) for s, (i, t) in sorted(own.items())])) for b, own in sets.items()]
            sets.clear()
            return pd.DataFrame({"bucket": [b for b, _ in rows], "run": [r for _, r in rows], "k1": 0, "k2": 0, "ids": None, "starts": None, "sizes": None, "firsts": None, "ends": None})

        for pdf in parts:
            rows = []
            for keys, raw in grouped(list(zip(pdf["k1"], pdf["k2"], pdf["grams"], pdf["hot"])), pdf["text"]):
                w = Windows(raw, length)
                if not w.count:
                    continue
                first, n, least = w.runs()
                own = np.isin(least, np.concatenate([np.asarray(k[2], np.int64) for k in keys]).view(np.uint64))
                first, n, least = first[own], n[own], least[own]
                split = np.zeros(len(first), np.uint64)
                hot = np.isin(least, np.concatenate([np.asarray(k[3], np.int64) for k in keys]).view(np.uint64))
                if hot.any():
                    more = [(first[~hot], n[~hot], least[~hot], split[~hot])]
                    for a, z, g in zip(first[hot].tolist(), n[hot].tolist(), least[hot]):
                        h = w.around(a, z, g)
                        at = np.flatnonzero(np.concatenate(([True], h[1:] != h[:-1])))
                        more.append((a + at, np.diff(np.append(at, z)), np.full(len(at), g), h[at]))
                    first, n, least, split = (np.concatenate(v) for v in zip(*more))
                    order = np.argsort(first, kind="stable")
                    first, n, least, split = first[order], n[order], least[order], split[order]
                _, inverse = powers(len(w.buf) + 1)
                end = first + n + length - 1
                ids = mix((w.sums[end] - w.sums[first]) * inverse[first] + n.astype(np.uint64)).view(np.int64)
                bucket = (mix(least ^ mix(split)) % np.uint64(buckets)).astype(np.int64)
                heads = np.stack([least, split], axis=1).astype(">u8").tobytes()
                data = w.buf.tobytes()
                of = w.doc[first]
                again = np.zeros(len(first), bool)
                for j, (a, z, i, b) in enumerate(zip(first.tolist(), end.tolist(), ids.tolist(), bucket.tolist())):
                    s = heads[HEAD * j : HEAD * j + HEAD] + data[a:z]
                    known = sets.setdefault(b, {}).setdefault(s, [i, 0])
                    if known[1]:
                        again[j] = True
                    else:
                        held_bytes += z - a + 200
                    known[1] += 1
                cuts = np.searchsorted(of, np.arange(len(raw) + 1))
                # a suffix that this task has seen before is repeated for certain; the others are looked up
                for j, (k, a, b) in enumerate(zip(keys, cuts, cuts[1:])):
                    if b > a:
                        sure, at = again[a:b], first[a:b] - w.offset[j]
                        spans = united(at[sure].tolist(), (end[a:b][sure] - w.offset[j]).tolist())
                        rows.append((k[0], k[1], ids[a:b][~sure], at[~sure], n[a:b][~sure].astype(np.int32), [x for x, _ in spans], [y for _, y in spans]))
                if held_bytes > FLUSH:
                    yield flush()
                    held_bytes = 0
            if rows:
                k1, k2, ids, starts, sizes, firsts, ends = zip(*rows)
                yield pd.DataFrame({"bucket": -1, "run": None, "k1": k1, "k2": k2, "ids": ids, "starts": starts, "sizes": sizes, "firsts": firsts, "ends": ends})
        if sets:
            yield flush()

    both = held_by(base, wanted, ["k1", "k2"]).join(wanted.hint("shuffle_merge"), ["k1", "k2"])
    sent = cut(both.mapInPandas(suffixes, "bucket int, run binary, k1 long, k2 long, ids array<long>, starts array<long>, sizes array<int>, firsts array<long>, ends array<long>"), "suffixes")
    drop(wanted)
    schema = "id long, n int, first array<int>, end array<int>"
    found = sent.where("bucket >= 0").select("bucket", "run").groupBy("bucket").applyInPandas(lambda pdf: repeated_windows(list(pdf["run"]), length), schema)
    places = sent.where("bucket < 0").select("k1", "k2", F.explode(F.arrays_zip(F.col("ids").alias("id"), F.col("starts").alias("start"), F.col("sizes").alias("n"))).alias("x")).select("k1", "k2", "x.*")
    shift = lambda c, by: F.transform(c, lambda v: v + F.col("start") + by)
    hits = places.join(found, ["id", "n"]).select("k1", "k2", shift("first", F.lit(0)).alias("firsts"), shift("end", F.lit(length - 1)).alias("ends"))
    hits = hits.unionByName(sent.where("bucket < 0 AND size(firsts) > 0").select("k1", "k2", "firsts", "ends"))
    spans = hits.groupBy("k1", "k2").agg(F.flatten(F.collect_list("firsts")).alias("firsts"), F.flatten(F.collect_list("ends")).alias("ends"))
    spans = cut(spans, "spans")
    drop(sent)
    return spans


def united(firsts, ends) -> list[tuple[int, int]]:
    """The ranges as maximal runs, in order."""
    out: list[list[int]] = []
    for a, b in sorted(zip(firsts, ends)):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def kept(raw: bytes, spans: list[tuple[int, int]]) -> bytes:
    parts, at = [], 0
    for a, b in spans:
        parts.append(raw[at:a])
        at = b
    return b"".join([*parts, raw[at:]])


def removals(docs: DataFrame, *more: str, length: int = LENGTH) -> tuple[DataFrame, DataFrame]:
    """docs' rows with text and the columns named, in two tables: those that may have spans, with firsts and ends
    (null if there are none), and the rest, from which nothing goes and which are not exchanged."""
    spans = repeated_spans(docs, length)
    base = keyed(docs, *more)
    some = held_by(base, spans, ["k1", "k2"]).join(spans.hint("shuffle_merge"), ["k1", "k2"], "left").drop("k1", "k2")
    return some, held_by(base, spans, ["k1", "k2"], keep=False).drop("k1", "k2")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op4: what is removed of each document, a digest of what stays, and that text (a character that is left in
    part goes as a whole there, but not in the digest)."""
    small_batches(spark)

    @lean
    def run(parts):
        for pdf in parts:
            rows = []
            for doc, text, a, b in zip(pdf["doc_id"], pdf["text"], pdf["firsts"], pdf["ends"]):
                raw = (text or "").encode("utf-8", "surrogatepass")
                spans = united(a.tolist(), b.tolist()) if a is not None else []
                rest = kept(raw, spans)
                rows.append((doc, len(raw), sum(y - x for x, y in spans), len(spans), hashlib.sha256(rest).hexdigest(), rest.decode("utf-8", "ignore")))
            yield pd.DataFrame(rows, columns=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "text"]).astype({"doc_id": "Int64"})

    some, rest = removals(table(spark, sf_dir, "documents"))
    text = F.coalesce("text", F.lit(""))
    none = F.lit(0).cast("long")
    rest = rest.select("doc_id", F.octet_length(text).cast("long").alias("n_bytes"), none.alias("n_removed"), none.alias("n_spans"), F.sha2(text, 256).alias("kept_sha256"), text.alias("text"))
    return some.mapInPandas(run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, text string").unionByName(rest)


#: The same in SQL: bytes as hex digits, a row for each 400-byte window.
SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
w AS (SELECT r, i, md5_number_lower(substring(h, 2 * i + 1, 800)) AS k FROM (SELECT r, h, unnest(range(0, len(h) // 2 - 399)) AS i FROM d WHERE len(h) >= 800)),
t AS (SELECT k FROM w GROUP BY k HAVING count(*) > 1),
m AS (SELECT r, i, CASE WHEN i <= lag(i) OVER (PARTITION BY r ORDER BY i) + 400 THEN 0 ELSE 1 END AS fresh FROM w SEMI JOIN t USING (k)),
s AS (SELECT r, min(i) AS a, max(i) + 400 AS b FROM (SELECT r, i, sum(fresh) OVER (PARTITION BY r ORDER BY i ROWS UNBOUNDED PRECEDING) AS g FROM m) GROUP BY r, g),
g AS (SELECT r, a, b, coalesce(lag(b) OVER (PARTITION BY r ORDER BY a), 0) AS before FROM s),
x AS (SELECT r, count(*) AS n, sum(b - a) AS gone, string_agg(substring(h, 2 * before + 1, 2 * (a - before)), '' ORDER BY a) || substring(any_value(h), 2 * max(b) + 1) AS h FROM g JOIN d USING (r) GROUP BY r),
y AS (SELECT doc_id, len(d.h) // 2 AS n_bytes, coalesce(gone, 0) AS gone, coalesce(n, 0) AS n, coalesce(x.h, d.h) AS h FROM d LEFT JOIN x USING (r))
SELECT doc_id, n_bytes::BIGINT AS n_bytes, gone::BIGINT AS n_removed, n::BIGINT AS n_spans, sha256(unhex(h)) AS kept_sha256,
  decode(unhex(regexp_replace(h, '([0-7].|[CD].[89AB].|E.[89AB].[89AB].|F.[89AB].[89AB].[89AB].)|..', '\1', 'g'))) AS text FROM y
"""
