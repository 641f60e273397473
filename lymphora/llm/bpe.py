"""Operator 8, byte-level BPE: recursive DuckDB queries contract each partition's distinct words."""

from __future__ import annotations

import base64
import hashlib
from itertools import chain

import pandas as pd
from pyspark.sql import DataFrame, SparkSession

from .common import lean, small_batches, table

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
#: Words that a worker remembers until a new generation begins; of the one before, those that occur again are kept.
#: Words a query takes at once.
REMEMBERED, AT_ONCE = 250_000, 50_000
#: Rows that a query's steps may add up to: a recursion keeps the rows of all its steps, so a query ends after as many
#: steps as fit, and words that aren't done go on in the next from where they are.
ROWS = 4_000_000

#: Rows are (w word, p position, id, after: the next position's id, next: the next position, step); the last row's after
#: and next are null. A step joins the pairs to the merge table and contracts each word's pair of least rank, the
#: leftmost of equals (rank and position in one number): the pair's first row takes what follows its second, which
#: goes, and the row before learns the new id. No step sorts. A word without such a pair adds no rows, and after the steps
#: that a query has (the parameter) it ends. Ids are
#: decoded by DECODE, an aggregate in order of position.
CONTRACT = """
WITH RECURSIVE t(w, p, id, after, next, step) AS (
  SELECT w, p, id, after, next, 0 FROM start
  UNION ALL
  SELECT y.w, y.p, CASE WHEN y.p = b.p THEN b.id ELSE y.id END, CASE WHEN y.p = b.p THEN b.after WHEN y.next = b.p THEN b.id ELSE y.after END, CASE WHEN y.p = b.p THEN b.next ELSE y.next END, y.step + 1
  FROM t y JOIN (
    SELECT best.w, best.best & 1073741823 AS p, best.best >> 30 AS id, best.gone, z.after, z.next
    FROM (SELECT x.w, min((m.id << 30) | x.p) AS best, arg_min(x.next, (m.id << 30) | x.p) AS gone FROM t x JOIN merges m ON m.a = x.id AND m.b = x.after GROUP BY x.w) best
    JOIN t z ON z.w = best.w AND z.p = best.gone
  ) b ON y.w = b.w WHERE y.p <> b.gone AND y.step < $steps
), last AS (SELECT w, max(step) AS step FROM t GROUP BY w)
SELECT w, list(t.id ORDER BY p) AS ids, any_value(step) = $steps AS open FROM t JOIN last USING (w, step) GROUP BY w
"""
DECODE = "SELECT w, from_hex(string_agg(v.hex, '' ORDER BY p)) FROM coded JOIN vocabulary v USING (id) GROUP BY w"


def load(path: str) -> list[tuple[bytes, int]]:
    with open(path, "rb") as f:
        return [(base64.b64decode(a), int(b)) for a, b in (line.split() for line in f if line.strip())]


class Coder:
    """Encodes and decodes with one vocabulary; one for each worker."""

    def __init__(self, ranks: list[tuple[bytes, int]], pattern: str):
        import duckdb
        import pyarrow as pa
        import regex

        self.split = regex.compile(pattern).findall
        self.ranks = dict(ranks)
        merges = [(self.ranks[b[:k]], self.ranks[b[k:]], i) for b, i in ranks for k in range(1, len(b)) if b[:k] in self.ranks and b[k:] in self.ranks]
        self.db = duckdb.connect(config={"threads": 1, "memory_limit": "400MB", "temp_directory": ""})  # never spills to a worker's folder
        a, b, i = zip(*merges) if merges else ((), (), ())
        self.db.register("m_", pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64()), "id": pa.array(i, pa.int64())}))
        self.db.execute("CREATE TABLE merges AS SELECT * FROM m_")
        self.db.register("v_", pa.table({"id": pa.array([i for _, i in ranks], pa.int64()), "bytes": pa.array([b for b, _ in ranks], pa.binary())}))
        self.db.execute("CREATE TABLE vocabulary AS SELECT id, hex(bytes) AS hex FROM v_")
        # of each word: its ids as text, what they decode to, and their number
        self.known: dict[str, tuple[str, bytes, int]] = {}
        self.before: dict[str, tuple[str, bytes, int]] = {}

    def learn(self, words: list[str]) -> None:
        """Ids of words not known yet, and what they decode to. A word that is a token as a whole is that token."""
        raws = [w.encode("utf-8", "surrogatepass") for w in words]
        ids: list[list[int]] = [[self.ranks[r]] if r in self.ranks else [] for r in raws]
        byte = [self.ranks[bytes([k])] for k in range(256)]
        some, size = [], 0
        for k in [k for k, own in enumerate(ids) if not own]:
            some.append(k)
            size += len(raws[k])
            if len(some) >= AT_ONCE or size >= ROWS // 8:
                self.contract(ids, {k: [byte[c] for c in raws[k]] for k in some})
                some, size = [], 0
        self.contract(ids, {k: [byte[c] for c in raws[k]] for k in some})
        for w, own, raw in zip(words, ids, self.decode(ids)):
            self.known[w] = ",".join(map(str, own)), raw, len(own)

    def contract(self, ids: list[list[int]], todo: dict[int, list[int]]) -> None:
        """Puts the ids of todo's words (number, ids of their bytes) into ids."""
        import numpy as np
        import pyarrow as pa

        while todo:
            size = np.fromiter(map(len, todo.values()), np.int64, len(todo))
            place = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
            own = np.fromiter(chain.from_iterable(todo.values()), np.int64, size.sum())
            end = place == np.repeat(size, size) - 1
            self.db.register("start", pa.table({"w": np.repeat(np.fromiter(todo, np.int64, len(todo)), size), "p": place, "id": own, "after": pa.array(np.roll(own, -1), mask=end), "next": pa.array(place + 1, mask=end)}))
            todo = {}
            for w, found, open_ in self.db.execute(CONTRACT, {"steps": max(2, min(256, ROWS // len(own)))}).fetchall():
                ids[w] = found
                if open_ and len(found) > 1:
                    todo[w] = found

    def decode(self, coded: list[list[int]], rows: int = 1 << 17) -> list[bytes]:
        """The bytes of each list of ids, by an ordered aggregation over about so many rows at once."""
        import numpy as np
        import pyarrow as pa

        out = [b""] * len(coded)
        a = 0
        while a < len(coded):
            b, n = a, 0
            while b < len(coded) and n < rows:
                n += len(coded[b])
                b += 1
            size = np.array([len(c) for c in coded[a:b]])
            w = np.repeat(np.arange(a, b), size)
            p = np.arange(n) - np.repeat(np.cumsum(size) - size, size)
            self.db.register("coded", pa.table({"w": w, "p": p, "id": np.fromiter(chain.from_iterable(coded[a:b]), np.int64, n)}))
            for k, raw in self.db.execute(DECODE).fetchall():
                out[k] = raw
            a = b
        return out

    def coded(self, texts: list[str]):
        """For each text its words' entries, in order. Texts are split together, so that a query takes many words."""
        split = [self.split(t) for t in texts]
        if len(self.known) > REMEMBERED:
            self.known, self.before = {}, self.known
        missing = set(chain.from_iterable(split)).difference(self.known)
        again = missing.intersection(self.before)
        self.known.update((w, self.before[w]) for w in again)
        self.learn(list(missing - again))
        for own in split:
            yield list(map(self.known.__getitem__, own))

    def encode(self, texts: list[str]):
        """Ids of each text, and the bytes that its words' ids decode to."""
        for words in self.coded(texts):
            yield [int(i) for shown, _, _ in words for i in shown.split(",")], b"".join(raw for _, raw, _ in words)


_coders: dict = {}


def coder(path: str | None = None) -> Coder:
    """This worker's coder of a vocabulary file; a public one unless a path is given."""
    if path not in _coders:
        import public_tokenizers

        _coders[path] = Coder(load(path or public_tokenizers.path(VOCABULARY)), public_tokenizers.PATTERN)
    return _coders[path]


def runs(texts, limit: int = 1 << 21):
    out, size = [], 0
    for t in texts:
        out.append(t or "")
        size += len(out[-1])
        if size >= limit:
            yield out
            out, size = [], 0
    if out:
        yield out


def encode_documents(docs: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, ids) of every row; a null or empty text has no ids. Repeated rows are encoded each; an
    empty table gives no rows; other columns are not read. path is a vocabulary file that executors can open."""

    @lean
    def run(parts):
        c = coder(path)
        for pdf in parts:
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "ids": [ids for some in runs(pdf["text"]) for ids, _ in c.encode(some)]})

    return docs.select("doc_id", "text").mapInPandas(run, "doc_id long, ids array<int>")


def decode_documents(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, bytes) of rows (doc_id, ids); null ids are none."""

    @lean
    def run(parts):
        c = coder(path)
        for pdf in parts:
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "bytes": c.decode([[] if i is None else list(i) for i in pdf["ids"]])})

    return encoded.select("doc_id", "ids").mapInPandas(run, "doc_id long, bytes binary")


def digest_documents(docs: DataFrame, path: str | None = None) -> DataFrame:
    """Encodes, decodes and digests in one go, so that ids don't pass through Spark: op8's columns. The ids of each
    distinct word are decoded by the ordered aggregation; a text's bytes are those of its words."""

    @lean
    def run(parts):
        c = coder(path)
        for pdf in parts:
            rows = []
            for some in runs(pdf["text"]):
                for words in c.coded(some):
                    shown, raw, n = zip(*words) if words else ((), (), ())
                    rows.append((sum(n), hashlib.sha256(",".join(shown).encode()).hexdigest(), hashlib.sha256(b"".join(raw)).hexdigest()))
            n, a, b = zip(*rows) if rows else ((), (), ())
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "n_tokens": n, "ids_sha256": a, "decoded_sha256": b})

    return docs.select("doc_id", "text").mapInPandas(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op8: every document encoded and decoded."""
    small_batches(spark)
    return digest_documents(table(spark, sf_dir, "documents"))
