import hashlib
import json
import math
import random
import tracemalloc
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from lymphora.llm import bpe, chat, common, embed, html, jaccard, langid, mixing, quality, registry, search, suffixes

D = "/root/testdata/sf0.001"
DOC = "doc_id long, text string, lang string, source string, n_chars long, shingles int, class string, root int"


def docs(spark, texts, sources=None):
    return spark.createDataFrame([(i, t, "en", (sources or {}).get(i, "s"), None if t is None else len(t), 1, "x", 2) for i, t in enumerate(texts)], DOC)


def prose(seed, n):
    rng = random.Random(seed)
    return " ".join(f"w{rng.randint(0, 400)}" for _ in range(n))


ODD = [None, "", "   \t\n", "one", "one two three four", "Ünï ⅷ 日本 🎉", "x" * 3000, "a b " * 2000]


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_queries_match_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "conversations"):
        con.sql(f"create view {t} as select * from '{D}/{t}.parquet'")
    got = registry.QUERIES[name](spark, D)
    rel = con.sql(registry.ORACLES[name])
    order = [rel.columns.index(c) for c in got.columns]
    assert sorted(map(tuple, got.collect())) == sorted(tuple(r[i] for i in order) for r in rel.fetchall())


def shingles(t):
    w = (t or "").translate({c: c + 32 for c in range(65, 91)})
    for c in "\t\n\x0b\x0c\r":
        w = w.replace(c, " ")
    w = [x for x in w.split(" ") if x]
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute_components(texts):
    sets = [shingles(t) for t in texts]
    root = list(range(len(texts)))
    find = lambda x: x if root[x] == x else find(root[x])
    for i in range(len(sets)):
        for j in range(i):
            if sets[i] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return {i: (len(sets[i]), find(i)) for i in range(len(texts))}


def near_copies(seed, n):
    rng = random.Random(seed)
    out = []
    for g in range(n):
        base = prose(1000 * seed + g, rng.choice([6, 12, 40, 120])).split(" ")
        out.append(" ".join(base))
        for _ in range(rng.randint(0, 5)):
            x = list(base)
            for _ in range(rng.randint(0, 4)):
                x[rng.randrange(len(x))] = f"e{rng.randint(0, 9)}"
            out.append(" ".join(x).upper() if rng.random() < 0.2 else " ".join(x))
    return out


def around(seed, n):
    """Texts that all share shingles with one, many below the threshold."""
    rng = random.Random(seed)
    base = prose(seed, 150).split(" ")
    return [" ".join(f"e{rng.randint(0, 99)}" if rng.random() < p else w for w in base) for p in (rng.choice([0.01, 0.04, 0.06, 0.1]) for _ in range(n))]


@pytest.mark.parametrize("few", [False, True])
@pytest.mark.parametrize("texts", [ODD + ODD + near_copies(1, 40), around(3, 150), []])
def test_jaccard_against_brute_force(spark, monkeypatch, texts, few):
    if few:  # nearly all shingles are common ones, in several parts
        monkeypatch.setattr(jaccard, "COMMON", 2)
        monkeypatch.setattr(jaccard, "SIDE", 8)
        monkeypatch.setattr(jaccard, "ROUNDS", 1)
    common.ship(spark)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.components(docs(spark, texts)).collect()}
    assert got == brute_components(texts)


def brute_removal(texts, length=400):
    """Rows (n_bytes, n_removed, n_spans, digest, text) of the texts, in order."""
    raws = [(t or "").encode() for t in texts]
    counts = Counter(b[i : i + length] for b in raws for i in range(len(b) - length + 1))
    out = []
    for b in raws:
        gone = np.zeros(len(b) + 2, bool)
        for i in range(len(b) - length + 1):
            if counts[b[i : i + length]] > 1:
                gone[1 + i : 1 + i + length] = True
        spans = int((gone[1:] & ~gone[:-1]).sum())
        rest = bytes(x for x, g in zip(b, gone[1:]) if not g)
        out.append((len(b), int(gone.sum()), spans, hashlib.sha256(rest).hexdigest(), rest.decode("utf-8", "ignore")))
    return out


def passages(seed, n, shared):
    """Texts around a few shared passages, at different places and partly cut."""
    rng = random.Random(seed)
    common_ = [prose(seed + k, 110) for k in range(shared)]
    out = []
    for k in range(n):
        p = rng.choice(common_)
        a, b = (0, len(p)) if rng.random() < 0.5 else sorted(rng.sample(range(len(p)), 2))
        out.append(prose(seed + 100 + k, rng.randint(0, 90)) + p[a:b] + prose(seed + 500 + k, rng.randint(0, 90)))
    return out


REMOVALS = [
    ODD + [prose(1, 300), prose(2, 50) + prose(1, 300)[100:900] + prose(3, 50), prose(1, 300), "é" * 450 + prose(4, 90) + "é" * 450, prose(5, 60)[:400], "z" + prose(5, 60)[:400]],
    passages(7, 60, 2) + ["ab" * 700, "日本語" * 300 + prose(8, 20) + "本" + "日本語" * 200, prose(9, 30_000) + prose(7, 110)],
    [],
]


@pytest.mark.parametrize("hot", [False, True])
@pytest.mark.parametrize("texts", REMOVALS)
def test_removal_against_brute_force(spark, tmp_path, monkeypatch, texts, hot):
    if hot:  # every shared minimizer is split
        monkeypatch.setattr(suffixes, "HOT", 1)
    docs(spark, texts).write.parquet(f"{tmp_path}/documents.parquet")
    got = {r[0]: tuple(r[1:]) for r in suffixes.query(spark, str(tmp_path)).collect()}
    assert got == dict(enumerate(brute_removal(texts)))


def test_removal_of_null_and_repeated_rows(spark, tmp_path):
    texts = [prose(1, 200), prose(1, 200), prose(2, 200), None, None, "", prose(3, 90) + prose(2, 200)[:500], prose(4, 100)]
    ids = [1, 1, 1, 1, None, None, None, 2]
    rows = [(i, t, "en", "s", None, 1, "x", 2) for i, t in zip(ids, texts)]
    spark.createDataFrame(rows, DOC).write.parquet(f"{tmp_path}/documents.parquet")
    got = [tuple(r) for r in suffixes.query(spark, str(tmp_path)).collect()]
    assert Counter(got) == Counter((i, *r) for i, r in zip(ids, brute_removal(texts)))


def test_passages_of_fifty_words_go(spark):
    """Planted passages of 51 to 80 words, all under 400 bytes or around, among clean documents."""
    rng = random.Random(3)
    common.ship(spark)
    planted = [" ".join("".join(rng.choice("aeinorst") for _ in range(rng.randint(2, 7))) for _ in range(n)) for n in (51, 55, 60, 80)]
    assert min(len(p) for p in planted) < 300
    texts = [f"{prose(50 + k, 80)} {planted[k % 4]} {prose(90 + k, 60)}" for k in range(12)] + [prose(200 + k, 300) for k in range(10)]
    x = docs(spark, texts)
    got = {r.doc_id: r.text for r in corpus_pipeline.without_repeats(spark, x, "").collect()}
    assert got == {i: r[4] for i, r in enumerate(brute_removal(texts, corpus_pipeline.PASSAGE))}
    assert not any(p in t for p in planted for t in got.values()) and all(got[i] == texts[i] for i in range(12, 22))


def test_loser_tree():
    rng = random.Random(5)
    runs = [sorted({bytes(rng.choice(b"ab") for _ in range(rng.randint(0, 9))) for _ in range(40)}) for _ in range(7)]
    before = b""
    out = []
    for s, k, _, _ in suffixes.merged([suffixes.front_code([(x, 1, 1) for x in r]) for r in runs]):
        assert k == suffixes.common(before, s, 0)
        before = s
        out.append(s)
    assert out == sorted(x for r in runs for x in r)


def test_bpe_is_tiktoken(spark, tmp_path):
    import public_tokenizers as P
    import tiktoken

    enc = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=dict(bpe.load(P.path(bpe.VOCABULARY))), special_tokens={})
    texts = ODD + ["it's  <|endoftext|>\n\n 12345", "aaaaaaaaaaaaaa!!!!"]
    docs(spark, texts).write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r for r in bpe.query(spark, str(tmp_path)).collect()}
    coded = bpe.encode_documents(docs(spark, texts))
    ids = {r.doc_id: r.ids for r in coded.collect()}
    back = {r.doc_id: bytes(r.bytes) for r in bpe.decode_documents(coded).collect()}
    assert back == {i: (t or "").encode() for i, t in enumerate(texts)}
    for i, t in enumerate(texts):
        want = enc.encode_ordinary(t or "")
        assert ids[i] == want and got[i].n_tokens == len(want)
        assert got[i].ids_sha256 == hashlib.sha256(",".join(map(str, want)).encode()).hexdigest()
        assert got[i].decoded_sha256 == hashlib.sha256((t or "").encode()).hexdigest()


def brute_search(queries, texts, k):
    rows = [[w.lower() for w in (t or "").split()] for t in texts]
    mean, df = sum(map(len, rows)) / len(rows), Counter(w for r in rows for w in set(r))
    idf = {w: math.log(1 + (len(rows) - n + 0.5) / (n + 0.5)) for w, n in df.items()}
    out = set()
    for q, t in queries:
        scores = []
        for i, r in enumerate(rows):
            c = Counter(r)
            s = sum(idf[w] * c[w] * 2.2 / (c[w] + 1.2 * (0.25 + 0.75 * len(r) / mean)) for w in {x.lower() for x in (t or "").split()} if c[w])
            scores += [(-round(s, 6), i)] if s else []
        out |= {(q, rank + 1, i, -s) for rank, (s, i) in enumerate(sorted(scores)[:k])}
    return out


@pytest.mark.parametrize("block, words, k", [(1, 1, 3), (2, 3, 1), (3, 8, 4), (64, 2048, 10), (4, 0, 50)])
def test_shards_skip_nothing_that_counts(monkeypatch, block, words, k):
    """Many shards with ties, repeated rows and thresholds carried from shard to shard find what scoring all finds."""
    monkeypatch.setattr(search, "BLOCK", block)
    monkeypatch.setattr(search, "WORDS", words)
    rng = np.random.default_rng(block)
    texts = [" ".join(f"w{x}" for x in rng.zipf(1.4, rng.integers(1, 40)) % 300) for _ in range(150)] * 2
    vectors = list(search.words(texts))
    terms, df = np.unique(np.concatenate([w for w, _ in vectors]), return_counts=True)
    idf, mean = np.log1p((len(texts) - df + 0.5) / (df + 0.5)), sum(c.sum() for _, c in vectors) / len(texts)
    shards = [search.Shard(search.packed([(i, *vectors[i]) for i in range(a, min(a + 37, 300))], 37), mean) for a in range(0, 300, 37)]
    shards.append(search.Shard(search.packed([], 1), mean))
    some = list(range(0, 300, 7))
    queries = [(vectors[i][0], idf[np.searchsorted(terms, vectors[i][0])], 0.0) for i in some]
    best = [(np.zeros(0), np.zeros(0, bool), np.zeros(0, np.int64))] * len(some)
    for shard in shards:
        shard.search(queries, best, k)
    got = sorted((q, r + 1, int(i), pytest.approx(s, abs=2e-6)) for q, b in zip(some, best) for r, (s, i) in enumerate(zip(b[0], b[2])))
    assert sorted(brute_search([(i, texts[i]) for i in some], texts, k)) == got
    floors = [(t, w, b[0][-1]) for (t, w, _), b in zip(queries, best)]
    again = [(np.zeros(0), np.zeros(0, bool), np.zeros(0, np.int64))] * len(some)
    for shard in shards:
        shard.search(floors, again, k)
    for a, b in zip(best, again):
        assert len(a[0]) < k or all(map(np.array_equal, a, b))


def test_no_shard_of_a_partition_is_small(monkeypatch):
    """each shard costs time for every query, so a partition of 10 documents isn't split into 9 and 1."""
    monkeypatch.setattr(search, "DOCS", 9)
    for n in range(1, 40):
        texts = [None if i % 5 == 3 else " ".join(f"w{i}x{j}" for j in range(1 + i % 7)) for i in range(n)]
        parts = [pd.DataFrame({"doc_id": range(a, min(a + 4, n)), "text": texts[a : a + 4]}) for a in range(0, n, 4)]
        rows = list(search.shards(parts, 5))
        ids = [np.frombuffer(r["doc_id"], np.int64) for r in rows]
        assert sorted(np.concatenate(ids)) == [i for i, t in enumerate(texts) if t]
        assert sum(r["n_docs"] for r in rows) == n and sum(r["n_words"] for r in rows) == sum(len((t or "").split()) for t in texts)
        assert [r["shard"] for r in rows] == list(range(5, 5 + len(rows))) and max(map(len, ids)) <= 9
        assert len(rows) == 1 or min(map(len, ids)) >= 3
    assert search.first_part([1]) == 1 and search.first_part([900, 1, 1]) == 1 and search.first_part([1] * 6) == 4


def test_documents_are_scored_for_all_queries_together(monkeypatch):
    """F2: a shard scores the documents of 40 queries in few runs, not query by query, and in short runs finds the same among ties."""
    texts = [prose(i % 60, 20 + i % 60) for i in range(180)] + [prose(7, 27)] * 300
    vectors = list(search.words(texts))
    terms, df = np.unique(np.concatenate([w for w, _ in vectors]), return_counts=True)
    idf, mean = np.log1p((len(texts) - df + 0.5) / (df + 0.5)), sum(c.sum() for _, c in vectors) / len(texts)
    shard = search.Shard(search.packed([(i, *v) for i, v in enumerate(vectors)], len(texts)), mean)
    queries = [(vectors[i][0], idf[np.searchsorted(terms, vectors[i][0])], 0.0) for i in range(40)]
    runs, plain = [], search.Shard.scores
    monkeypatch.setattr(search.Shard, "scores", lambda self, asks, *x: runs.append(len(set(asks))) or plain(self, asks, *x))

    def found():
        best = [(np.zeros(0), np.zeros(0, bool), np.zeros(0, np.int64))] * len(queries)
        shard.search(queries, best, 10)
        return best

    want = found()
    assert len(runs) < 20 and max(runs) == 40
    monkeypatch.setattr(search, "RUN", 50)
    assert all(all(map(np.array_equal, a, b)) for a, b in zip(want, found())) and len(runs) > 100
    assert sorted(brute_search([(i, texts[i]) for i in range(40)], texts, 10)) == sorted((q, r + 1, int(i), pytest.approx(s, abs=2e-6)) for q, b in enumerate(want) for r, (s, i) in enumerate(zip(b[0], b[2])))


@pytest.mark.parametrize("block", [2, 64])
def test_search_against_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(search, "BLOCK", block)
    common.ship(spark)
    texts = [t for t in ODD if t is None or t.isascii()] * 2 + near_copies(4, 30) + [prose(9, 500)] * 15
    queries = [(i, t) for i, t in enumerate(texts) if i % 3 == 0] + [(1000, "no-such-word"), (1001, None), (1002, "W1 w2 w2")]
    got = search.top_k(spark.createDataFrame(queries, "query_id long, text string"), docs(spark, texts), 5)
    close = lambda rows: sorted((q, r, i, pytest.approx(s, abs=2e-6)) for q, r, i, s in rows)
    assert sorted(map(tuple, got.collect())) == close(brute_search(queries, texts, 5))
    assert search.top_k(docs(spark, []).selectExpr("doc_id AS query_id", "text"), docs(spark, [])).count() == 0
    odd = spark.createDataFrame([(None, "a b"), (7, "a b"), (7, "a b")], "doc_id long, text string")
    assert [r.doc_id for r in search.top_k(spark.createDataFrame([(1, "b")], "query_id long, text string"), odd).orderBy("rank").collect()] == [7, 7, None]


def brute_links(rows):
    """Counter of (vec_id, n_links, component_id) by comparing all rows."""
    def usable(r):
        return r[0] is not None and r[1] and r[2] is not None and all(c is not None and math.isfinite(c) for c in r[1]) and any(r[1])

    near = lambda x, y: len(x) == len(y) and np.dot(np.float64(x), np.float64(y)) / np.linalg.norm(np.float64(x)) / np.linalg.norm(np.float64(y)) >= 0.93
    linked = [[k for k, s in enumerate(rows) if k != i and usable(r) and usable(s) and r[2] == s[2] and near(r[1], s[1])] for i, r in enumerate(rows)]
    out = []
    for i, r in enumerate(rows):
        seen, todo = {i}, [i]
        while todo:
            more = [k for k in linked[todo.pop()] if k not in seen]
            seen.update(more)
            todo += more
        out.append((r[0], len(linked[i]), min((rows[k][0] for k in seen if rows[k][0] is not None), default=None)))
    return Counter(out)


VECTORS = "vec_id long, embedding array<float>, label int, unit binary, class string, first int"


@pytest.mark.parametrize("chunk", [7, 2048])
def test_embeddings_against_brute_force(spark, monkeypatch, chunk):
    monkeypatch.setattr(embed, "CHUNK", chunk)
    common.ship(spark)
    rows = [(0, [1.0, 0.0], 1), (1, [2.0, 0.0], 1), (2, [1.0, 0.1], 1), (3, [1.0, 0.0], 2), (4, None, 1), (5, [0.0, 0.0], 1), (6, [1.0, None], 1), (7, [float("nan"), 1.0], 1), (8, [1.0, 0.0], None), (9, [1.0, 0.0, 0.0], 1), (10, [], 1), (None, [1.0, 0.0], 1)]
    rng = np.random.default_rng(4)
    x = rng.standard_normal((20, 6)).repeat(6, axis=0) + 0.2 * rng.standard_normal((120, 6))
    rows += [(100 + k, [float(np.float32(c)) for c in v], int(k % 2) + 5) for k, v in enumerate(x)]
    rows += [rows[0], rows[2], rows[20], (20, rows[30][1], 5), (None, None, None)]
    got = embed.near_duplicates(spark.createDataFrame([(*r, b"x", "c", 1) for r in rows], VECTORS)).collect()
    assert Counter(map(tuple, got)) == brute_links(rows)
    assert embed.near_duplicates(spark.createDataFrame([], VECTORS)).count() == 0


def test_cover_tree_against_brute_force():
    rng = np.random.default_rng(2)
    x = rng.standard_normal((60, 8)).repeat(5, axis=0) + 0.15 * rng.standard_normal((300, 8))
    x = np.concatenate((x, x[:1] + 1e-3 * rng.standard_normal((100, 8))))  # all within the threshold
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    copies = rng.integers(1, 4, len(x))
    hits = x @ x.T >= 0.93
    np.fill_diagonal(hits, False)
    tree = embed.build(x, np.arange(len(x)), 0, 2.0)
    found = embed.Links(tree, tree, x, x, copies, copies)
    assert found.count.tolist() == (hits @ copies).tolist() and all(hits[i].any() and hits[j].any() for i, j in found.forest)
    a, b = x[:150], x[150:]
    ta, tb = embed.build(a, np.arange(150), 0, 2.0), embed.build(b, np.arange(len(b)), 0, 2.0)
    found = embed.Links(ta, tb, a, b, copies[:150], copies[150:])
    assert found.count.tolist() == np.concatenate((hits[:150, 150:] @ copies[150:], hits[150:, :150] @ copies[:150])).tolist()


def test_jaccard_null_and_repeated_ids(spark):
    common.ship(spark)
    a, b, c = prose(1, 50), prose(2, 50), prose(3, 50)
    rows = [(4, a), (4, a), (4, b), (2, a), (9, b), (None, a), (None, None), (7, c), (7, None), (7, c), (8, "")]
    got = jaccard.components(spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, root string")).collect()
    size = lambda t: len(shingles(t))
    assert Counter(map(tuple, got)) == Counter((i, size(t), {4: 2, 2: 2, 9: 2, 7: 7, 8: 8, None: None}[i]) for i, t in rows)


def test_html():
    page = "<html><head><title>t</title><script>var a='</p>';</script></head><body><header>Top</header><nav><a href=x>Menu</a></nav><div class='cookie-notice'>We use cookies</div><aside>side</aside><article><h1>Ti&amp;tle</h1><p>First   <b>bold</b><br>line<p>Second &#233;<form><input value=q>Send</form><div class=ad>Buy</div></article><section id=comments><p>me too</p></section><footer>foot</footer>"
    assert html.main_text(page) == "Ti&tle\nFirst bold line\nSecond é"
    assert html.main_text(None) == html.main_text("") == html.main_text("<p") == ""
    long = "text " * 60
    assert html.main_text(f"<body><ul><li><a href=1>Home</a></li></ul><div>{long}</div><div><p>{long}</p></div></body>") == "\n".join([long.strip()] * 2)


def test_html_windows_decide_beside_articles():
    long, gap = "text " * 60, "<nav>a</nav>" * 4
    assert html.main_text(f"<div><p>{long}</p><p>{long}</p></div><article class='related-card'><h3>Teaser</h3><p>read on</p></article>") == "\n".join([long.strip()] * 2)
    assert html.main_text(f"<div><p>{long}{long}</p></div><article><p>{long * 4}</p></article><div>Legal</div>") == f"{(long * 2).strip()}\n{(long * 4).strip()}"
    assert html.main_text(f"<article><h1>Title</h1>{gap}<p>{long}</p>{gap}<p>near</p>{gap}<p>stray</p></article>") == f"Title\n{long.strip()}\nnear"


def test_html_marks_of_wrappers():
    long, side = "text " * 60, "<div class='left-sidebar'>Aside</div><div id='site-footer'>Foot</div><div class='ad-slot'>Buy</div>"
    for mark in ("class='content with-sidebar'", "id='page' class='no-sidebar'", "class='layout-header-fixed'", "class='has-comments'", "class='comments'", "id='header-wide'"):
        assert html.main_text(f"<div {mark}><article><p>{long}</p></article>{side}</div>".replace("</article>" + side, f"{side}</article>")) == long.strip()
        assert html.main_text(f"<section {mark}><p>{long}</p></section>{side}") == long.strip()
    assert html.main_text(f"<article><p>{long}</p></article><div class='related'><article><p>{long[:90]}</p></article></div><div class='comments'>{long * 3}</div>") == long.strip()


def test_mixing(spark):
    assert mixing.targets([10, 10, 10], [1, 2, 3]) == pytest.approx([5, 10, 15])
    assert mixing.targets([100, 1, 1], [1, 2, 3]) == pytest.approx([96, 3, 3])
    for n in (1, 2, 7, 100):
        assert sorted(mixing.permuted(np.arange(n), n, 5).tolist()) == list(range(n))
    common.ship(spark)
    texts = [prose(i, 150 + i) for i in range(60)] + ODD
    sources = {i: ["a", "b", None][i % 3] for i in range(len(texts))}
    mix = mixing.Mix(docs(spark, texts, sources))
    taken = defaultdict(int)
    for r in mixing._taken(mix).collect():
        taken[r.doc_id] += r.times * r.words
    goal = {s["source"]: s["target"] for s in mix.sources}
    for s in goal:
        assert sum(n for i, n in taken.items() if sources[i] == s) == pytest.approx(goal[s], rel=0.05)
    assert all(n <= 3 * len((texts[i] or "").split()) for i, n in taken.items())
    assert {r.doc_id for r in mixing.mix_documents(docs(spark, [])).collect()} == set()


def test_mixing_null_and_repeated_ids(spark, tmp_path):
    common.ship(spark)
    texts = [prose(i, 200 + i) for i in range(40)]
    ids = [None] * 20 + [k // 4 for k in range(20)]
    rows = [(d, t, "en", "ab"[k % 2], len(t)) for k, (d, t) in enumerate(zip(ids, texts))]
    rows += [rows[0]] * 3 + [(7, None, "en", "a", None), (-1, texts[0], "en", "a", 1)]
    df = spark.createDataFrame(rows, corpus_pipeline.SCHEMA)
    df.write.parquet(f"{tmp_path}/documents.parquet")
    got = mixing.query(spark, str(tmp_path)).collect()
    assert len(got) == len(rows) and all(r.taken <= 3 * r.size for r in got)
    size = lambda r: len((r[1] or "").split())
    for s in "ab":
        own = [r for r in got if r.source_size == sum(size(q) for q in rows if q[3] == s)]
        assert len(own) == sum(q[3] == s for q in rows) and sum(r.taken for r in own) == pytest.approx(own[0].target, rel=0.05)
    mixed = corpus_pipeline.mixed(spark, df, "").collect()
    assert sum(size(r) for r in mixed) == sum(r.taken for r in got)
    assert Counter(r.doc_id for r in mixed)[None] > 0
    count = Counter((q[0], w) for q in rows for w in (q[1] or "").split())
    assert all(n <= 3 * count[k] for k, n in Counter((r.doc_id, w) for r in mixed for w in r.text.split()).items())


def test_pipeline_groups_keep_texts_of_one_id(spark):
    common.ship(spark)
    a, b, c = (prose(k, 100) for k in (1, 2, 3))
    rows = [(1, a), (1, b), (1, b), (5, b + " end"), (6, c), (7, c), (7, a), (None, a), (None, a), (8, None), (9, None)]
    df = spark.createDataFrame([(i, t, "en", "s", None) for i, t in rows], corpus_pipeline.SCHEMA)
    got = corpus_pipeline.one_of_each_group(spark, df, "").collect()
    assert Counter((r.doc_id, r.text) for r in got) == Counter([(1, a), (1, b), (6, c), (None, a), (None, a), (8, None), (9, None)])


def test_mixing_small_sources(spark):
    common.ship(spark)
    texts = [prose(k, n) for k, n in enumerate([40] * 12 + [1, 64, 65, 500])]
    mix = mixing.Mix(docs(spark, texts, {k: f"s{k:02}" for k in range(len(texts))}))
    taken = defaultdict(int)
    for r in mixing._taken(mix).collect():
        taken[r.doc_id] += r.times * r.words
    assert [s["size"] for s in mix.sources[:12]] == [40] * 12
    for k, s in enumerate(mix.sources):
        assert taken[k] == pytest.approx(s["target"], abs=s["block_words"])


def test_language(spark):
    common.ship(spark)
    got = {r.doc_id: r for r in langid.query(spark, D).collect()}
    known = {r.doc_id: r.lang for r in common.table(spark, D, "documents").collect()}
    held = [i for i in known if zlib.crc32(str(i).encode()) % 4 == 2]
    assert all(got[i].held_out for i in held) and sum(got[i].lang_pred == known[i] for i in held) >= 0.95 * len(held)
    names, p = langid.fit(docs(spark, ["abc def", "xyz zyx"]))
    out = langid.predict(docs(spark, [*ODD, "12 !"]).withColumn("held_out", F.lit(False)), names, p).collect()
    assert [r.lang_pred for r in sorted(out, key=lambda r: r.doc_id)][:3] == ["und"] * 3 and all(0 <= r.score <= 1 for r in out)
    assert langid.fit(docs(spark, []))[0] == []


def test_quality(spark):
    got = {r.doc_id: r for r in registry.QUERIES["op9_quality_classifier"](spark, "/root/testdata/sf0.01").collect()}
    labels = {r.doc_id: r.quality for r in common.table(spark, "/root/testdata/sf0.01", "labels").collect()}
    held = [i for i in labels if got[i].held_out]
    assert sum(got[i].predicted == labels[i] for i in held) >= 0.9 * len(held)
    empty = quality.fit(docs(spark, ODD), spark.createDataFrame([], "doc_id long, quality int"))
    assert {r.score for r in quality.score(docs(spark, ODD), empty).collect()} == {0.5}


def test_chat_odd_rows(spark):
    rows = [(1, 0, None, None), (1, 0, "user", "a:b#<\\"), (1, 2, "user", "</turn>### x: "), (1, 3, "assistant", ""), (None, 1, "assistant", "ß\\l")]
    out = chat.format_conversations(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).withColumn("back", chat.read_back(F.col("formatted")))
    got = {r.conv_id: [(t.role, t.text) for t in r.back] for r in out.collect()}
    assert got == {1: [("", ""), ("user", "a:b#<\\"), ("user", "</turn>### x: "), ("assistant", "")], None: [("assistant", "ß\\l")]}
    assert out.where("false").count() == 0


def test_pipeline_stages(spark):
    texts = [prose(i, 200) for i in range(12)] + [prose(3, 200), None, ""]
    x = docs(spark, texts)
    kept = corpus_pipeline.one_of_each_group(spark, x, D)
    assert kept.columns == corpus_pipeline.COLUMNS and {r.doc_id for r in kept.collect()} == set(range(15)) - {12}
    assert corpus_pipeline.without_repeats(spark, x, D).where("doc_id in (3, 12)").select("text").distinct().collect() == [("",)]
    assert corpus_pipeline.mixed(spark, x, D).columns == corpus_pipeline.COLUMNS


def test_a_shard_is_searched_in_little_memory():
    """a posting takes under 6 bytes of a packed shard, and under 40 while a task makes the shard that it searches."""
    rng = np.random.default_rng(5)
    vocabulary = np.unique(rng.integers(-(2**62), 2**62, 3000))
    docs = [(i, np.sort(rng.choice(vocabulary, 1000, replace=False)), rng.integers(1, 9, 1000)) for i in range(400)]
    row = search.packed(docs, len(docs))
    assert sum(len(v) for v in row.values() if isinstance(v, bytes)) < 6 * 400_000
    tracemalloc.start()
    shard = search.Shard(row, 4000.0)
    peak = tracemalloc.get_traced_memory()[1] - shard.parts.nbytes
    tracemalloc.stop()
    assert peak < 40 * 400_000
