"""Operators without SQL against plain versions, and odd tables for all ten operators and five stages."""

from collections import Counter, defaultdict

import numpy as np
import pytest

import corpus_pipeline
from lymphora.llm import bpe, common, html, langid, mixing, quality, registry

from test_operators import DOC, ODD, docs, prose


def test_mixing_against_brute_force(spark):
    common.ship(spark)
    texts = [prose(k, 40 + 13 * (k % 17)) for k in range(50)] + ODD
    mix = mixing.Mix(docs(spark, texts, {k: ["a", "b", "c", None][k % 4] for k in range(len(texts))}))
    rows = [r for r in mix.sizes.collect() if r["size"]]
    total, slots = sum(s["quota"] for s in mix.sources), []
    for shard in range(-(-total // mixing.SHARD)):
        p = np.array([s["quota"] for s in mix.sources]) / total
        counts = np.random.default_rng([mixing.SEED, shard]).multinomial(min(mixing.SHARD, total - shard * mixing.SHARD), p)
        slots += [s for s, n in enumerate(counts) for _ in range(n)]
    got = Counter(slots)
    numbers = [(s, k) for s in range(len(mix.sources)) for k in range(min(got[s], mix.sources[s]["quota"]))]
    spare = sum(max(0, got[s] - mix.sources[s]["quota"]) for s in range(len(mix.sources)))
    lacking = [(s, k) for s, x in enumerate(mix.sources) for k in range(got[s], x["quota"])]
    assert spare == len(lacking)
    times = Counter()
    for s, k in numbers + lacking:
        n = mix.sources[s]["blocks"]
        times[s, int(mixing.permuted(np.array([k % n]), n, mixing.SEED * 1_000_003 + s)[0])] += 1
    want = Counter()
    for s in mix.sources:
        at = 0
        for r in sorted((r for r in rows if r["source"] == s["source"]), key=lambda r: (r["chunk"], r["doc_id"])):
            for word in range(r["size"]):
                want[r["doc_id"]] += times[s["no"], (at + word) // s["block_words"]]
            at += r["size"]
    found = defaultdict(int)
    for r in mixing._taken(mix).collect():
        found[r["doc_id"]] += r["times"] * r["words"]
    assert dict(found) == {k: n for k, n in want.items() if n}


def test_votes_against_brute_force():
    texts = [prose(k, 30 + k) if k % 2 else prose(k, 30 + k).upper() + "!!! ###" for k in range(80)]
    label = np.arange(80) % 2
    model = quality.Model(quality.features(texts), label)
    asked = quality.features([prose(500 + k, 25 + k) for k in range(30)] + ODD)
    z = model.latent(asked).astype(np.float64)
    for row, score in zip(z, model.score(asked)):
        near = sorted(((float(np.dot(row, v.astype(np.float64))), int(q)) for v, q in zip(model.vectors, label)), key=lambda x: -x[0])[: quality.NEIGHBOURS]
        w = [max(c, 1e-6) ** 4 for c, _ in near]
        assert score == pytest.approx(sum(x * q for x, (_, q) in zip(w, near)) / sum(w), abs=2e-3)


def test_profiles_against_brute_force():
    texts = ["Ab c", "él  niño, 12 él", "", "12 !", "日本 日本", "x" * 50]
    for t, v in zip(texts, [row for _, rows in langid.profiles(texts) for row in rows]):
        letters = "".join(c if c.isalpha() else " " for c in t.lower()).split()
        text = "".join(f" {w}" for w in letters) + (" " if letters else "")
        want = np.zeros(langid.DIM)
        for k in range(len(text) - 2):
            bound = np.ones(langid.DIM)
            for place, c in enumerate(text[k : k + 3]):
                bound = bound * np.roll(langid.letter_vectors(np.array([ord(c)]))[0], 2 - place)
            want += bound
        assert v.tolist() == want.tolist()


PAGES = [
    ("<main><h1>A &lt;b&gt; &#x41;</h1><ul><li>one <i>two</i><li>three</ul><pre>x\n\n  y</pre><menu><li>no</menu></main><div class='comments'><p>me</p></div>", "A <b> A\none two\nthree\nx y"),
    ("<div id=content class='post has-sidebar'>" + "<p>" + "words and more words " * 12 + "</p><p>short end</p></div><div class=sidebar>Latest posts</div><footer>(c)</footer>", ("words and more words " * 12).strip() + "\nshort end"),
    ("<article><p>" + "first part " * 20 + "<div class='newsletter'>Sign up</div><table><tr><td>a<td>b</table><blockquote>quoted</blockquote></article><aside><p>" + "other " * 30 + "</p></aside>", ("first part " * 20).strip() + "\na\nb\nquoted"),
    ("<body><!-- c --><p>" + "plain page " * 20 + "<p hidden>secret<p>last &amp; least<script>if (a < b) x('</p>')</script></body>", ("plain page " * 20).strip() + "\nlast & least"),
    ("<article>" + "<b>" * 3000 + "deep text" + "</b>" * 3000 + "</article>", "deep text"),
]


@pytest.mark.parametrize("page, text", PAGES)
def test_marked_pages(page, text):
    assert html.main_text(page) == text


def test_bpe_of_long_words(spark, monkeypatch):
    import public_tokenizers as P
    import tiktoken

    enc = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=dict(bpe.load(P.path(bpe.VOCABULARY))), special_tokens={})
    rng = np.random.default_rng(3)
    words = ["日本語中文字" * 300, "".join(rng.choice(list("theing"), 2500)), "ab" * 900, "a" * 1501]
    c = bpe.Coder(bpe.load(P.path(bpe.VOCABULARY)), P.PATTERN)
    for rows in (20_000, bpe.ROWS):  # queries that end after a few steps
        monkeypatch.setattr(bpe, "ROWS", rows)
        c.known.clear()
        assert [(ids, raw) for ids, raw in c.encode(words)] == [(enc.encode_ordinary(w), w.encode()) for w in words]


EXTRA = {"documents": DOC, "pages": "page_id long, url string, html string, text string, lines int", "embeddings": "vec_id long, embedding array<float>, label int, class string, a long",
         "conversations": "conv_id long, turn long, role string, text string, k int, head string", "labels": "doc_id long, quality int, toxic int, text string"}
ROWS = {
    "documents": [(1, prose(1, 60), "en", "s", 3, 1, "x", 2)] * 2 + [(1, prose(2, 90), None, None, None, None, None, None), (None, prose(1, 60), "en", "s", 3, 1, "x", 2), (None, None, None, None, None, None, None, None), (20, "", "fr", "t", 0, 1, "x", 2), (40, "été 日本 " * 4000, "fr", "t", 0, 1, "x", 2), (40, None, "fr", "t", 0, 1, "x", 2)],
    "pages": [(1, "u", "<p>" + "word " * 40, "t", 1)] * 2 + [(None, None, None, None, None), (2, "u", "", "t", 1), (3, "u", "<article><p>" + "é " * 60_000, "t", 1)],
    "embeddings": [(1, [1.0, 0.0], 1, "c", 2)] * 2 + [(None, None, None, None, None), (2, [1.0, 0.1], 1, "c", 2), (3, [], 1, "c", 2)],
    "conversations": [(1, 0, "user", "a", 1, "h")] * 2 + [(None, None, None, None, None, None), (2, 1, "assistant", "x " * 30_000, 1, "h")],
    "labels": [(1, 1, 0, "x"), (1, 0, 0, "x"), (None, 1, 1, None), (40, None, None, None), (20, 0, 0, "y")],
}


@pytest.mark.parametrize("rows", [ROWS, {k: [] for k in ROWS}], ids=["odd", "empty"])
@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_odd_tables(spark, tmp_path, name, rows):
    """Nulls in any column, repeated rows, empty and long texts, extra columns with clashing names, empty tables."""
    for t, schema in EXTRA.items():
        spark.createDataFrame(rows[t], schema).write.parquet(f"{tmp_path}/{t}.parquet")
    got = registry.QUERIES[name](spark, str(tmp_path)).collect()
    if name.startswith("op5"):
        assert {r.conv_id for r in got} == {-7} | {r[0] for r in rows["conversations"]}
    elif name.startswith("op6"):
        assert {r.query_id for r in got} == ({40} if rows["documents"] else set())  # the row 20 has no words
    else:
        key = {"2": "pages", "7": "embeddings"}.get(name[2], "documents") if name[3] == "_" else "documents"
        assert Counter(r[0] for r in got) == Counter(r[0] for r in rows[key])


@pytest.mark.parametrize("rows", [ROWS, {k: [] for k in ROWS}], ids=["odd", "empty"])
def test_stages_of_odd_tables(spark, tmp_path, rows):
    common.ship(spark)
    spark.createDataFrame(rows["labels"], EXTRA["labels"]).write.parquet(f"{tmp_path}/labels.parquet")
    x = spark.createDataFrame(rows["documents"], DOC)
    ids = {r[0] for r in rows["documents"]}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, x, str(tmp_path))
        got = out.collect()
        assert {r.doc_id for r in got} <= ids
        if name != "tokens":
            assert out.columns == corpus_pipeline.COLUMNS
        if name in ("repeats", "tokens"):
            assert Counter(r.doc_id for r in got) == Counter(r[0] for r in rows["documents"])
        if name == "near_duplicates":
            assert Counter(r.doc_id for r in got) == (Counter({None: 2, 1: 2, 20: 1, 40: 2}) if ids else Counter())
        if name == "mixture":
            assert all(r.text for r in got)
