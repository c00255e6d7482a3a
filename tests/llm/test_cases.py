"""Nulls, ties, repeated rows, empty tables, clashing names, hostile inputs; and the parts that the operators' main tests don't reach."""

import itertools
import random
import time
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from claimloom.llm import ann, chat, decontaminate, extract, linededup, packing, quality, sharding, simhash, tokencount
from claimloom.llm.common import private, ranked

SF = "/root/testdata/sf0.001"
#: Names that operators give to columns of their own, private or not.
CLASHING = ["_doc", "_part", "_hit", "_keep", "_hash", "_rank", "_s", "_h", "_b", "_n", "_top", "_low", "_base", "_start", "_row", "_at", "_place", "_size", "shard", "slot", "score", "n_lines", "n_dropped", "rep", "cell", "mask", "label", "group", "rank", "id"]
CLASHING += ["__id", "__hash", "__doc", "__part", "__hit", "__score", "__lines", "__dropped", "__rank", "__bucket", "__mixed", "__stratum", "__at", "__shard", "___id"]


def clashing(spark, texts, ids=None):
    ids = list(range(len(texts))) if ids is None else ids
    df = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in zip(ids, texts)], "doc_id long, text string, lang string, source string, n_chars long")
    return df.withColumns({c: F.lit(k + 100).cast("long") for k, c in enumerate(CLASHING)})


def untouched(rows, but=()):
    return all(r[c] == k + 100 for r in rows for k, c in enumerate(CLASHING) if c not in but)


def test_private_names():
    assert private(["a", "__A", "___a"], "a") == "____a" and private([], "a") == "__a"


def test_clashing_names_survive_every_stage(spark):
    import corpus_pipeline

    item = " ".join(f"word{i}" for i in range(40))
    docs = clashing(spark, [item, None, "", "x\ny", *(f"some other text number {i} that is long enough to be kept apart " * 3 for i in range(5))])
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns and out.dtypes == docs.dtypes, name
        rows = out.collect()
        assert rows and untouched(rows), name
        assert stage(spark, docs.limit(0), SF).count() == 0
    assert packing.pack(docs).count() == 9
    rows = sharding.interleave(docs, 3, key=["doc_id"]).collect()
    assert untouched(rows, ("shard", "slot")) and sorted(r.shard for r in rows) == [0] * 3 + [1] * 3 + [2] * 3
    rows = quality.scored(docs, quality.fit(np.empty((0, len(quality.FEATURES))), np.empty(0, bool))).collect()
    assert untouched(rows, ("score",)) and all(r.score > 0.5 for r in rows)
    rows = linededup.LineIndex.build(docs).apply(docs).collect()
    assert untouched(rows, ("n_lines", "n_dropped"))
    assert tokencount.token_counts(docs).count() == 9 and simhash.near_duplicates(docs).count() == 9


def test_repeated_rows_and_null_ids(spark):
    texts, ids = ["a b c", "a b c", "a b c", None, "x y", "x y"], [1, 1, None, None, 2, 3]
    docs = clashing(spark, texts, ids)
    assert sorted(r.component_id for r in simhash.near_duplicates(docs).collect() if r.component_id is not None)[:3] == [1, 1, 1]
    kept = simhash.one_of_each(docs).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in kept) == [(False, 1), (False, 2), (True, 0), (True, 0)]
    bench = spark.createDataFrame([(1, "a b c"), (2, None)], "item_id long, text string")
    got = decontaminate.decontaminate(docs, bench).collect()
    assert sorted((r.n_words, r.n_hit) for r in got) == [(0, 0), (2, 0), (2, 0), (3, 3), (3, 3), (3, 3)]
    assert sorted(r.n_tokens for r in tokencount.token_counts(docs).collect())[0] == 0
    pieces = packing.pack(docs).collect()
    assert len(pieces) == 6 and Counter(r.doc_id for r in pieces)[1] == 2


# ---------------------------------------------------------------- packing


def test_pieces_at_the_window(spark):
    """Documents whose ids and separator fill windows exactly, or miss that by one."""
    texts = [" a" * n for n in (2046, 2047, 2048, 4095, 4096)]
    rows = packing.pack(clashing(spark, texts)).collect()
    by = defaultdict(list)
    for r in rows:
        by[r.doc_id].append((r.start, r.length, r.doc_tokens))
    assert [sorted(x[1] for x in by[i]) for i in range(5)] == [[2047], [2048], [1, 2048], [2048, 2048], [1, 2048, 2048]]
    assert len({r.sequence_id for r in rows}) == 8 or sum(r.length for r in rows) <= 2048 * len({r.sequence_id for r in rows})


# ---------------------------------------------------------------- neighbours


def test_neighbours_do_not_depend_on_partitions(spark):
    draw = np.random.default_rng(8)
    x = draw.normal(size=(900, 24))
    rows = list(enumerate(x.tolist()))
    ask = lambda df: sorted(map(tuple, (i := ann.HashIndex.build(df)).search(i.rows.where("id % 90 = 0")).collect()))
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert ask(df.coalesce(1)) == ask(df.orderBy(F.rand(3)).repartition(13))


def test_neighbours_of_odd_rows(spark):
    rows = [(0, [1.0, 0.0]), (0, [9.0, 0.0]), (1, [2.0, 0.0]), (2, [8.0, 0.0]), (2, [8.0, 0.0]), (3, [0.0, 0.0]), (4, [float("inf"), 1.0]), (5, [1.0, 0.0, 0.0]), (6, [1.0, 0.0, 1.0]), (7, [None, 1.0])]
    index = ann.HashIndex.build(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    got = defaultdict(list)
    for r in sorted(index.search(index.rows).collect()):
        got[r.query_id].append((r["rank"], r.id, r.score))
    assert got == {0: [(1, 1, 1.0), (2, 2, 1.0)], 1: [(1, 0, 1.0), (2, 2, 6.0)], 2: [(1, 0, 1.0), (2, 1, 6.0)], 5: [(1, 6, 1.0)], 6: [(1, 5, 1.0)]}


def test_recall_on_the_real_table(spark):
    sf = "/root/testdata/sf0.1"
    e = spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", "embedding").toPandas()
    x, ids = np.stack(e.embedding).astype(float), e.vec_id.to_numpy()
    index = ann.HashIndex.build(spark.read.parquet(f"{sf}/embeddings.parquet"))
    got = defaultdict(set)
    for r in index.search(index.rows.where("id % 20 = 0")).collect():
        got[r.query_id].add(r.id)
    right = 0
    for q, found in got.items():
        d = np.sqrt(((x - x[np.flatnonzero(ids == q)[0]]) ** 2).sum(1))
        right += len(found & set(ids[np.lexsort((ids, d))[1:11]].tolist()))
    assert right >= 0.95 * 10 * len(got) == 0.95 * 10 * 100


# ---------------------------------------------------------------- line dedup


def test_filters_overflow_split_and_refuse(spark, monkeypatch):
    lines = "\n".join(f"line {i}" for i in range(300))
    first = clashing(spark, [lines] * 10, [7] * 10)  # ten rows of one doc_id are ten documents
    index = linededup.LineIndex.build(first)
    assert {r.n_dropped for r in index.apply(first).collect()} == {300}
    more = clashing(spark, ["\n".join(f"other {i}" for i in range(3000))] * 10)
    grown = index.insert(more)  # ten times as many keys: the only filter overflows and is built anew
    assert grown.shards == 1 and {r.n_dropped for r in grown.apply(more).collect()} == {3000}
    monkeypatch.setattr(linededup, "SHARD_KEYS", 500)
    split = index.insert(more)
    assert split.shards == 7
    both = first.unionByName(more)
    for send in (linededup.SEND_BYTES, -1):
        assert sorted(r.n_dropped for r in split.apply(both, send_bytes=send).collect()) == [300] * 10 + [3000] * 10
    back = split.delete(more)
    assert sorted(back.counts.collect()) == sorted(index.counts.collect())
    with pytest.raises(ValueError, match="doesn't hold"):
        index.delete(more)


def test_one_very_long_line(spark):
    long = "x" * 2_000_000
    docs = clashing(spark, [long] * 10 + ["short", None])
    index = linededup.LineIndex.build(docs)
    for send in (linededup.SEND_BYTES, -1):
        got = {r.doc_id: (r.text, r.n_lines, r.n_dropped) for r in index.apply(docs, send_bytes=send).collect()}
        assert got == {i: ("", 1, 1) for i in range(10)} | {10: ("short", 1, 0), 11: (None, 1, 0)}


# ---------------------------------------------------------------- sharding


def test_interleaving_equals_brute_force(spark):
    draw = random.Random(3)
    rows = [(i, draw.choice(["a", "a", "a", "b", None])) for i in range(997)]
    df = spark.createDataFrame(rows, "doc_id long, source string")
    import hashlib

    mixed = lambda i: hashlib.md5(f"{sharding.SEED}|{i}".encode()).hexdigest()
    by = defaultdict(list)
    for i, s in rows:
        by[s].append(i)
    order = []
    for s, ids in by.items():
        for rank, i in enumerate(sorted(ids, key=mixed)):
            order.append(((rank + 0.5) / len(ids), mixed(i), "0" if s is None else f"1{s}", i))
    order.sort()
    want, n = {}, len(order)
    for at, (*_, i) in enumerate(order):
        shard = at * 5 // n
        want[i] = (shard, at - -(-shard * n // 5))
    assert {r.doc_id: (r.shard, r.slot) for r in sharding.interleave(df, 5, key=["doc_id"]).collect()} == want


def test_identical_rows_have_places_of_their_own(spark):
    df = spark.createDataFrame([(1, "s")] * 100, "doc_id long, source string")
    got = sorted((r.shard, r.slot) for r in sharding.interleave(df, 4).collect())
    assert got == [(k, i) for k in range(4) for i in range(25)]


def test_ranks_over_many_buckets(spark):
    df = spark.range(20_000).select(F.pmod("id", F.lit(3)).alias("g"), F.col("id").alias("b"))
    got = ranked(df, ["g"], "b", ["b"]).where(F.col("rank") != F.floor(F.col("b") / 3)).count()
    assert got == 0


# ---------------------------------------------------------------- quality


def test_fit_equals_gradient_descent():
    draw = np.random.default_rng(4)
    x = draw.normal(size=(80, 3))
    good = x @ [1.0, -2.0, 0.5] + draw.normal(size=80) > -0.5
    made = quality.fit(x, good, ridge=0.05)
    z = np.clip((x - made.mean) / made.scale, -8, 8)
    pick = np.random.default_rng(quality.SEED)
    bad = np.repeat(np.flatnonzero(~good), quality.CONTESTS)
    apart = z[pick.choice(np.flatnonzero(good), len(bad))] - z[bad]
    w = np.zeros(3)
    for _ in range(4000):
        w -= 0.5 * (0.05 * w - apart.T @ (1 / (1 + np.exp(apart @ w))) / len(apart))
    assert np.abs(w - made.weight).max() < 1e-5
    raw = np.sort(z @ made.weight)
    assert raw[(~good).sum() - 1] <= made.cut <= raw[(~good).sum()]
    assert (made.score(x) >= 0.5).sum() == good.sum()  # the quantile: as many above as there are good ones


def test_odd_labels(spark):
    docs = clashing(spark, [f"text {i}" for i in range(12)] + ["a", "b"], [*range(12), 50, 50])
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(12)] + [(0, 1, 0), (2, None, 0), (None, 1, 0), (4, 7, 0), (6, 0, 1), (6, 0, 0), (50, 1, 0), (99, 1, 0)], "doc_id long, quality int, toxic int")
    x, y = quality.labelled(docs, labels)
    usable = [i for i in [*range(1, 12), 50] if zlib.crc32(str(i).encode()) % 3 != 1]  # 0 has both labels
    assert len(x) == len(y) == len(usable)
    assert len(quality.labelled(docs, labels, bound=3)[0]) == 3
    assert quality.labelled(docs.limit(0), labels)[0].shape == (0, len(quality.FEATURES))


# ---------------------------------------------------------------- SimHash


def test_cells_above_their_size(spark):
    """More classes in a cell than CELL, ties and repeated codes: links equal brute force."""
    draw = np.random.default_rng(3)
    codes = np.unique(np.concatenate([np.uint64(5) << np.uint64(40) | draw.integers(0, 1 << 12, 700).astype(np.uint64), draw.integers(0, 1 << 62, 50).astype(np.uint64)]))
    classes = spark.createDataFrame([(i, int(c)) for i, c in enumerate(codes)], "rep long, w0 long")
    root = list(range(len(codes)))

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    near = np.bitwise_count(codes[:, None] ^ codes[None]) <= 2
    for i, j in zip(*np.where(np.triu(near, 1))):
        a, b = sorted((find(i), find(j)))
        root[b] = a
    joined = {r.node: r.component for r in simhash.components(simhash.exact_links(classes, 2)).collect()}
    assert all(joined.get(i, i) == find(i) for i in range(len(codes)))


# ---------------------------------------------------------------- decontamination


def test_positions_in_shuffled_joins_and_proximity(spark):
    draw = random.Random(5)
    vocabulary = [f"w{i}" for i in range(40)]
    docs = clashing(spark, [" ".join(draw.choices(vocabulary, k=60)) for _ in range(60)] + ["Mark one two three", None])
    items = [(k, " ".join(draw.choices(vocabulary, k=3))) for k in range(12)] + [(20, "one two three"), (21, "solo"), (22, "two x y z")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    rows = decontaminate.keyed(docs)
    index, shuffled = decontaminate.PositionalIndex(rows, bench), decontaminate.PositionalIndex(rows, bench, send_bytes=-1)
    texts = {r.doc_id: (r.text or "").lower().split() for r in docs.collect()}
    want = {(d, k, s) for d, w in texts.items() for k, t in items for s in range(len(w)) if w[s : s + len(t.split())] == t.split()}
    assert want
    for found in (index, shuffled):
        at = found.phrases().join(found.items, "window_id").collect()
        assert {(r.doc, r.item_id, r.start) for r in at} == want and len(at) == len(want)
    within = 3
    near = index.proximity(within).join(index.items, "window_id").join(index.windows.select("window_id", "term", "term2", "window"), "window_id").collect()
    got = {(r.doc, r.item_id, r.pos): r.share for r in near}
    want = {}
    for k, t in items:
        for r in index.windows.join(index.items, "window_id").where(F.col("item_id") == k).collect():
            for d, w in texts.items():
                for p, word in enumerate(w):
                    around = w[max(0, p - within) : p + within + 1]
                    others = [w[q] for q in range(max(0, p - within), min(len(w), p + within + 1)) if q != p]
                    if word == r.term and r.term2 in others and len(r.window) > 1:
                        want[d, k, p] = len(set(r.window) & set(around)) / len(set(r.window))
    assert got == pytest.approx(want) and want


# ---------------------------------------------------------------- extraction


def test_hostile_pages_take_linear_time():
    pages = {
        "deep": "<div>" * 6000 + "<p>x</p></i>" * 6000, "inline": "<b>" * 6000 + "<p>x" * 6000, "less": "<" * 100_000, "comments": "<!--" * 50_000, "tags": "<a " * 50_000,
        "quotes": "<p a=\"" * 30_000, "declared": "<![x[" * 30_000, "ends": "</" * 100_000, "references": "&" * 200_000, "scripts": "<script>" * 30_000,
    }
    model = extract.trained()
    for name, html in pages.items():
        began = time.time()
        extract.main_text(html, model)
        assert time.time() - began < 5, name


def test_long_page_and_repeated_rows(spark):
    words = " ".join(f"word{i % 97}" for i in range(200))
    html = "<html><body><nav><ul><li><a href=/>Home</a></li></ul></nav><article><h1>Long one</h1>" + f"<p>{words}.</p>" * 3000 + "</article><footer>&copy; site</footer></body></html>"
    pages = spark.createDataFrame([(1, "u", html), (1, "u", html), (None, "u", "<p"), (2, "u", "plain &lt;text&gt;")], "page_id long, url string, html string")
    got = extract.extracted(pages).collect()
    long = [r for r in got if r.page_id == 1]
    assert len(got) == 4 and len(long) == 2 and long[0] == long[1] and long[0].text == "Long one\n" + "\n".join([words + "."] * 3000)
    assert extract.extracted(pages.limit(0)).count() == 0


def test_extracted_equals_the_articles(spark):
    """All pages of a test table: the text of their article element, taken out by position in the page."""
    import re
    from html import unescape

    def article(html):
        inner = re.search(r"<article.*?</article>", html, re.S)[0]
        inner = re.sub(r"(?s)<(aside|nav|form|script|style|footer|header)\b.*?</\1>", "<p>", inner)
        blocks = re.split(r"</?(?:p|h\d|li|ul|ol|blockquote|div|article|pre|section)\b[^>]*>", inner)
        plain = [unescape(re.sub(r"<[^>]+>", "", re.sub(r"<br\b[^>]*>", " ", b))) for b in blocks]
        return "\n".join(t for p in plain if (t := " ".join(p.split())))

    pages = [r for r in spark.read.parquet(f"{SF}/pages.parquet").collect() if r.html and "<article" in r.html]
    got = extract.main_texts([r.html for r in pages], extract.trained())
    same = sum(a == article(r.html) for a, r in zip(got, pages))
    assert len(pages) >= 40 and same >= 0.9 * len(pages)


# ---------------------------------------------------------------- chat


def test_examples_hold_their_contexts(spark):
    rows = [(1, 0, "system", "s"), (1, 1, "user", "u"), (1, 2, "assistant", "a<|end|>"), (1, 3, "user", "v"), (1, 4, "assistant", None), (1, 5, "user", "rest"), (2, 0, "user", "only")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {(r.conv_id, r.example): r for r in chat.with_context(chat.expand(df)).collect()}
    assert sorted(got) == [(1, 0), (1, 1), (1, 2), (2, 0)]
    assert got[1, 1].text.startswith(got[1, 0].text) and got[1, 1].target_chars == 0 and got[1, 2].target_chars is None
    one = got[1, 0]
    assert one.text[one.target_start : one.target_start + one.target_chars] == "a<\\|end|>"
    back = {r.conv_id: r for r in chat.read_back(chat.with_context(chat.expand(df))).collect()}
    assert back[1].n_examples == 2 and [tuple(t) for t in back[1].turns] == [(r, t or "") for c, _, r, t in rows if c == 1] and back[2].targets == []


def test_pipeline_equals_its_parts(spark):
    """The whole run on the smallest table: what brute force keeps, stage after stage."""
    import corpus_pipeline

    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    scores = {r.doc_id: r.predicted for r in quality.query(spark, SF).collect()}
    docs = [(i, t) for i, t in docs if scores[i]]
    key = lambda line: "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line.strip(" \t\n\x0b\x0c\r"))
    seen = Counter(k for _, t in docs for k in {key(x) for x in (t or "").split("\n")} if k)
    docs = [(i, t if t is None else "\n".join(x for x in t.split("\n") if seen[key(x)] < 10)) for i, t in docs]
    docs.sort()
    from test_operators import brute_groups

    groups = brute_groups([t for _, t in docs])
    docs = [d for k, d in enumerate(docs) if groups[k] == k]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    dirty = {r.doc_id for r in decontaminate.decontaminate(df, spark.read.parquet(f"{SF}/benchmark.parquet")).where("contaminated").collect()}
    want = {i for i, _ in docs if i not in dirty}
    assert {r.doc_id for r in corpus_pipeline.run(spark, SF).collect()} == want
