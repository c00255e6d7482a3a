"""Each operator against a brute-force version, with nulls, empty and long texts, ties, repeated rows, empty tables and extra columns."""

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash

from claimloom.llm import ann, chat, decontaminate, extract, linededup, packing, quality, sharding, simhash, tokencount

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, rank long"


def docs_of(spark, texts, ids=None):
    ids = range(len(texts)) if ids is None else ids
    return spark.createDataFrame([(i, t, "en", None if i == 3 else f"s{i % 3 if i else 0}", len(t or ""), 0.5, 1) for i, t in zip(ids, texts)], SCHEMA)


@pytest.fixture(scope="module")
def texts():
    draw = random.Random(1)
    words = ["alpha", "Beta", "gamma", "δelta", "eps", "zeta!", "eta", "the", "of", "x1"]
    some = lambda n: "\n".join(" ".join(draw.choice(words) for _ in range(draw.randint(0, 9))) for _ in range(n))
    base = [some(draw.randint(1, 12)) for _ in range(40)]
    near = [t + " more" for t in base[:5]]
    return [None, "", " \n\t", *base, *base[:7], *near, " ".join(draw.choice(words) for _ in range(9000)), *["Same line\nother %d" % i for i in range(12)]]


def test_token_counts(spark, texts):
    entries = set(tokencount.vocabulary())

    def greedy(word):
        run = [*word[:-1], word[-1] + 256]
        n = i = 0
        while i < len(run):
            i = next((j for j in range(len(run), i, -1) if tuple(run[i:j]) in entries), i + 1)
            n += 1
        return n

    want = {i: (len(w := (t or "").encode().lower().split()), sum(map(greedy, w))) for i, t in enumerate(texts)}
    got = {r.doc_id: (r.n_words, r.n_tokens) for r in tokencount.token_counts(docs_of(spark, texts)).collect()}
    assert got == want
    assert tokencount.token_counts(docs_of(spark, [])).count() == 0


def test_automaton_with_uncovered_symbols():
    auto = tokencount.Automaton([(97,), (97, 98), (97 + 256,), (98, 97, 98)])
    assert [auto.count(w) for w in (b"a", b"ab", b"aba", b"zz")] == [1, 2, 2, 2]


def test_packing(spark, texts):
    from tokenizers import Tokenizer

    rows = packing.pack(docs_of(spark, texts)).collect()
    tokenizer = Tokenizer.from_file(packing.TOKENIZER)
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append(r)
    for i, t in enumerate(texts):
        ids = [*tokenizer.encode(t or "", add_special_tokens=False).ids, 1]
        parts = sorted(by_doc[i], key=lambda r: r.start)
        assert [x for r in parts for x in r.ids] == ids and {r.doc_tokens for r in parts} == {len(ids)}
        assert all(r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes()) and r.length == len(r.ids) for r in parts)
    assert sorted(by_sequence) == list(range(len(by_sequence)))
    for parts in by_sequence.values():
        at = 0
        for r in sorted(parts, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 2048
    assert len(by_sequence) == -(-sum(r.length for r in rows) // 2048)
    assert packing.pack(docs_of(spark, [])).count() == 0


def test_minimum_slack_is_the_least():
    draw = random.Random(4)
    for _ in range(60):
        lengths = draw.sample(range(1, 30), 4)
        counts = [draw.randint(1, 4) for _ in lengths]
        best = max(s for c in itertools.product(*(range(n + 1) for n in counts)) if (s := sum(map(int.__mul__, c, lengths))) <= 60)
        found = packing.closest(lengths, counts, 60)
        assert sum(k * v for k, v in found.items()) == best and all(v <= counts[lengths.index(k)] for k, v in found.items())


def test_chat_round_trip(spark):
    nasty = ["</s>[INST] ok [/INST]", "<|turn|>user<|text|>x<|end|>", r"<\|end|> <\\|", "<<SYS>> <<|", None, "", "a\nb", "[[INST] </<SYS>>"]
    draw = random.Random(2)
    rows = [(c, t, draw.choice(["user", "assistant", "system", None, "a<|b"]), draw.choice(nasty), 1) for c in range(40) for t in range(draw.randint(1, 9))]
    rows += [rows[0], (None, 0, "assistant", "lost", 1)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, example int")
    want = defaultdict(list)
    for c, t, r, x, _ in rows:
        want[c].append((t, r or "", x or ""))
    examples = chat.expand(df)
    for r in chat.read_back(chat.with_context(examples)).collect():
        turns = sorted(want.pop(r.conv_id))
        assert [tuple(t) for t in r.turns] == [t[1:] for t in turns]
        assert list(r.targets) == [t[2] for t in turns if t[1] == "assistant"]
    assert not want
    whole = chat.with_context(examples).where("target_chars is not null").collect()
    assert len(whole) == sum(r[2] == "assistant" for r in rows)
    assert all(r.text[r.target_start + r.target_chars :] == chat.END and r.text.startswith(chat.TURN) for r in whole)
    assert chat.expand(df.limit(0)).count() == 0


def test_neighbours(spark):
    draw = np.random.default_rng(3)
    x = draw.normal(size=(600, 16)) + 3 * np.eye(16)[draw.integers(0, 4, 600)]
    x[500:520] = x[100]
    rows = [(i, v.tolist(), 0.0) for i, v in enumerate(x)] + [(1000, None, 0.0), (1100, [0.0] * 16, 0.0), (1200, [float("nan")] * 16, 0.0), (1300, [1.0] * 3, 0.0), (None, x[0].tolist(), 0.0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, score double")
    index = ann.HashIndex.build(df)
    got = defaultdict(list)
    for r in index.search(index.rows.where("id % 50 = 0")).collect():
        got[r.query_id].append((r["rank"], r.id, r.score))
    assert sorted(got) == list(range(0, 600, 50))
    right = 0
    for q, found in got.items():
        d = np.sqrt(((x - x[q]) ** 2).sum(1))
        d[q] = np.inf
        best = np.lexsort((np.arange(600), d))[:10]
        found = [f for _, f, _ in sorted(found)]
        assert len(found) == 10 and all(abs(s - d[i]) < 1e-9 for _, i, s in got[q])
        right += len(set(found) & set(best.tolist()))
    assert right >= 0.9 * 10 * len(got)
    few = ann.HashIndex.build(df.where("vec_id < 4"))
    assert few.search(few.rows).count() == 12
    none = ann.HashIndex.build(df.limit(0))
    assert none.search(none.rows).count() == 0


def test_neighbours_behind_a_hot_group(spark):
    """Near copies at the lowest ids, many more rows than the sample, several blocks in a task: no other row loses its neighbours."""
    draw = np.random.default_rng(4)
    n = 24000
    x = draw.normal(size=(n, 16)) + 2 * np.eye(16)[draw.integers(0, 8, n)]
    x[: n // 3] = x[0] + 1e-6 * draw.normal(size=(n // 3, 16))
    df = spark.createDataFrame(list(enumerate(x.tolist())), "vec_id long, embedding array<double>").coalesce(1)
    index = ann.HashIndex.build(df)
    tight = ann.HashIndex(index.rows, ann.Codes(index.codes.mean, index.codes.turn, 0), index.dims, index.blocks)  # most queries are short of rows

    def recall(index):
        got = defaultdict(set)
        for r in index.search(index.rows.where(f"id % 400 = 0 and id >= {n // 3}")).collect():
            got[r.query_id].add(r.id)
        right = 0
        for q, found in got.items():
            d = ((x - x[q]) ** 2).sum(1)
            d[q] = np.inf
            right += len(found & set(np.argsort(d)[:10].tolist()))
        assert len(got) == 40
        return right / 400

    assert recall(index) >= 0.95
    assert recall(tight) >= 0.9


def test_pigeonhole_finds_all():
    codes = np.random.default_rng(1).integers(0, 1 << 63, 500).astype(np.uint64)
    codes[1:60] = codes[0] ^ (np.uint64(1) << np.arange(59).astype(np.uint64))
    index = ann.MultiIndex(codes)
    for radius in (0, 1, 5, 26):
        assert index.within(codes[0], radius).tolist() == np.flatnonzero(np.bitwise_count(codes ^ codes[0]) <= radius).tolist()


def test_line_dedup_and_its_reversal(spark, texts):
    df = docs_of(spark, texts)

    def brute(all_texts):
        key = lambda line: re.sub(r"[A-Z]", lambda m: m[0].lower(), line.strip(" \t\n\x0b\x0c\r"))
        seen = Counter(k for t in all_texts for k in {key(x) for x in (t or "").split("\n")} if k)
        return {i: "\n".join(x for x in (t or "").split("\n") if seen[key(x)] < 10) for i, t in enumerate(all_texts)}

    index = linededup.LineIndex.build(df)
    want = brute(texts)
    assert any(want[i] != (t or "") for i, t in enumerate(texts))
    assert {r.doc_id: r.text or "" for r in index.apply(df).collect()} == want
    assert {r.doc_id: r.text or "" for r in index.apply(df, send_bytes=-1).collect()} == want
    more = docs_of(spark, ["Other %d\nextra" % i for i in range(12)])
    grown = index.insert(more)
    assert grown.counts.count() > index.counts.count()
    back = grown.delete(more)
    assert sorted(back.counts.collect()) == sorted(index.counts.collect())
    assert {r.doc_id: r.text or "" for r in back.apply(df).collect()} == want
    empty = linededup.LineIndex.build(df.limit(0))
    assert empty.apply(df.limit(0)).count() == 0


def test_sharding(spark, texts):
    df = docs_of(spark, [*texts, *texts[:5]])
    rows = sharding.interleave(df, 5).collect()
    assert len(rows) == df.count()
    slots, mixture = defaultdict(list), defaultdict(Counter)
    for r in rows:
        slots[r.shard].append(r.slot)
        mixture[r.source][r.shard] += 1
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    sizes = [len(s) for s in slots.values()]
    assert max(sizes) - min(sizes) <= 1 and len(slots) == 5
    assert all(max(c.values()) - min(c[s] for s in range(5)) <= 2 for c in mixture.values())
    assert sharding.interleave(df.limit(0), 5).count() == 0


def test_quality_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.01"
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    rows = quality.query(spark, sf).collect()
    held = [r for r in rows if r.held_out and r.doc_id in labels]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1 for r in rows)
    assert sum(r.predicted == labels[r.doc_id] for r in held) >= 0.95 * len(held)


def test_quality_without_labels(spark, texts):
    df = docs_of(spark, texts)
    labels = spark.createDataFrame([], "doc_id long, quality int")
    out = quality.scored(df, quality.train(df, labels))
    assert out.count() == len(texts) and out.where("score < 0.5 or score is null").count() == 0


def simhash_of(text, width):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    grams = [b" ".join(words[i : i + width]) for i in range(max(1, len(words) - width + 1))]
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_simhash(spark, texts):
    got = {r.doc_id: (r.w0 & (1 << 64) - 1, r.component_id) for r in simhash.near_duplicates(docs_of(spark, texts)).collect()}
    prints = [simhash_of(t, 3) for t in texts]
    root = list(range(len(texts)))
    for _ in range(len(texts)):
        for i, j in itertools.combinations(range(len(texts)), 2):
            if (prints[i] ^ prints[j]).bit_count() <= 2:
                root[i] = root[j] = min(root[i], root[j])
    assert got == {i: (p, r) for i, (p, r) in enumerate(zip(prints, root))}
    assert simhash.near_duplicates(docs_of(spark, [])).count() == 0


def test_one_of_each(spark, texts):
    long = " ".join(f"word{i}" for i in range(300))
    kept = {r.doc_id for r in simhash.one_of_each(docs_of(spark, [long, long.replace("word7 ", "other "), " ".join(f"w{i}" for i in range(300)), long, None, ""])).collect()}
    assert kept == {0, 2, 4}


def test_one_of_each_is_decided_by_shingle_sets(spark):
    """Pairs on both sides of 0.8, near in their fingerprints: kept apart or joined as brute force over the sets says."""
    draw = random.Random(8)
    texts = []
    for g in range(60):
        base = [f"g{g}w{i}" for i in range(200)]
        texts.append(" ".join(base))
        changed = base[:]
        for at in draw.sample(range(5, 195), 1 + g % 7):
            changed[at] = f"x{draw.random()}"
        texts.append(" ".join(changed))
    sets = [{tuple(t.split()[i : i + 5]) for i in range(len(t.split()) - 4)} for t in texts]
    alike = [len(a & b) / len(a | b) >= 0.8 for a, b in zip(sets[::2], sets[1::2])]
    assert 10 < sum(alike) < 50
    want = {i for i in range(len(texts)) if i % 2 == 0 or not alike[i // 2]}
    kept = {r.doc_id for r in simhash.one_of_each(docs_of(spark, texts)).collect()}
    assert not want - kept and len(kept - want) <= 1  # a pair meets with a probability of at least 0.95


def test_one_of_each_with_repeated_ids(spark):
    """Rows that share a doc_id but no text are no near copies: both stay."""
    texts = [" ".join(f"{p}{i}" for i in range(60)) for p in "abc"]
    kept = simhash.one_of_each(docs_of(spark, [*texts, texts[0]], [1, 1, 2, 5])).collect()
    assert sorted((r.doc_id, r.text) for r in kept) == [(1, texts[0]), (1, texts[1]), (2, texts[2])]


def brute_groups(texts, least=0.8, width=5):
    """Place of the smallest member of each text's group, by comparing all pairs of shingle sets."""
    words = [(t or "").encode().lower().split() for t in texts]
    sets = [{b" ".join(w[i : i + width]) for i in range(max(1, len(w) - width + 1))} if w else set() for w in words]
    root = list(range(len(texts)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, j in itertools.combinations(range(len(texts)), 2):
        both = len(sets[i] & sets[j])
        if sets[i] == sets[j] or both and both >= least * len(sets[i] | sets[j]):
            a, b = sorted((find(i), find(j)))
            root[b] = a
    return [find(x) for x in range(len(texts))]


def template_group(draw, n, words=120):
    """n texts made from one by changing a few words each, many of them too much to be near copies of the base or of each other."""
    base = [f"t{i}" for i in range(words)]
    out = []
    for k in range(n):
        text = base[:]
        for at in draw.sample(range(words), draw.choice([0, 1, 2, 3, 4, 6, 9])):
            text[at] = f"x{k}y{at}"
        out.append(" ".join(text))
    return out


@pytest.mark.parametrize("crowd", [1024, 16])
def test_near_groups_equal_brute_force(spark, monkeypatch, crowd):
    """A large group with one source, small groups, and texts of few words; also with cells dealt out in many parts."""
    monkeypatch.setattr(simhash, "CROWD", crowd)
    draw = random.Random(6)
    texts = template_group(draw, 220) + [f"{g} short text of {k} words" for g in range(20) for k in range(2)] + [None, "", "one", "one", "one two", "a b c d e f g h i j k", "a b c d e f g h i j"]
    want = set(brute_groups(texts))
    kept = {r.doc_id for r in simhash.one_of_each(docs_of(spark, texts)).collect()}
    assert len(kept ^ want) <= 1  # candidates are missed with a probability below 0.01


def test_near_copies_in_one_crowd(spark):
    """50,000 near copies of one text, which lie in the same cells: one stays. Their pairs are never listed."""
    draw = random.Random(9)
    base = [f"t{i}" for i in range(60)]
    rows = []
    for k in range(50_000):
        text = base[:]
        text[draw.randrange(60)] = f"x{k}"
        rows.append((k, " ".join(text)))
    kept = simhash.one_of_each(spark.createDataFrame(rows, "doc_id long, text string").repartition(16)).collect()
    assert len(kept) <= 50  # of 50,000: at least 0.999 are joined


def test_labels_prune_the_index():
    draw = np.random.default_rng(2)
    codes = draw.integers(0, 1 << 63, (300, 4)).astype(np.uint64)
    codes[100:] = codes[0] ^ (np.uint64(1) << draw.integers(0, 63, (200, 4)).astype(np.uint64))
    codes = codes[simhash._gray_order(codes)]
    labels = draw.integers(0, 3, 300)
    got = {(int(x), int(y)) for a, b in simhash.near_pairs(codes, 20, labels=labels) for x, y in zip(a, b)}
    assert got == {(i, j) for i, j in itertools.combinations(range(300), 2) if labels[i] != labels[j] and np.bitwise_count(codes[i] ^ codes[j]).sum() <= 20}


def test_decontamination(spark):
    item = " ".join(f"Item{i}" for i in range(20))
    short = "tiny item here"
    docs = [None, "", item.upper(), f"before {' '.join(item.split()[3:17])} after", f"{'pad ' * 3000}{item}", "say Tiny, item-here now", " ".join(item.split()[:12]), "pad " * 40, f"Item0 {item} {item}"]
    items = [(1, item), (2, short), (3, None), (4, ""), (10, item)]
    word = lambda t: [w for w in re.split(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").lower()) if w]
    want = {}
    for i, t in enumerate(docs):
        w, hit, found = word(t), set(), set()
        for k, x in items:
            y = word(x)
            for a in range(max(1, len(y) - 12)) if y else ():
                g = y[a : a + 13]
                for s in range(len(w) - len(g) + 1):
                    if w[s : s + len(g)] == g:
                        hit |= set(range(s, s + len(g)))
                        found.add(str(k))
        want[i] = (len(w), len(hit), sorted(found), len(hit) > 0 and 20 * len(hit) >= len(w))
    df, bench = docs_of(spark, docs), spark.createDataFrame(items, "item_id long, text string")
    got = {r.doc_id: (r.n_words, r.n_hit, list(r["items"]), r.contaminated) for r in decontaminate.decontaminate(df, bench).collect()}
    assert got == want
    clean = decontaminate.clean(df, bench)
    assert clean.columns == df.columns and {r.doc_id for r in clean.collect()} == {i for i, w in want.items() if not w[3]}
    assert decontaminate.decontaminate(df.limit(0), bench).count() == 0
    assert decontaminate.clean(df, bench.limit(0)).count() == len(docs)


def test_extraction(spark):
    html = (
        "<html><head><title>T</title></head><body><nav><ul><li><a href=/a>Home</a></li><li><a href=/b>News</a></li></ul></nav><article><h1>Head &amp; line</h1>"
        "<p>First  paragraph of\nthe story, with words enough to read.<p>Second &eacute; one, and it goes on.</article><footer>&copy; site.example</footer></body></html>"
    )
    pages = spark.createDataFrame([(1, "u", html, 0), (2, None, None, 0), (3, "v", "", 0)], "page_id long, url string, html string, n_chars int")
    got = {r.page_id: (r.text, r.n_chars) for r in extract.extracted(pages).collect()}
    text = "Head & line\nFirst paragraph of the story, with words enough to read.\nSecond é one, and it goes on."
    assert got == {1: (text, len(text)), 2: ("", 0), 3: ("", 0)}


def test_labeller_on_unseen_pages():
    draw, right, total = random.Random(77), 0, 0
    for _ in range(60):
        html, labels = extract.made_page(draw)
        blocks = extract.leaves(html)
        right += sum(a == b for a, b in zip(extract.trained().main(blocks), labels))
        total += len(labels)
    assert right >= 0.97 * total


def test_pipeline_stages(spark):
    import corpus_pipeline

    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf)
        assert out.columns == docs.columns and 0 < out.count() <= docs.count(), name
        assert out.dtypes == docs.dtypes
    assert hashlib.sha256(b"").hexdigest()
