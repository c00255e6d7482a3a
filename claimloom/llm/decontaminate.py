"""Benchmark decontamination by a distributed positional inverted index, in DataFrame operations only.

A window is a run of WINDOW words of a benchmark item (an item with fewer is one window). The search for windows
works like phrase search in a positional index:

1. Occurrences of all benchmark terms are counted over the whole corpus. A window with a term that occurs
   nowhere can't occur itself.
2. Posting lists (document, term, position) are stored for the two rarest terms of each window that is left. A posting of a window's rarest term
   also holds the words around it, as far as a window may reach, so that no text is read or shuffled again.
3. The lists of the two terms are moved by their offsets in the window and intersected: joined on document, pair of terms and moved position. What is left is
   compared with all words of the windows: exact phrases. For proximity matches, the same lists are joined by near positions instead.

Windows that slide over the same two terms share the pair, and so one intersection. The benchmark's terms are broadcast after a check of their size; beyond SEND_BYTES the same joins are
shuffled ones, with the counts aggregated before.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from claimloom.llm.common import materialise, private, table

WINDOW = 13
#: Share of hit words from which a document is contaminated: 20 * n_hit >= n_words.
SHARE = 20
#: ASCII that is neither a digit nor a letter separates words.
SEPARATORS = r"[\x00-/:-@\[-`{-\x7F]+"
EDGES = "".join(chr(c) for c in range(128) if not chr(c).isalnum())
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Bytes of terms that may be broadcast.
SEND_BYTES = 64 << 20


def words_of(text: Column) -> Column:
    """The words of a text in their own case; none for null."""
    bare = F.trim(F.coalesce(text, F.lit("")), F.lit(EDGES))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, SEPARATORS))


def folded(word: Column) -> Column:
    """A-Z lower-cased, and nothing else."""
    return F.translate(word, UPPER, LOWER)


def windows_of(benchmark: DataFrame, width: int = WINDOW) -> DataFrame:
    """(window, item_id): each distinct window as an array of words, with the items that have it."""
    items = benchmark.select("item_id", F.transform(words_of(F.col("text")), folded).alias("w")).where("size(w) > 0")
    starts = F.sequence(F.lit(1), F.greatest(F.size("w") - width + 1, F.lit(1)))
    return items.select("item_id", F.explode(F.transform(starts, lambda i: F.slice("w", i, width))).alias("window")).distinct()


def sendable(terms: DataFrame, send_bytes: int = SEND_BYTES) -> DataFrame | None:
    """A written table of terms as one to be broadcast, or None if it is larger than the bound."""
    size = terms.agg(F.sum(F.octet_length("term") + 64)).first()[0] or 0
    return F.broadcast(terms) if size <= send_bytes else None


def places(docs: DataFrame) -> DataFrame:
    """(doc, part, w, pos, term): every word of the corpus, in lower case of all letters, with its document's words."""
    w = docs.select("doc", "part", words_of(F.col("text")).alias("w")).where(F.size("w") > 0)
    return w.select("doc", "part", "w", F.posexplode("w").alias("pos", "term")).withColumn("term", F.lower("term"))


def term_counts(docs: DataFrame, terms: DataFrame, send_bytes: int = SEND_BYTES) -> DataFrame:
    """(term, n): occurrences in the corpus of each term (a written table of distinct terms)."""
    words, few = places(docs).select("term"), sendable(terms, send_bytes)
    count = F.count(F.lit(1)).alias("n")
    if few is None:
        return words.groupBy("term").agg(count).join(terms, "term")
    return words.join(few, "term").groupBy("term").agg(count)


def keyed(docs: DataFrame) -> DataFrame:
    """doc_id and text of every row, with a key (doc, part) without nulls: rows with one doc_id and other texts stay apart."""
    doc = F.coalesce(F.col("doc_id").cast("long"), F.lit(-(2**63)))
    return docs.select("doc_id", "text", doc.alias("doc"), F.xxhash64(F.col("doc_id").isNull(), "text").alias("part"))


def postings(docs: DataFrame, terms: DataFrame, width: int = WINDOW, send_bytes: int = SEND_BYTES) -> DataFrame:
    """(doc, part, term, pos, first, around): every place of the terms (a written table with leads). For those that lead, around holds the words from position first on, up to width - 1 on
    either side, as the text has them."""
    few = sendable(terms, send_bytes)
    found = places(docs).join(terms if few is None else few, "term")
    first = F.greatest(F.col("pos") - (width - 1), F.lit(0))
    around = F.slice("w", first + 1, F.least(F.col("pos"), F.lit(width - 1)) + width)
    return found.select("doc", "part", "term", "pos", first.alias("first"), F.when(F.col("leads"), around).alias("around"))


class PositionalIndex:
    """Posting lists of the terms that a benchmark's windows need, rarest terms first."""

    def __init__(self, docs: DataFrame, benchmark: DataFrame, width: int = WINDOW, send_bytes: int = SEND_BYTES):
        self.width = width
        found = materialise(windows_of(benchmark, width))
        numbered = materialise(found.select("window").distinct().withColumn("window_id", F.monotonically_increasing_id()))
        self.items = materialise(found.join(numbered, "window").select("window_id", "item_id"))
        terms = materialise(numbered.select("window_id", F.posexplode("window").alias("offset", "term")).withColumn("term", F.lower("term")))
        self.frequency = materialise(term_counts(docs, materialise(terms.select("term").distinct()), send_bytes))
        order = Window.partitionBy("window_id").orderBy("n", "term", "offset")
        rare = terms.join(self.frequency, "term", "left").withColumn("n", F.coalesce("n", F.lit(0)))
        rare = rare.withColumn("rank", F.row_number().over(order)).where("rank <= 2").groupBy("window_id").agg(
            F.min("n").alias("n"),
            F.min_by("term", "rank").alias("term"),
            F.min_by("offset", "rank").alias("offset"),
            F.max_by("term", "rank").alias("term2"),
            (F.max_by("offset", "rank") - F.min_by("offset", "rank")).alias("apart"),
        )
        #: window_id, window, its rarest term and that one's offset, its second rarest term and how far behind the first it stands; only windows all of whose terms occur
        self.windows = materialise(numbered.join(rare.where("n > 0"), "window_id"))
        #: what windows share: two terms and their distance; a window of one word has its only one twice
        self.pairs = materialise(self.windows.select("term", "term2", "apart").distinct().withColumn("pair", F.monotonically_increasing_id()))
        both = self.windows.select("term", F.lit(True).alias("leads")).unionByName(self.windows.select(F.col("term2").alias("term"), F.lit(False).alias("leads")))
        self.postings = materialise(postings(docs, materialise(both.groupBy("term").agg(F.max("leads").alias("leads"))), width, send_bytes))

    def lists(self) -> tuple[DataFrame, DataFrame]:
        """(doc, part, pair, pos, first, around) and (doc, part, pair, pos, moved): the posting lists of each pair's first and second term; moved is where its first would stand."""
        one = self.postings.where("around is not null").join(self.pairs.select("term", "pair"), "term")
        two = self.postings.select("doc", "part", F.col("term").alias("term2"), "pos").join(self.pairs.select("term2", "apart", "pair"), "term2")
        return one.select("doc", "part", "pair", "pos", "first", "around"), two.select("doc", "part", "pair", "pos", (F.col("pos") - F.col("apart")).alias("moved"))

    def phrases(self) -> DataFrame:
        """(doc, part, window_id, start, length): all occurrences of windows, each row of the corpus on its own."""
        one, two = self.lists()
        place = ["doc", "part", "pair", "pos"]
        met = materialise(one.select(*place).join(two.select("doc", "part", "pair", F.col("moved").alias("pos")), place, "left_semi").distinct())  # places only: no words are shuffled for it
        at = one.join(met, place).withColumn("around", F.transform("around", folded))
        of = self.windows.join(self.pairs, ["term", "term2", "apart"]).select("pair", "window_id", "window", "offset")
        at = at.join(of, "pair")
        start = F.col("pos") - F.col("offset")
        at = at.where((start >= F.col("first")) & (F.slice("around", F.greatest(start - F.col("first") + 1, F.lit(1)), F.size("window")) == F.col("window")))
        return at.select("doc", "part", "window_id", start.alias("start"), F.size("window").alias("length"))

    def proximity(self, within: int) -> DataFrame:
        """(doc, part, window_id, pos, share): places of a window's rarest term with its second rarest term at most within words away (1 to the index's width less 1), and the share of the window's
        distinct words that stand as near. The lists are joined by stretches of within words."""
        one, two = self.lists()
        stretch = F.floor(F.col("pos") / within)
        two = two.select("doc", "part", "pair", F.col("pos").alias("other"), stretch.alias("s"))
        one = one.withColumn("s", F.explode(F.array(stretch - 1, stretch, stretch + 1)))
        at = one.join(two, ["doc", "part", "pair", "s"]).where(F.col("other").between(F.col("pos") - within, F.col("pos") + within) & (F.col("other") != F.col("pos")))
        at = at.select("doc", "part", "pair", "pos", "first", F.transform("around", folded).alias("around")).distinct()
        of = self.windows.where("size(window) > 1").join(self.pairs, ["term", "term2", "apart"]).select("pair", "window_id", "window")
        low = F.greatest(F.col("pos") - F.col("first") - within + 1, F.lit(1))
        near = F.slice("around", low, F.col("pos") - F.col("first") + within + 2 - low)
        share = F.size(F.array_intersect("window", near)) / F.size(F.array_distinct("window"))
        return at.join(of, "pair").select("doc", "part", "window_id", "pos", share.alias("share"))


def hits(index: PositionalIndex) -> DataFrame:
    """(doc, part, n_hit, items): words inside any occurrence, and the items whose windows occur, sorted as strings."""
    found = materialise(index.phrases().distinct())
    spans = found.groupBy("doc", "part").agg(F.sort_array(F.collect_set(F.struct("start", (F.col("start") + F.col("length")).alias("end")))).alias("spans"))
    start = F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("n"))

    def add(acc, x):
        return F.struct(F.greatest(acc["end"], x["end"]).alias("end"), (acc["n"] + F.greatest(x["end"] - F.greatest(acc["end"], x["start"]), F.lit(0))).alias("n"))

    spans = spans.select("doc", "part", F.aggregate("spans", start, add)["n"].alias("n_hit"))
    items = found.select("doc", "part", "window_id").distinct().join(index.items, "window_id")
    items = items.groupBy("doc", "part").agg(F.sort_array(F.collect_set(F.col("item_id").cast("string"))).alias("items"))
    return spans.join(items, ["doc", "part"])


def decontaminate(docs: DataFrame, benchmark: DataFrame, width: int = WINDOW) -> DataFrame:
    """doc_id, n_words, n_hit, items, contaminated of every row of docs.

    Null and empty texts have no words and are clean; null items have no windows. Equal rows come back as often as they are there; rows without
    doc_id are judged by their text like any other.
    """
    rows = keyed(docs)
    index = PositionalIndex(rows, benchmark, width)
    found = materialise(hits(index))
    base = rows.select("doc_id", "doc", "part", F.size(words_of(F.col("text"))).cast("long").alias("n_words"))
    n_hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    return base.join(found, ["doc", "part"], "left").select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        ((n_hit > 0) & (SHARE * n_hit >= F.col("n_words"))).alias("contaminated"),
    )


def clean(docs: DataFrame, benchmark: DataFrame, width: int = WINDOW) -> DataFrame:
    """The rows of docs, with all their columns, that aren't contaminated."""
    names = docs.columns
    doc, part, hit = (private(names, n) for n in ("doc", "part", "hit"))
    found = hits(PositionalIndex(keyed(docs), benchmark, width)).select(F.col("doc").alias(doc), F.col("part").alias(part), F.col("n_hit").alias(hit))
    rows = docs.withColumn(doc, F.coalesce(F.col("doc_id").cast("long"), F.lit(-(2**63)))).withColumn(part, F.xxhash64(F.col("doc_id").isNull(), "text"))
    rows = rows.join(materialise(found), [doc, part], "left")
    return rows.where(F.col(hit).isNull() | (SHARE * F.col(hit) < F.size(words_of(F.col("text"))))).select(*names)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract columns: doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    out = decontaminate(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark").select("item_id", "text"))
    return out.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


ORACLE = r"""
WITH w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w
  FROM documents),
i AS (
  SELECT item_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w
  FROM benchmark),
win AS (
  SELECT DISTINCT item_id, len(g) AS n, array_to_string(g, ' ') AS g
  FROM (SELECT item_id, unnest(list_transform(range(1, greatest(len(w) - 12, 1) + 1), lambda s: w[s:s + 12])) AS g FROM i WHERE len(w) > 0)),
lens AS (SELECT DISTINCT n FROM win),
grams AS (
  SELECT doc_id, n, s, array_to_string(w[s:s + n - 1], ' ') AS g
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS s FROM w, lens WHERE len(w) >= n)),
occ AS (SELECT g.doc_id, g.s, g.n, win.item_id FROM grams g JOIN win ON g.g = win.g AND g.n = win.n),
hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + n)) AS p FROM occ) GROUP BY doc_id),
it AS (SELECT doc_id, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS items FROM occ GROUP BY doc_id)
SELECT w.doc_id, CAST(len(w.w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w.w) AS contaminated
FROM w LEFT JOIN hit USING (doc_id) LEFT JOIN it USING (doc_id)
"""
