"""Quality scores by Bradley-Terry pairwise ranking, cut at a score quantile.

Each pair of a labelled good and a labelled bad document is a contest that the good one wins. With score s(x) = w . f(x), the chance that i
beats j is sigmoid(s(i) - s(j)); w minimises the logistic loss on feature differences. The features are shares and rates of a whole
text, so that they don't grow with its length; no label, language, source or id is among them.

The scores rank documents; the cut is the quantile of the training scores at the share of bad labels, and so part of the fit on at most MAX_TRAIN labelled documents. A score in 0..1 is
the logistic curve around that cut. Without labels of both kinds, every score is 1 (none, or only good ones) or 0.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimloom.llm.common import materialise, table

#: Labelled rows that training sees at most (a documented bound: those whose hashed doc_id is lowest), and contests of each bad row.
MAX_TRAIN, CONTESTS, SEED = 20_000, 24, 11

FEATURES = (
    "upper", "letters", "digits", "high", "spaces", "newlines", "distinct_words", "repeated_next", "distinct_pairs", "word_length", "short_words", "log_words", "distinct_lines", "line_length",
)

_UPPER, _LOWER, _DIGIT = np.zeros(256, bool), np.zeros(256, bool), np.zeros(256, bool)
_UPPER[65:91], _LOWER[97:123], _DIGIT[48:58] = True, True, True


def features(text: str | None) -> np.ndarray:
    """Features of a whole text; null counts as empty."""
    data = (text or "").encode("utf-8", "surrogatepass")
    words, lines = data.split(), data.split(b"\n")
    n, k = max(1, len(data)), max(1, len(words))
    counts = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    upper, lower = counts[_UPPER].sum(), counts[_LOWER].sum()
    hashed = np.fromiter(map(zlib.crc32, words), np.uint32, len(words))
    return np.array([
        upper / max(1, upper + lower), (upper + lower) / n, counts[_DIGIT].sum() / n, counts[128:].sum() / n, counts[32] / n, counts[10] / k,
        len(np.unique(hashed)) / k ** 0.9, (hashed[1:] == hashed[:-1]).sum() / k, len(np.unique(hashed[1:].astype(np.uint64) << np.uint64(32) | hashed[:-1])) / k,
        (n - k) / k / 10, sum(len(w) < 3 for w in words) / k, np.log1p(len(words)) / 8, len(set(lines)) / len(lines), np.log1p(n / len(lines)) / 8,
    ])


def featured(docs: DataFrame, columns: list[str]) -> DataFrame:
    """The named columns of docs and x, the array of features."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index("text")
            rows = pa.array([features(t.as_py()) for t in batch.column(at)], pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([*(batch.column(batch.schema.get_field_index(c)) for c in columns), rows], names=[*columns, "x"])

    kinds = dict(docs.dtypes)
    return docs.select(*columns, *(["text"] if "text" not in columns else [])).mapInArrow(run, ", ".join([*(f"`{c}` {kinds[c]}" for c in columns), "x array<double>"]))


@dataclass
class Ranker:
    mean: np.ndarray
    scale: np.ndarray
    weight: np.ndarray
    cut: float
    slope: float

    def score(self, x: np.ndarray) -> np.ndarray:
        raw = np.clip((x - self.mean) / self.scale, -8, 8) @ self.weight
        return 1 / (1 + np.exp(-np.clip(self.slope * (raw - self.cut), -40, 40)))


def fit(x: np.ndarray, good: np.ndarray, ridge: float = 1e-3) -> Ranker:
    """Bradley-Terry weights by Newton's method on differences of features; with only one kind of label, every score is 1 or 0."""
    d = x.shape[1] if x.ndim == 2 and len(x) else len(FEATURES)
    if not len(x) or good.all() or not good.any():
        sure = -1.0 if not len(x) or good.all() else 1.0
        return Ranker(np.zeros(d), np.ones(d), np.zeros(d), sure, 40.0)
    mean, scale = x.mean(0), x.std(0) + 1e-6
    z = np.clip((x - mean) / scale, -8, 8)
    draw = np.random.default_rng(SEED)
    bad = np.repeat(np.flatnonzero(~good), CONTESTS)
    apart = z[draw.choice(np.flatnonzero(good), len(bad))] - z[bad]
    weight = np.zeros(d)
    for _ in range(40):
        lost = 1 / (1 + np.exp(np.clip(apart @ weight, -40, 40)))
        gradient = ridge * weight - apart.T @ lost / len(apart)
        bend = (apart * (lost * (1 - lost))[:, None]).T @ apart / len(apart) + ridge * np.eye(d)
        step = np.linalg.solve(bend, gradient)
        weight = weight - step * min(1.0, 5 / (np.abs(step).max() + 1e-12))
        if np.abs(step).max() < 1e-7:
            break
    raw = z @ weight
    # the quantile at the share of bad labels, in the middle of the gap between its neighbours
    order = np.sort(raw)
    at = int((~good).sum())
    cut = (order[at - 1] + order[min(at, len(order) - 1)]) / 2
    spread = np.median(np.abs(raw - cut)) + 1e-9
    return Ranker(mean, scale, weight, float(cut), float(3 / spread))


def labelled(docs: DataFrame, labels: DataFrame, bound: int = MAX_TRAIN) -> tuple[np.ndarray, np.ndarray]:
    """Features and labels of at most bound documents: those with a label whose crc32(doc_id) modulo 3 isn't 1, lowest hash first.

    Ids with labels that contradict each other, or with others than 0 and 1, teach nothing; repeated labels count once. Of rows with one doc_id, that whose text has the smallest hash counts.
    """
    usable = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(3)) != 1
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality")).where(usable & F.col("quality").isin(0, 1))
    known = known.groupBy("doc_id").agg(F.min("quality").alias("quality"), F.max("quality").alias("other")).where("quality = other").drop("other")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("hash"), "text")
    there = texts.select("doc_id", "hash").groupBy("doc_id").agg(F.min("hash").alias("hash")).join(known, "doc_id")
    chosen = materialise(there.orderBy(F.xxhash64("doc_id"), "doc_id").limit(bound))
    rows = featured(texts.join(F.broadcast(chosen), ["doc_id", "hash"]).dropDuplicates(["doc_id"]), ["doc_id", "quality"])  # at most bound rows are broadcast
    got = sorted((r["doc_id"], r["quality"], tuple(r["x"])) for r in rows.collect())  # at most bound rows
    return np.array([r[2] for r in got]).reshape(len(got), len(FEATURES)), np.array([r[1] == 1 for r in got], bool)


def scored(docs: DataFrame, model: Ranker, out: str = "score") -> DataFrame:
    """All columns of docs and the score, in the column out, which replaces one of that name. Every row is scored by its own whole text; null and empty texts too."""
    plain = [f for f in docs.schema.fields if f.name.lower() != out.lower()]
    names = [f.name for f in plain]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index("text")
            x = np.array([features(t.as_py()) for t in batch.column(at)]).reshape(batch.num_rows, len(FEATURES))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(model.score(x))], names=[*names, out])

    return docs.select(*names).mapInArrow(run, ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in plain), f"`{out}` double"]))


def train(docs: DataFrame, labels: DataFrame, bound: int = MAX_TRAIN) -> Ranker:
    return fit(*labelled(docs, labels, bound))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract columns: doc_id, held_out, score, predicted."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = scored(docs, train(docs, table(spark, sf_dir, "labels")))
    held = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(3)) == 1
    return out.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
