"""Nearest neighbours by multi-index hashing.

1. On a bounded sample of rows, principal axes and a rotation that moves them towards the corners of a cube are learned; the signs of a rotated vector are its
   code, of 64 bits at most. The same sample gives the Hamming radius: that within which CALIBRATE of the true neighbours in it lie.
2. Every row is coded and goes to a block by its id. A block's codes are split into SUBSTRINGS; the rows of a block by the values of each substring are its posting lists,
   which are stored with the rows.
3. If two codes differ in at most r bits, and the substrings' reaches and their number add up to more than r, one substring differs within its reach (pigeonhole). So the lists of
   the values within reach of the query's give every code within the radius; their whole codes are compared, then the original vectors.
4. Queries go to every block as rows; a block is held by one task at a time and answers with its k best for each query, so only k rows for each query and block are shuffled.

Where a block has fewer than k codes within the radius, the query is compared with all its rows, so that every query gets k rows if there are as many, and a radius that is too small for some queries costs time and
not neighbours. Blocks depend on ids and the number of rows only: the answer is the same however rows lie in files, partitions and tasks.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from claimloom.llm.common import materialise, table

#: Rows that the rotation and the radius are learned on at most, and how many of them serve as queries.
SAMPLE, TRIALS = 4096, 256
CALIBRATE = 0.97
SUBSTRINGS, WIDTH = 8, 8
#: Rows of a block at most (about), and queries that are compared at a time.
BLOCK, QUERIES, K = 16384, 256, 10
FAR = np.uint64((1 << WIDTH) - 1)


@dataclass
class Codes:
    """A learned binary code: mean, rotation, and radius for the wanted recall."""

    mean: np.ndarray
    turn: np.ndarray
    radius: int

    @classmethod
    def fit(cls, x: np.ndarray, rounds: int = 30, seed: int = 5) -> Codes:
        dims = x.shape[1]
        bits = min(64, dims)
        mean = x.mean(0) if len(x) else np.zeros(dims)
        if len(x) < 2:
            return cls(mean, np.eye(dims)[:, :bits], bits)
        _, _, axes = np.linalg.svd(x - mean, full_matrices=len(x) < dims)
        v = (x - mean) @ axes.T[:, :bits]
        turn = np.linalg.qr(np.random.default_rng(seed).normal(size=(bits, bits)))[0]
        for _ in range(rounds):
            left, _, right = np.linalg.svd(np.where(v @ turn > 0, 1.0, -1.0).T @ v)
            turn = (left @ right).T
        made = cls(mean, axes.T[:, :bits] @ turn, bits)
        code = made(x)
        apart = []
        for i in np.random.default_rng(seed + 1).choice(len(x), min(TRIALS, len(x)), replace=False):
            d = ((x - x[i]) ** 2).sum(1)
            d[i] = np.inf
            near = np.argsort(d)[: min(K, len(x) - 1)]
            apart += np.bitwise_count(code[near] ^ code[i]).tolist()
        made.radius = int(np.quantile(apart, CALIBRATE, method="higher"))
        return made

    def __call__(self, x: np.ndarray) -> np.ndarray:
        raw = (x - self.mean) @ self.turn > 0
        out = np.zeros((len(x), 64), bool)
        out[:, : raw.shape[1]] = raw
        return np.packbits(out, axis=1, bitorder="little").view(np.uint64).ravel()


def postings(codes: np.ndarray) -> np.ndarray:
    """(rows, SUBSTRINGS): column s holds the places of the codes in the order of their substring s, its posting lists one after the other."""
    return np.stack([np.argsort(_value(codes, s), kind="stable") for s in range(SUBSTRINGS)], 1).astype(np.int32)


def _value(codes: np.ndarray, s: int) -> np.ndarray:
    return (codes >> np.uint64(WIDTH * s) & FAR).astype(np.intp)


def reaches(radius: int) -> list[int]:
    """The reach of each substring: together with their number, more than the radius; -1 for a substring that needn't be probed."""
    whole, rest = divmod(radius - SUBSTRINGS + 1, SUBSTRINGS)
    return [whole + (s < rest) for s in range(SUBSTRINGS)]


class MultiIndex:
    """Codes of one block and the posting lists of their substrings."""

    def __init__(self, codes: np.ndarray, lists: np.ndarray | None = None):
        self.codes = codes
        self.lists = postings(codes) if lists is None else lists
        self.starts = [np.searchsorted(_value(codes, s)[self.lists[:, s]], np.arange((1 << WIDTH) + 1)) for s in range(SUBSTRINGS)]
        self.probed: dict[tuple[int, int, int], np.ndarray] = {}

    def probe(self, s: int, value: int, reach: int) -> np.ndarray:
        """Places whose substring s differs in at most reach bits from value: the lists of all values around it."""
        if (s, value, reach) not in self.probed:
            around = np.arange(1 << WIDTH)
            around = around[np.bitwise_count((around ^ value).astype(np.uint64)) <= reach]
            start, order = self.starts[s], self.lists[:, s]
            self.probed[s, value, reach] = np.concatenate([order[start[v] : start[v + 1]] for v in around.tolist()])
        return self.probed[s, value, reach]

    def within(self, code: np.uint64, radius: int) -> np.ndarray:
        """Places of all codes within the radius, and only these."""
        found = np.zeros(len(self.codes), bool)
        for s, reach in enumerate(reaches(radius)):
            if reach >= 0:
                found[self.probe(s, int(code >> np.uint64(WIDTH * s) & FAR), min(reach, WIDTH))] = True
        at = np.flatnonzero(found)
        return at[np.bitwise_count(self.codes[at] ^ code) <= radius]


def usable(rows: DataFrame, id_column: str, vector: str) -> DataFrame:
    """(id, x) of the rows that can take part: an id, a vector of finite components that aren't all zero."""
    x = F.col(vector).cast("array<double>")
    fine = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))) & F.exists(x, lambda c: c != 0)
    return rows.where(F.col(id_column).isNotNull() & F.col(vector).isNotNull() & fine).select(F.col(id_column).cast("long").alias("id"), x.alias("x"))


def _matrix(column: pa.Array) -> np.ndarray:
    return np.asarray(column.flatten()).reshape(len(column), -1)


@dataclass
class HashIndex:
    """rows: id, dims, block, x, code and, for every place of a block, the entries of its posting lists there."""

    rows: DataFrame
    codes: Codes
    dims: int
    blocks: int

    @classmethod
    def build(cls, rows: DataFrame, id_column: str = "vec_id", vector: str = "embedding") -> HashIndex:
        """Index of every usable row. A vector is compared with those of its own length. The code is learned for the commonest length (ties to the shorter); vectors of other
        lengths all have code zero, so they are compared exactly."""
        fine = usable(rows, id_column, vector).withColumn("dims", F.size("x"))
        sizes = fine.groupBy("dims").agg(F.count(F.lit(1)).alias("rows")).orderBy(F.desc("rows"), "dims").collect()  # a row for each length that occurs
        dims, count, total = (sizes[0]["dims"], sizes[0]["rows"], sum(r["rows"] for r in sizes)) if sizes else (1, 0, 0)
        blocks = max(1, min(8, -(-total // 1024)), -(-total // BLOCK))
        share = min(1 << 20, -(-(SAMPLE + 1024 << 20) // max(1, count)))  # by hash, a little more than wanted, so that tasks send no more than that
        drawn = fine.where((F.col("dims") == dims) & (F.pmod(F.xxhash64("id", F.lit(3)), F.lit(1 << 20)) < share))
        sample = drawn.select("id", "x").orderBy(F.xxhash64("id"), "id", "x").limit(SAMPLE).collect()
        codes = Codes.fit(np.array([r["x"] for r in sorted(sample)], float).reshape(len(sample), dims))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for cell in _groups(batches, ("dims", "block")):
                length = cell.column("dims")[0].as_py()
                code = codes(_matrix(cell.column("x").combine_chunks())) if length == dims else np.zeros(cell.num_rows, np.uint64)
                lists = pa.FixedSizeListArray.from_arrays(pa.array(postings(code).ravel()), SUBSTRINGS).cast(pa.list_(pa.int32()))
                out = cell.append_column("code", pa.array(code.view(np.int64))).append_column("lists", lists)
                yield from out.to_batches(max_chunksize=4096)

        dealt = fine.select("id", "dims", F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int").alias("block"), "x")
        dealt = dealt.repartition(blocks, "dims", "block").sortWithinPartitions("dims", "block", "id", "x")
        return cls(materialise(dealt.mapInArrow(run, "id long, dims int, block int, x array<double>, code long, lists array<int>")), codes, dims, blocks)

    def search(self, queries: DataFrame, k: int = K) -> DataFrame:
        """(query_id, rank, id, score): for each id of queries (rows of the index) the k nearest other ids, ties to the smaller id.

        An id with several vectors is as near as the nearest of them, on both sides; repeated rows change nothing.
        """
        radius = self.codes.radius

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for cell, asked in _held(batches):
                index = MultiIndex(cell["code"], cell["lists"])
                for at in range(0, len(asked["id"]), QUERIES):
                    yield _answers(index, cell, {n: v[at : at + QUERIES] for n, v in asked.items()}, radius, k)

        none = F.array().cast("array<int>")
        everywhere = queries.select("id", "dims", F.explode(F.sequence(F.lit(0), F.lit(self.blocks - 1))).alias("block"), "x", "code", none.alias("lists"), F.lit(True).alias("asks"))
        # a block's rows come first, in the order of its lists; then the queries
        rows = self.rows.withColumn("asks", F.lit(False)).unionByName(everywhere)
        rows = rows.repartition(self.blocks, "dims", "block").sortWithinPartitions("dims", "block", "asks", "id", "x")
        found = rows.select("dims", "block", "asks", "id", "x", "code", "lists").mapInArrow(run, "query_id long, id long, score double")
        each = found.groupBy("query_id", "id").agg(F.min("score").alias("score"))
        order = Window.partitionBy("query_id").orderBy("score", "id")
        return each.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "id", "score")


def _groups(batches: Iterator[pa.RecordBatch], names: tuple[str, ...]) -> Iterator[pa.Table]:
    """Tables of the rows that agree on the named columns and lie side by side."""
    held: list[pa.RecordBatch] = []
    now = None
    for batch in batches:
        keys = np.stack([batch.column(batch.schema.get_field_index(n)).to_numpy() for n in names], 1)
        cut = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(1)) + 1).tolist(), len(keys)]
        for lo, hi in zip(cut, cut[1:]):
            if hi > lo:
                if held and tuple(keys[lo]) != now:
                    yield pa.Table.from_batches(held)
                    held = []
                now = tuple(keys[lo])
                held.append(batch.slice(lo, hi - lo))
    if held:
        yield pa.Table.from_batches(held)


def _held(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[dict[str, np.ndarray], dict[str, np.ndarray]]]:
    """(a block's rows, some of the queries to it): the block is held, the queries stream past."""
    block: dict[str, np.ndarray] = {}
    key, parts = None, []

    def arrays(b: pa.RecordBatch | pa.Table, lists: bool) -> dict[str, np.ndarray]:
        column = lambda n: c.combine_chunks() if isinstance(c := b.column(n), pa.ChunkedArray) else c
        out = {"id": column("id").to_numpy(zero_copy_only=False), "x": _matrix(column("x")), "code": column("code").to_numpy(zero_copy_only=False).view(np.uint64)}
        return out | ({"lists": _matrix(column("lists"))} if lists else {})

    for batch in batches:
        d, b, asks = (batch.column(k).to_numpy(zero_copy_only=False) for k in range(3))
        cut = [0, *(np.flatnonzero((d[1:] != d[:-1]) | (b[1:] != b[:-1]) | (asks[1:] != asks[:-1])) + 1).tolist(), len(d)]
        for lo, hi in zip(cut, cut[1:]):
            if hi == lo:
                continue
            if key != (d[lo], b[lo]):
                key, block, parts = (d[lo], b[lo]), {}, []
            if not asks[lo]:
                parts.append(batch.slice(lo, hi - lo))
            elif parts or block:
                if parts:
                    block, parts = arrays(pa.Table.from_batches(parts), True), []
                yield block, arrays(batch.slice(lo, hi - lo), False)


def _answers(index: MultiIndex, block: dict[str, np.ndarray], asked: dict[str, np.ndarray], radius: int, k: int) -> pa.RecordBatch:
    """The k nearest other ids of a block for each query, among the codes within the radius, or among all rows if these are fewer than k ids."""
    ids, x = block["id"], block["x"]
    out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for me, vector, code in zip(asked["id"].tolist(), asked["x"], asked["code"]):
        at = index.within(code, radius)
        at = at[ids[at] != me]
        if len(np.unique(ids[at])) < k:
            at = np.flatnonzero(ids != me)
        score = np.sqrt(((x[at] - vector) ** 2).sum(1))
        if len(score) > 4 * k:
            keep = np.flatnonzero(score <= np.partition(score, 2 * k)[2 * k])  # unless ids repeat more than that
            if len(np.unique(ids[at[keep]])) >= k:
                at, score = at[keep], score[keep]
        order = np.lexsort((ids[at], score))
        at, score = at[order], score[order]
        _, first = np.unique(ids[at], return_index=True)
        first = np.sort(first)[:k]
        out.append((np.full(len(first), me, np.int64), ids[at[first]], score[first]))
    columns = [np.concatenate(c) for c in zip(*out)] if out else [np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)]
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["query_id", "id", "score"])


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract columns: query_id, rank, vec_id, score."""
    index = HashIndex.build(table(spark, sf_dir, "embeddings"))
    found = index.search(index.rows.where(F.col("id") % 100 == 0))
    return found.select("query_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("vec_id"), "score")
