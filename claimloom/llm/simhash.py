"""SimHash near-duplicates, found with Gray-order hierarchical indexes.

1. One pass makes each document's fingerprint; equal fingerprints become one class.
2. Classes go to cells. For a small radius r, a cell holds all classes that agree on one of r + 1 disjoint blocks of bits, so that each linked pair
   shares a cell; cells with too many classes are cut again by blocks of the bits that are left, which loses no pair either. Near copies by
   shingle sets (one_of_each) share a cell by min-hash bands, and the pairs found there are only candidates: the sets decide.
3. In each cell, a hierarchical index finds the links: fingerprints in Gray order, whose upper nodes hold the bits
   that all codes below share. Pairs of nodes whose shared bits already differ too much are dropped with all below.
   A cell returns one link for each class (to the smallest of those it is connected with there), never all pairs.
4. Connected components over those links, on the executors.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimloom.llm.common import components, materialise, private, table

#: Classes in a cell before it is cut again.
CELL = 256
#: Codes below one node of the index.
FAN = 8
#: Odd multipliers that derive further 64-bit words of a wide fingerprint from one hash.
MIX = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)


def shingle_hashes(text: str | None, width: int) -> np.ndarray:
    """XXH64 (seed 42) of each run of width words, repeats included; of the whole sequence if it has fewer words."""
    data = (text or "").encode("utf-8", "surrogatepass").lower()
    words = data.split()  # of bytes: at exactly [\x20\x09-\x0D]
    if not words:
        return np.empty(0, np.uint64)
    joined, n = b" ".join(words), len(words)
    digest = xxhash.xxh64_intdigest
    if n <= width:
        return np.array([digest(joined, 42)], np.uint64)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, n) + 1)
    starts = np.concatenate(([0], ends[: n - width])).tolist()
    return np.array([digest(joined[a:b], 42) for a, b in zip(starts, (ends[width - 1 :] - 1).tolist())], np.uint64)


def _mixed(hashes: np.ndarray, word: int) -> np.ndarray:
    if not word:
        return hashes
    x = hashes * np.uint64(MIX[word % len(MIX)]) + np.uint64(word)
    x ^= x >> np.uint64(32)
    x *= np.uint64(MIX[(word + 1) % len(MIX)])
    return x ^ (x >> np.uint64(29))


#: The bits of a byte, each in a byte of its own: sums of up to 255 such words count eight bits at once.
SPREAD = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").view(np.uint64).ravel()


def majorities(hashes: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """For consecutive runs of hashes, the 64 bits that are set in over half of the run; zero for an empty run."""
    out = np.zeros(len(sizes), np.uint64)
    held = np.flatnonzero(sizes)
    if not len(held):
        return out
    size = sizes[held]
    chunks = -(-size // 255)  # no counter of a chunk overflows
    first = np.cumsum(chunks) - chunks
    within = np.arange(chunks.sum()) - np.repeat(first, chunks)
    at = np.repeat(np.cumsum(size) - size, chunks) + 255 * within
    lanes = hashes.view(np.uint8).reshape(-1, 8)
    counts = np.stack([np.add.reduceat(SPREAD[lanes[:, k]], at) for k in range(8)], 1).view(np.uint8).reshape(-1, 64)
    counts = np.add.reduceat(counts, first, axis=0, dtype=np.int64)
    out[held] = np.packbits(2 * counts > size[:, None], axis=1, bitorder="little").view(np.uint64).ravel()
    return out


def fingerprints(docs: DataFrame, width: int = 3, words: int = 1) -> DataFrame:
    """doc_id and fingerprint columns w0, w1, ... (64 bits each, as signed longs) of every row; null text: as empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                batch = whole.slice(at, 256)
                each = [shingle_hashes(text.as_py(), width) for text in batch.column(1)]
                hashes, sizes = np.concatenate(each), np.fromiter(map(len, each), np.int64, len(each))
                found = [pa.array(majorities(_mixed(hashes, w), sizes).view(np.int64)) for w in range(words)]
                yield pa.RecordBatch.from_arrays([batch.column(0), *found], names=["doc_id", *(f"w{w}" for w in range(words))])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, " + ", ".join(f"w{w} long" for w in range(words)))


# ---------------------------------------------------------------- the index


def gray_rank(codes: np.ndarray) -> np.ndarray:
    """Place of each code (rows of 64-bit words) in the reflected Gray sequence: each bit is the parity of those above."""
    out = codes.copy()
    for s in (1, 2, 4, 8, 16, 32):
        out ^= out >> np.uint64(s)
    for w in range(1, out.shape[1]):  # an odd word before flips all that follows
        odd = (out[:, w - 1] & np.uint64(1)).astype(bool)
        out[odd, w] = ~out[odd, w]
    return out


def levels(codes: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """(mask, pattern) of the nodes of each level, leaves first: the bits that all codes below a node share."""
    mask, pattern = np.full_like(codes, np.iinfo(np.uint64).max), codes
    out = [(mask, pattern)]
    while len(mask) > 1:
        at = np.arange(0, len(mask), FAN)
        ones = np.bitwise_and.reduceat(pattern | ~mask, at, axis=0)  # bits that are set or free everywhere
        zeros = np.bitwise_and.reduceat(~pattern | ~mask, at, axis=0)
        same = np.bitwise_and.reduceat(mask, at, axis=0) & (ones | zeros)
        mask, pattern = same, ones & same
        out.append((mask, pattern))
    return out


def near_pairs(codes: np.ndarray, radius: int, block: int = 1 << 20, labels: np.ndarray | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Positions of the pairs of Gray-ordered codes that differ in at most radius bits, by walking pairs of nodes down.

    With labels, only pairs with two labels; pairs of nodes that hold one label between them are dropped with all below.
    """
    tree = levels(codes)
    ends = [(labels, labels)] if labels is not None else None
    while ends is not None and len(ends) < len(tree):
        low, high = ends[-1]
        at = np.arange(0, len(low), FAN)
        ends.append((np.minimum.reduceat(low, at), np.maximum.reduceat(high, at)))
    stack = [(len(tree) - 1, np.zeros(1, np.int64), np.zeros(1, np.int64))]
    while stack:
        level, a, b = stack.pop()
        if not level:
            keep = a < b
            yield a[keep], b[keep]
            continue
        mask, pattern = tree[level - 1]
        if len(a) * FAN * FAN > block and len(a) > 1:
            half = len(a) // 2
            stack += [(level, a[:half], b[:half]), (level, a[half:], b[half:])]
            continue
        step = np.arange(FAN)
        x, y = np.broadcast_arrays((a[:, None] * FAN + step)[:, :, None], (b[:, None] * FAN + step)[:, None, :])
        x, y = x.ravel(), y.ravel()
        keep = (x <= y) & (y < len(mask))
        x, y = x[keep], y[keep]
        if ends is not None:
            low, high = ends[level - 1]
            keep = np.minimum(low[x], low[y]) != np.maximum(high[x], high[y])
            x, y = x[keep], y[keep]
        apart = np.bitwise_count((pattern[x] ^ pattern[y]) & mask[x] & mask[y]).sum(1, dtype=np.int64)
        keep = apart <= radius
        stack.append((level - 1, x[keep], y[keep]))


def cell_links(codes: np.ndarray, ids: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """(id, smallest id that it is connected with in this cell), without the ids that are the smallest."""
    n = len(codes)
    rank = gray_rank(codes)
    order = np.lexsort([rank[:, w] for w in reversed(range(codes.shape[1]))])
    codes, ids = codes[order], ids[order]
    pairs = [x for x in near_pairs(codes, radius) if len(x[0])]
    if not pairs:
        return ids[:0], ids[:0]
    a, b = np.concatenate([x for x, _ in pairs]), np.concatenate([y for _, y in pairs])
    at = np.argsort(ids, kind="stable")
    root = np.empty(n, np.int64)
    root[at] = np.arange(n)  # roots are places in the order of the ids
    while True:
        least = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, a, least)
        np.minimum.at(new, b, least)
        new = np.minimum(new, new[at[new]])
        if (new == root).all():
            break
        root = new
    low = ids[at[root]]
    keep = low != ids
    return ids[keep], low[keep]


# ---------------------------------------------------------------- cells


def _blocks(free: list[int], parts: int) -> list[list[int]]:
    cut = np.linspace(0, len(free), parts + 1).astype(int)
    return [free[a:b] for a, b in zip(cut[:-1], cut[1:])]


def _packed(bits: list[int], words: int) -> tuple[int, ...]:
    """Bits as signed 64-bit masks, one for each word of a fingerprint."""
    masks = [0] * words
    for bit in bits:
        masks[bit // 64] |= 1 << bit % 64
    return tuple(m - (1 << 64) if m >> 63 else m for m in masks)


def _cells(classes: DataFrame, masks: list[tuple[int, tuple[int, ...]]], words: int) -> DataFrame:
    """One row for each class and mask: the mask's number, the masked bits' hash, and the class."""
    keys = F.array(*(F.struct(F.lit(k).alias("mask"), F.xxhash64(*(F.col(f"w{w}").bitwiseAND(F.lit(m[w])) for w in range(words))).alias("key")) for k, m in masks))
    return classes.withColumn("_cell", F.explode(keys)).select("_cell.mask", "_cell.key", *classes.columns)


def _in_cells(cells: DataFrame, names: list[str], pairs: Callable[[np.ndarray], Iterator[tuple[np.ndarray, np.ndarray]]], parts: int) -> DataFrame:
    """What pairs yields for the rows (mask, key, names) of every cell. Cells lie side by side in sorted partitions; only one cell is held at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: np.ndarray | None = None
        for batch in batches:
            x = np.stack([c.to_numpy(zero_copy_only=False) for c in batch.columns], 1)
            x = x if rest is None else np.concatenate((rest, x))
            cut = np.flatnonzero((x[1:, :2] != x[:-1, :2]).any(1)) + 1
            last = cut[-1] if len(cut) else 0
            yield from done(x[:last], cut)
            rest = x[last:]
        if rest is not None:
            yield from done(rest, np.empty(0, np.int64))

    def done(x: np.ndarray, cut: np.ndarray) -> Iterator[pa.RecordBatch]:
        a, b, n = [], [], 0
        for lo, hi in zip([0, *cut], [*cut, len(x)]):
            if hi - lo > 1:
                for left, right in pairs(x[lo:hi]):
                    a.append(left)
                    b.append(right)
                    n += len(left)
                    if n > 1 << 16:
                        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(a)), pa.array(np.concatenate(b))], names=["a", "b"])
                        a, b, n = [], [], 0
        if n:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(a)), pa.array(np.concatenate(b))], names=["a", "b"])

    rows = cells.select(F.col("mask").cast("long"), "key", *names)
    return rows.repartition(parts, "mask", "key").sortWithinPartitions("mask", "key").mapInArrow(run, "a long, b long")


def _linked(cells: DataFrame, radius: int, words: int, parts: int) -> DataFrame:
    """Links in every cell."""

    def pairs(x: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        yield cell_links(np.ascontiguousarray(x[:, 3:]).view(np.uint64), x[:, 2], radius)

    return _in_cells(cells, ["rep", *(f"w{w}" for w in range(words))], pairs, parts)


def _sized(cells: DataFrame) -> DataFrame:
    return materialise(cells.groupBy("mask", "key").agg(F.count(F.lit(1)).alias("n")).where("n > 1"))


def _shuffles(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def exact_links(classes: DataFrame, radius: int, words: int = 1) -> DataFrame:
    """Links (a, b) whose connected classes are exactly those within radius. Classes: rep and the fingerprint words."""
    parts, links = _shuffles(classes.sparkSession), None
    bits = list(range(64 * words))
    nodes = {k: b for k, b in enumerate(_blocks(bits, radius + 1))}
    cells = _cells(classes, [(k, _packed(b, words)) for k, b in nodes.items()], words)
    while True:
        sizes = _sized(cells)
        deep = {k: [x for x in bits if x not in set(b)] for k, b in nodes.items()}
        deep = {k: free for k, free in deep.items() if len(free) > radius + 1}
        large = sizes.where((F.col("n") > CELL) & F.col("mask").isin(list(deep) or [-1]))
        small = sizes.join(large.select("mask", "key"), ["mask", "key"], "left_anti")
        found = _linked(cells.join(small.drop("n"), ["mask", "key"]), radius, words, parts)
        links = found if links is None else links.unionByName(found)
        if large.isEmpty():
            return links
        # a pair in a large cell differs only in the bits that are left: it agrees on one of their blocks as well
        children, child = {}, []
        for k, free in deep.items():
            for block in _blocks(free, radius + 1):
                children[k * (radius + 1) + len(nodes) * 1000 + len(children)] = sorted({*nodes[k], *block})
                child.append((k, list(children)[-1]))
        inside = cells.join(large.select("mask", "key"), ["mask", "key"])
        used = {r[0] for r in large.select("mask").distinct().collect()}  # masks, a fixed small set
        again = None
        for k in sorted(used):
            part = _cells(inside.where(F.col("mask") == k).drop("mask", "key"), [(c, _packed(children[c], words)) for parent, c in child if parent == k], words)
            again = part if again is None else again.unionByName(part)
        nodes = {c: children[c] for parent, c in child if parent in used}
        cells = materialise(again)


def nearest_neighbours(codes: np.ndarray, ids: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(id, that of its nearest code, ties to the smaller id, their distance) of every code with another one within the radius."""
    order = _gray_order(codes)
    codes, ids = codes[order], ids[order]
    at = np.argsort(ids, kind="stable")
    place = np.empty(len(ids), np.int64)
    place[at] = np.arange(len(ids))
    best = np.full(len(ids), np.iinfo(np.int64).max)
    for a, b in near_pairs(codes, radius):
        far = np.bitwise_count(codes[a] ^ codes[b]).sum(1, dtype=np.int64) << 32
        np.minimum.at(best, a, far + place[b])
        np.minimum.at(best, b, far + place[a])
    has = np.flatnonzero(best != np.iinfo(np.int64).max)
    return ids[has], ids[at[best[has] & (1 << 32) - 1]], best[has] >> 32


def _gray_order(codes: np.ndarray) -> np.ndarray:
    rank = gray_rank(codes)
    return np.lexsort([rank[:, w] for w in reversed(range(codes.shape[1]))])


def middle(codes: np.ndarray, ids: np.ndarray) -> tuple[int, int]:
    """(id, distance) of the code that is nearest to the bits most codes have; ties to the smaller id."""
    bits = np.unpackbits(codes.view(np.uint8).reshape(len(codes), -1), axis=1)
    most = np.packbits(2 * bits.sum(0, dtype=np.int64) > len(codes)).view(np.uint64)
    far = np.bitwise_count(codes ^ most).sum(1, dtype=np.int64)
    at = np.lexsort((ids, far))[0]
    return int(ids[at]), int(far[at])


def near_duplicates(docs: DataFrame, width: int = 3, words: int = 1, radius: int = 2) -> DataFrame:
    """doc_id, w0.., component_id of every row: documents are one component if links of at most radius bits join them.

    component_id is the smallest doc_id of the component. Null or empty texts have fingerprint zero, linked like any other; repeated rows
    come back as often as they are there; rows without doc_id get the component of their fingerprint.
    """
    prints = materialise(fingerprints(docs, width, words))
    names = [f"w{w}" for w in range(words)]
    classes = materialise(prints.groupBy(*names).agg(F.min("doc_id").alias("rep")).where("rep is not null"))
    joined = components(exact_links(classes, radius, words))
    known = classes.join(joined.withColumnRenamed("node", "rep"), "rep", "left").select(*names, F.coalesce("component", "rep").alias("component_id"))
    return prints.join(materialise(known), names, "left")


# ---------------------------------------------------------------- near copies by shingle sets

#: Min-hash bands of a class and hashes in one band: a pair with Jaccard similarity 0.8 shares one with probability 1 - (1 - 0.8 ** 4) ** 14 = 0.9994,
#: at any number of documents.
BANDS, ROWS = 14, 4
#: Bits of 256 in which candidates may differ. Texts with Jaccard similarity J differ in about acos(2J / (1 + J)) / pi of the bits: 39 at 0.8, with a spread of 6.
REACH = 64
#: Classes, and shingles, of one part of a cell. Larger cells are dealt out in parts.
CROWD, CROWD_SHINGLES = 1024, 1 << 21
_DRAW = np.random.default_rng(12)
_FLIP = _DRAW.integers(1 << 63, size=BANDS * ROWS, dtype=np.uint64)
_FACTOR = _DRAW.integers(1 << 62, size=BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def band_keys(hashes: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """For consecutive runs of hashes, BANDS keys of each (rows of longs); zeros for empty runs, which no one asks for."""
    out = np.zeros((len(sizes), BANDS), np.uint64)
    held = np.flatnonzero(sizes)
    if len(held):
        at = np.cumsum(sizes[held]) - sizes[held]
        for k, (flip, factor) in enumerate(zip(_FLIP, _FACTOR)):
            least = np.minimum.reduceat((hashes ^ flip) * factor, at)
            out[held, k // ROWS] = (out[held, k // ROWS] ^ least) * np.uint64(MIX[k % ROWS])
    return out.view(np.int64)


def described(docs: DataFrame, width: int, words: int) -> DataFrame:
    """doc_id, text_hash, rep (a hash of the set of shingles, null without words), size of that set, w0.. and bands of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                batch = whole.slice(at, 256)
                each = [shingle_hashes(text.as_py(), width) for text in batch.column(2)]
                hashes, sizes = np.concatenate(each), np.fromiter(map(len, each), np.int64, len(each))
                sets = [np.unique(x) for x in each]
                rep = np.array([xxhash.xxh64_intdigest(x.tobytes(), 42) for x in sets], np.uint64).view(np.int64)
                bands = pa.FixedSizeListArray.from_arrays(pa.array(band_keys(hashes, sizes).ravel()), BANDS).cast(pa.list_(pa.int64()))
                out = [*batch.columns[:2], pa.array(rep), pa.array(list(map(len, sets)), pa.int64()), bands]
                out += [pa.array(majorities(_mixed(hashes, w), sizes).view(np.int64)) for w in range(words)]
                yield pa.RecordBatch.from_arrays(out, names=names)
            pa.default_memory_pool().release_unused()

    names = ["doc_id", "text_hash", "rep", "size", "bands", *(f"w{w}" for w in range(words))]
    kinds = ", ".join(f"{n} {'array<long>' if n == 'bands' else 'long'}" for n in names)
    return docs.select(F.col("doc_id").cast("long"), _text_hash().alias("text_hash"), "text").mapInArrow(run, kinds)


def shingle_sets(docs: DataFrame, width: int) -> DataFrame:
    """rep and the sorted set of shingles of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                sets = [np.unique(shingle_hashes(text.as_py(), width)) for text in whole.slice(at, 256).column(0)]
                rep = np.array([xxhash.xxh64_intdigest(x.tobytes(), 42) for x in sets], np.uint64).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(rep), pa.array([x.view(np.int64) for x in sets], pa.list_(pa.int64()))], names=["rep", "shingles"])
            pa.default_memory_pool().release_unused()

    return docs.select("text").mapInArrow(run, "rep long, shingles array<long>")


def _text_hash():
    return F.xxhash64(F.coalesce("text", F.lit("")))


def similar(pairs: DataFrame, sets: DataFrame, least: float) -> DataFrame:
    """The pairs (a, b) whose shingle sets (rep, shingles) have at least the given Jaccard similarity."""
    x, y = (sets.select(F.col("rep").alias(n), F.col("shingles").alias(f"_{n}")) for n in "ab")
    both = pairs.join(x, "a").join(y, "b").select("a", "b", F.size("_a").alias("m"), F.size("_b").alias("n"), F.size(F.array_intersect("_a", "_b")).alias("common"))
    return materialise(both.where(F.col("common") / (F.col("m") + F.col("n") - F.col("common")) >= least).select("a", "b"))


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows of each cell (mask, key), which lie side by side; only one cell is held at a time."""
    rest: pa.Table | None = None
    for batch in batches:
        new = pa.Table.from_batches([batch])
        rest = new if rest is None else pa.concat_tables([rest, new])
        mask, key = (rest.column(k).to_numpy() for k in (0, 1))
        cut = [0, *(np.flatnonzero((mask[1:] != mask[:-1]) | (key[1:] != key[:-1])) + 1).tolist()]
        for lo, hi in zip(cut, cut[1:]):
            yield rest.slice(lo, hi - lo)
        rest = rest.slice(cut[-1])
    if rest is not None and rest.num_rows:
        yield rest


def _by_cell(rows: DataFrame, run, kinds: str) -> DataFrame:
    return rows.repartition(_shuffles(rows.sparkSession), "mask", "key").sortWithinPartitions("mask", "key").mapInArrow(run, kinds)


def _codes(cell: pa.Table, words: int) -> np.ndarray:
    return np.ascontiguousarray(np.stack([cell.column(f"w{w}").to_numpy() for w in range(words)], 1)).view(np.uint64)


def first_pairs(cells: DataFrame, words: int, reach: int) -> DataFrame:
    """Distinct candidate pairs (a, b), a < b, that grow with the classes only: of each class that with its nearest over all cells, and in each cell that of every class
    with the cell's middle: the class nearest to the bits most of them have, which is what near copies of one text were made from, or close to it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[np.ndarray] = []
        for cell in _runs(batches):
            if cell.num_rows > 1:
                codes, ids = _codes(cell, words), cell.column("rep").to_numpy()
                one, other, far = nearest_neighbours(codes, ids, reach)
                zero = np.zeros_like(one)
                out.append(np.stack([zero, zero, zero, one, other, far], 1))
                if cell.num_rows > 2:
                    at, apart = middle(codes, ids)
                    out.append(np.array([[1, cell.column("mask")[0].as_py(), cell.column("cell")[0].as_py(), at, at, apart]], np.int64))
                if len(out) >= 512:
                    yield made(out)
                    out = []
        if out:
            yield made(out)

    def made(parts: list[np.ndarray]) -> pa.RecordBatch:
        x = np.concatenate(parts)
        return pa.RecordBatch.from_arrays([pa.array(x[:, 0] == 1), *(pa.array(np.ascontiguousarray(x[:, k])) for k in range(1, 6))], names=["hub", "mask", "cell", "a", "b", "far"])

    names = [f"w{w}" for w in range(words)]
    parts = F.ceil(F.col("n") / CROWD).cast("int")
    key = F.when(F.col("n") > 2 * CROWD, F.xxhash64("cell", F.pmod(F.xxhash64("rep", "mask"), parts))).otherwise(F.col("cell"))
    found = materialise(_by_cell(cells.select("mask", key.alias("key"), "cell", "rep", *names), run, "hub boolean, mask long, cell long, a long, b long, far long"))
    near = found.where("not hub").groupBy("a").agg(F.min(F.struct("far", "b"))["b"].alias("b"))
    hubs = found.where("hub").groupBy("mask", "cell").agg(F.min(F.struct("far", "a"))["a"].alias("hub"))
    codes = cells.select("rep", *names).distinct().select(F.col("rep").alias("hub"), *(F.col(n).alias(f"h{n}") for n in names))
    hubs = materialise(hubs.join(codes, "hub"))
    apart = sum((F.bit_count(F.col(n).bitwiseXOR(F.col(f"h{n}"))) for n in names), F.lit(0))
    to_hub = cells.join(hubs, ["mask", "cell"]).where((F.col("rep") != F.col("hub")) & (apart <= reach)).select(F.col("rep").alias("a"), F.col("hub").alias("b"))
    return near.unionByName(to_hub).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def rest_links(cells: DataFrame, sets: DataFrame, words: int, reach: int, least: float) -> DataFrame:
    """Distinct links (a, b) between the labels of cells (mask, cell, rep, n, label, w0..): all pairs of classes with two labels that are within reach in a cell are
    compared by their shingle sets. Cells with one label have none and drop out first.

    A large cell is dealt out in parts: of the classes of its commonest label, which need not meet each other, and of all others; every part of the others
    meets every part of both. So its work is the size of the cell times the number of others.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        links: set[tuple[int, int]] = set()
        for cell in _runs(batches):
            codes, labels = _codes(cell, words), cell.column("label").to_numpy()
            order = _gray_order(codes)
            codes, labels = codes[order], labels[order]
            pairs = [p for p in near_pairs(codes, reach, labels=labels) if len(p[0])]
            if pairs:
                sets_ = cell.column("shingles").combine_chunks()
                links |= _linked_labels(np.concatenate([a for a, _ in pairs]), np.concatenate([b for _, b in pairs]), labels, [sets_[int(i)].values.to_numpy() for i in order], least)
            if len(links) > 1 << 16:
                yield made(links)
                links = set()
        if links:
            yield made(links)

    def made(links: set[tuple[int, int]]) -> pa.RecordBatch:
        x = np.array(sorted(links), np.int64)
        return pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(x[:, 0])), pa.array(np.ascontiguousarray(x[:, 1]))], names=["a", "b"])

    counts = cells.groupBy("mask", "cell", "label").agg(F.count(F.lit(1)).alias("k"), F.sum("size").alias("s"))
    open_ = counts.groupBy("mask", "cell").agg(F.count(F.lit(1)).alias("labels"), F.sum("k").alias("k"), F.sum("s").alias("s"), F.max_by(F.struct("label", "k", "s"), F.struct("k", "label")).alias("top"))
    open_ = materialise(open_.where("labels > 1"))
    parts = lambda k, s: F.greatest(F.ceil(k / CROWD), F.ceil(s / CROWD_SHINGLES), F.lit(1)).cast("int")
    rows = cells.join(open_.withColumns({"p": parts(F.col("top.k"), F.col("top.s")), "q": parts(F.col("k") - F.col("top.k"), F.col("s") - F.col("top.s"))}).select("mask", "cell", F.col("top.label").alias("most"), "p", "q"), ["mask", "cell"])
    common = F.col("label") == F.col("most")
    part = F.pmod(F.xxhash64("rep", "mask"), F.when(common, F.col("p")).otherwise(F.col("q"))).cast("int")
    rows = rows.withColumn("part", part)
    all_of = lambda n: F.sequence(F.lit(0), F.col(n) - 1)
    with_common = F.transform(all_of("p"), lambda j: F.struct(F.lit(1).alias("k"), F.col("part").alias("i"), j.alias("j")))
    with_others = F.transform(all_of("q"), lambda j: F.struct(F.lit(0).alias("k"), F.least("part", j).alias("i"), F.greatest("part", j).alias("j")))
    places = F.when(common, F.transform(all_of("q"), lambda i: F.struct(F.lit(1).alias("k"), i.alias("i"), F.col("part").alias("j")))).otherwise(F.concat(with_common, F.when(F.col("q") > 1, with_others).otherwise(F.array().cast("array<struct<k:int,i:int,j:int>>"))))
    rows = rows.withColumn("to", F.explode(places)).withColumn("key", F.xxhash64("cell", "to"))
    rows = rows.select("mask", "key", "rep", "label", *(f"w{w}" for w in range(words))).join(sets, "rep")
    found = _by_cell(rows.select("mask", "key", "label", *(f"w{w}" for w in range(words)), "shingles"), run, "a long, b long")
    return materialise(found.distinct())


def _linked_labels(a: np.ndarray, b: np.ndarray, labels: np.ndarray, sets: list[np.ndarray], least: float) -> set[tuple[int, int]]:
    """(label, label) of the pairs of places (a, b) whose sets have at least the given Jaccard similarity."""
    sizes = np.array(list(map(len, sets)))
    small, large = np.minimum(sizes[a], sizes[b]), np.maximum(sizes[a], sizes[b])
    keep = small >= least * large
    a, b = a[keep], b[keep]
    if not len(a):
        return set()
    _, which, n = np.unique(labels, return_inverse=True, return_counts=True)
    swap = n[which[a]] > n[which[b]]  # the rarer label leads, so that few rows are marked
    a, b = np.where(swap, b, a), np.where(swap, a, b)
    order = np.argsort(a, kind="stable")
    a, b = a[order], b[order]
    _, ids = np.unique(np.concatenate(sets), return_inverse=True)
    end = np.cumsum(sizes)
    marked = np.zeros(ids.max(initial=0) + 1, bool)
    out: set[tuple[int, int]] = set()
    cut = [0, *(np.flatnonzero(a[1:] != a[:-1]) + 1).tolist(), len(a)]
    for lo, hi in zip(cut, cut[1:]):
        me, others = int(a[lo]), b[lo:hi]
        own = ids[end[me] - sizes[me] : end[me]]
        marked[own] = True
        for other in others.tolist():
            pair = (int(min(labels[me], labels[other])), int(max(labels[me], labels[other])))
            if pair not in out:
                both = int(np.count_nonzero(marked[ids[end[other] - sizes[other] : end[other]]]))
                if both >= least * (sizes[me] + sizes[other] - both):
                    out.add(pair)
        marked[own] = False
    return out


def near_groups(prints: DataFrame, docs: DataFrame, width: int, words: int, reach: int, least: float) -> tuple[DataFrame, DataFrame]:
    """(classes, (rep, component) of those that are linked with others), from described() rows and the texts that they describe."""
    names = [f"w{w}" for w in range(words)]
    first = F.min(F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "text_hash")).alias("_")
    classes = materialise(prints.groupBy("rep").agg(first, F.first("size").alias("size"), F.first("bands").alias("bands"), *(F.first(n).alias(n) for n in names)).select("rep", "size", "bands", *names, "_.*"))
    keys = classes.where("size > 0").select("rep", F.posexplode("bands").alias("mask", "cell")).withColumn("mask", F.col("mask").cast("long"))
    sized = materialise(keys.groupBy("mask", "cell").agg(F.count(F.lit(1)).alias("n")).where("n > 1"))
    cells = materialise(keys.join(sized, ["mask", "cell"]).join(classes.select("rep", "size", *names), "rep").select("mask", "cell", "rep", "n", "size", *names))
    pairs = materialise(first_pairs(cells, words, reach))
    wanted = cells.select("rep").distinct().join(classes.select("rep", "doc_id", "text_hash"), "rep").select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"))
    here = docs.select("doc_id", "text").join(wanted, F.col("doc_id").cast("long").eqNullSafe(F.col("_id")) & (_text_hash() == F.col("_hash")), "left_semi")
    sets = materialise(shingle_sets(here, width).dropDuplicates(["rep"]))
    labels = materialise(components(similar(pairs, sets, least)).select(F.col("node").alias("rep"), F.col("component").alias("label")))
    tagged = materialise(cells.join(labels, "rep", "left").withColumn("label", F.coalesce("label", "rep")))
    more = rest_links(tagged, sets, words, reach, least)
    if more.isEmpty():
        return classes, labels.withColumnRenamed("label", "component")
    joined = components(more).select(F.col("node").alias("label"), "component")
    own = tagged.select("rep", "label").distinct().join(joined, "label", "left").select("rep", F.coalesce("component", "label").alias("component"))
    return classes, materialise(own)


def one_of_each(docs: DataFrame, width: int = 5, words: int = 4, reach: int = REACH, least: float = 0.8) -> DataFrame:
    """docs with one row of each group of near copies: that with the smallest doc_id (rows with one doc_id: by the hash of their text).

    Near copies are texts whose sets of five-word shingles have Jaccard similarity of at least least, and what such links join. Classes of equal sets go to cells by
    min-hash bands; in a cell, the Gray-order index over their fingerprints finds the candidates, and the sets decide.

    First each class is compared with its nearest, and with the middle of each cell; then all pairs in a cell that this has not joined, so that no link between
    two groups is left out, while the pairs of a large group, once it is joined, are never listed.

    Texts without words (null, empty or blank) are copies of each other. Rows without doc_id stay, as no group can be named after them. Of rows that are repeated
    with doc_id and text, one stays. All columns of docs come back, whatever their names.
    """
    columns = docs.columns
    prints = materialise(described(docs, width, words))
    classes, groups = near_groups(prints, docs, width, words, reach, least)
    own = F.struct("doc_id", "text_hash")
    of = classes.where(~F.col("nameless")).select("rep", own.alias("own")).join(groups, "rep", "left").withColumn("group", F.coalesce("component", "rep"))
    best = of.where("component is not null").groupBy("group").agg(F.min("own").alias("best"))
    of = of.join(best, "group", "left").select("rep", F.coalesce("best", "own").alias("best"))
    rows = prints.where("doc_id is not null").select("doc_id", "text_hash", "rep")
    gone = rows.join(of, "rep").where(own != F.col("best")).select("doc_id", "text_hash").distinct()
    again = materialise(rows.groupBy("doc_id", "text_hash").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("doc_id", "text_hash"))
    left, hash_ = private(columns, "id"), private(columns, "hash")
    hashed = docs.withColumns({left: F.col("doc_id").cast("long"), hash_: _text_hash()})
    at = lambda keys: keys.select(F.col("doc_id").alias(left), F.col("text_hash").alias(hash_))
    kept = hashed.join(materialise(at(gone)), [left, hash_], "left_anti")
    if not again.isEmpty():
        twice = kept.join(at(again), [left, hash_], "left_semi").dropDuplicates([left, hash_])
        kept = kept.join(at(again), [left, hash_], "left_anti").unionByName(twice.select(*kept.columns))
    return kept.select(*columns)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract columns: doc_id, fingerprint (16 hex digits), component_id."""
    out = near_duplicates(table(spark, sf_dir, "documents"))
    return out.select("doc_id", F.lower(F.lpad(F.hex("w0"), 16, "0")).alias("fingerprint"), "component_id")
