"""Packing of tokenised documents into fixed windows by minimum bin slack.

1. One pass tokenises every document and cuts it: whole windows first, then one rest shorter than a window.
2. Only how many rests there are of each length goes to the driver: at most window counts, however large the corpus is.
3. The plan fills one window pattern after another: seeded with the longest length that is left, a bitset subset-sum over the
   remaining-length multiset finds the sums that can be reached, and the one closest to the capacity is traced back into
   counts of lengths. A pattern is used as often as the counts allow, so there are about as many patterns as lengths.
4. Pieces of one length are numbered on the executors; number and plan give each its sequence and offset.
"""

from __future__ import annotations

import functools
import json
import re
import sys
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimloom.llm.common import fraction_bucket, materialise, private, ranked, table

WINDOW, SEPARATOR = 2048, 1
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
#: Pieces of text that a worker remembers the ids of, and characters of one at most.
REMEMBER, LONGEST = 300_000, 256
#: Marks by which a worker knows pieces that it has met before (by hash: a false mark costs room only).
MET = 1 << 22

# Characters whose classes are the same in any Unicode version; a text with others is left whole to the tokenizer.
_LETTER = "A-Za-zªµºÀ-ÖØ-öø-ɏ"
_NUMBER = "0-9²³¹¼-¾"
_ODD = re.compile("[^\t\n\r\x0b\x0c\x20-\x7e¡-ɏ]")
_PIECES = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d| ?[{_LETTER}]+| ?[{_NUMBER}]+| ?[^\\s{_LETTER}{_NUMBER}]+|\\s+(?!\\S)|\\s+")


def packed(ids: list[int]) -> bytes:
    """Ids as little-endian unsigned 32-bit numbers."""
    out = array("I", ids)
    if sys.byteorder == "big":
        out.byteswap()
    return out.tobytes()


class Ids:
    """Ids of texts by a byte-level BPE tokenizer file, as packed little-endian unsigned 32-bit numbers.

    Pieces that the tokenizer's own pre-tokeniser would cut are looked up in a bounded memory; only new ones, and whole texts with
    characters outside the classes above, very long pieces or a special token, go through the tokenizer.
    """

    def __init__(self, path: str, remember: int = REMEMBER):
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        kind = spec.get("pre_tokenizer") or {}
        self.special = [x["content"] for x in spec.get("added_tokens", [])]
        self.plain = not spec.get("normalizer") and kind.get("type") == "ByteLevel" and not kind.get("add_prefix_space") and kind.get("use_regex", True)
        self.tokenizer = Tokenizer.from_file(path)
        self.remember, self.new, self.old = remember, {}, {}
        self.met, self.marks = bytearray(MET), 0

    def whole(self, text: str) -> bytes:
        return packed(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def __call__(self, text: str) -> bytes:
        if not self.plain or _ODD.search(text) or any(s in text for s in self.special):
            return self.whole(text)
        ids = self._joined(_PIECES.findall(text))
        return self.whole(text) if ids is None else ids

    def _joined(self, pieces: list[str]) -> bytes | None:
        """The ids of the pieces one after the other; None if some piece is too long."""
        got = list(map(self.new.get, pieces))
        if None in got:
            missing = {p for p, ids in zip(pieces, got) if ids is None}
            if max(map(len, missing)) > LONGEST:
                return None
            found = self._found(missing)
            got = [found[p] if ids is None else ids for p, ids in zip(pieces, got)]
        return b"".join(got)

    def _found(self, missing: set[str]) -> dict[str, bytes]:
        """The ids of pieces that the memory's newer half lacks. Pieces that were asked for before are remembered; those that are met once, as most are, take no room."""
        out, ask = {}, []
        for p in missing:
            if (ids := self.old.get(p)) is None:
                ask.append(p)
            else:
                out[p] = self.new[p] = ids
        for p, e in zip(ask, self.tokenizer.encode_batch_fast(ask, add_special_tokens=False)):
            out[p] = packed(e.ids)
            at = hash(p) % MET
            if self.met[at]:
                self.new[p] = out[p]
            else:
                self.met[at], self.marks = 1, self.marks + 1
        if len(self.new) > self.remember:  # the older half goes
            self.old, self.new = self.new, {}
        if self.marks > MET // 2:
            self.met, self.marks = bytearray(MET), 0
        return out


@functools.lru_cache(maxsize=1)
def ids_of(path: str, remember: int) -> Ids:
    """One for each tokenizer file and worker process: what it remembers serves the tasks that follow there."""
    return Ids(path, remember)


def pieces(docs: DataFrame, tokenizer: str = TOKENIZER, window: int = WINDOW, separator: int = SEPARATOR, with_ids: bool = False, remember: int = REMEMBER) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens[, ids]): each document's ids and the separator, cut into pieces of at most window ids; null text: empty.

    tokenizer: a file that is at the same path on every machine. remember: pieces whose ids a worker holds, twice, some 200 bytes each.
    """
    end = np.array([separator], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = ids_of(tokenizer, remember)
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                batch = whole.slice(at, 256)
                out: list[tuple] = []
                for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                    data = ids(text.as_py() or "") + end
                    n = len(data) // 4
                    for start in range(0, n, window):
                        part = data[4 * start : 4 * (start + window)]
                        out.append((doc, start, len(part) // 4, zlib.crc32(part), n, part))
                columns = list(zip(*out)) or [()] * 6
                arrays = [pa.array(c, pa.int64()) for c in columns[:5]]
                if with_ids:
                    arrays.append(pa.array([np.frombuffer(x, "<u4").astype(np.int32) for x in columns[5]], pa.list_(pa.int32())))
                yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", *["ids"] * with_ids])
            pa.default_memory_pool().release_unused()

    kind = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long" + ", ids array<int>" * with_ids
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, kind)


# ---------------------------------------------------------------- the plan


def closest(lengths: list[int], counts: list[int], capacity: int) -> dict[int, int]:
    """The sub-multiset of lengths whose sum is closest to capacity from below: {length: count}.

    reach[k] is the bitset of the sums of the first k chunks. A length's count is split into chunks of 1, 2, 4, ... copies, so any
    count can be made. It stops as soon as the capacity itself is reached.
    """
    full = (1 << capacity + 1) - 1
    reach, chunks = [1], []
    for length, count in zip(lengths, counts):
        count, step = min(count, capacity // length), 1
        while count > 0:
            take = min(step, count)
            chunks.append((length, take))
            reach.append((reach[-1] | reach[-1] << length * take) & full)
            count, step = count - take, 2 * step
        if reach[-1] >> capacity & 1:
            break
    left, out = reach[-1].bit_length() - 1, {}
    for k in range(len(chunks), 0, -1):  # a chunk is in if the sum can't be reached without it
        if not reach[k - 1] >> left & 1:
            length, take = chunks[k - 1]
            out[length] = out.get(length, 0) + take
            left -= length * take
    return out


def plan(histogram: dict[int, int], window: int) -> list[tuple[dict[int, int], int]]:
    """[({length: count}, times)]: patterns that use up the histogram. The longest length that is left seeds each pattern."""
    left = {k: v for k, v in sorted(histogram.items(), reverse=True) if v > 0}
    out = []
    while left:
        seed = next(iter(left))
        rest = {k: v - (k == seed) for k, v in left.items() if k <= window - seed}
        lengths = [k for k in rest if rest[k]]
        pattern = closest(lengths, [rest[k] for k in lengths], window - seed)
        pattern[seed] = pattern.get(seed, 0) + 1
        times = min(left[k] // v for k, v in pattern.items())
        out.append((pattern, times))
        for k, v in pattern.items():
            left[k] -= v * times
            if not left[k]:
                del left[k]
    return out


def _lookup(patterns: list[tuple[dict[int, int], int]]) -> dict[int, np.ndarray]:
    """For each length, rows (first number, copies in a pattern, first sequence, first offset) in the order of numbers."""
    rows: dict[int, list] = {}
    taken: dict[int, int] = {}
    sequence = 0
    for pattern, times in patterns:
        offset = 0
        for length in sorted(pattern, reverse=True):
            copies = pattern[length]
            at = taken.get(length, 0)
            rows.setdefault(length, []).append((at, copies, sequence, offset))
            taken[length] = at + copies * times
            offset += length * copies
        sequence += times
    return {k: np.array(v, np.int64) for k, v in rows.items()}


def placed(parts: DataFrame, window: int = WINDOW) -> DataFrame:
    """parts (with a column length) and their sequence_id and offset, which replace columns of these names: sequences without gaps from 0, offsets without gaps."""
    parts = materialise(parts.drop("sequence_id", "offset"))
    counts = {r["length"]: r["n"] for r in parts.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}  # at most window rows
    lookup = _lookup(plan(counts, window))
    names = parts.columns
    h, b, at_ = (private(names, n) for n in ("mixed", "bucket", "rank"))
    buckets = max(1, sum(counts.values()) // 256)
    mixed = parts.withColumn(h, F.md5(F.concat_ws("|", "doc_id", "start", "ids_crc32")))
    numbered = ranked(mixed.withColumn(b, fraction_bucket(F.col(h), buckets)), ["length"], b, [h], at_)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length = batch.column(batch.schema.get_field_index("length")).to_numpy(zero_copy_only=False)
            rank = batch.column(batch.schema.get_field_index(at_)).to_numpy(zero_copy_only=False)
            sequence, offset = np.empty(len(rank), np.int64), np.empty(len(rank), np.int64)
            for k in np.unique(length).tolist():
                at, rows = np.flatnonzero(length == k), lookup[k]
                row = rows[np.searchsorted(rows[:, 0], rank[at], side="right") - 1]
                inside = rank[at] - row[:, 0]
                sequence[at], offset[at] = row[:, 2] + inside // row[:, 1], row[:, 3] + inside % row[:, 1] * k
            yield pa.RecordBatch.from_arrays([*(batch.column(batch.schema.get_field_index(c)) for c in names), pa.array(sequence), pa.array(offset)], names=[*names, "sequence_id", "offset"])

    ddl = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in parts.schema.fields), "sequence_id long", "offset long"])
    return numbered.select(*names, at_).mapInArrow(run, ddl)


def pack(docs: DataFrame, tokenizer: str = TOKENIZER, window: int = WINDOW, separator: int = SEPARATOR, with_ids: bool = True, remember: int = REMEMBER) -> DataFrame:
    """Every piece of every document with its place, and with its ids. Repeated rows are packed as often as they are there."""
    return placed(pieces(docs, tokenizer, window, separator, with_ids, remember), window)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract columns: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    return pack(table(spark, sf_dir, "documents"), with_ids=False)
