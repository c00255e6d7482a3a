"""Incremental, reversible line dedup: exact reference counts, with sharded cuckoo filters in front.

State of an index:

* counts (k1, k2, n): for each line key (128 bits of hash) the number of documents that hold it. Exact; inserting
  documents adds to it, deleting them subtracts, and keys at zero go, so a deletion undoes an insertion.
* filters (shard, n, payload): cuckoo filters over the hot keys only, those found in at least min_docs documents. A key
  that becomes hot is inserted into its shard, one that stops being hot is deleted from it.

A document's line is dropped if its key is hot. The filters answer that: a miss is certain, and the few keys of the index that a filter takes for hot by mistake are listed exactly
beside it. Up to a checked size, all filters go to every executor, and neither lines nor texts are shuffled; beyond it, the keys of the lines go to their filters instead, shard by shard.

Null and empty texts are one empty line, which has no key and stays. Every row counts as a document, repeated rows too.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimloom.llm.common import materialise, private, table

#: Bytes that a line's key loses at both ends; exactly what bytes.strip() takes.
SPACE = b" \t\n\x0b\x0c\r"
#: Hot keys in one filter, and slots in one bucket of it.
SHARD_KEYS, SLOTS = 50_000, 4
#: Bytes of all filters together that may be sent to every executor.
SEND_BYTES = 64 << 20
SECOND = 0x5BD1E995


# ---------------------------------------------------------------- the filter


class CuckooFilter:
    """32-bit fingerprints in buckets of four; a key's two buckets follow from each other, so keys can be moved and deleted."""

    def __init__(self, slots: np.ndarray):
        self.slots = slots  # (buckets, SLOTS) of uint32; zero: free

    @classmethod
    def sized(cls, keys: int) -> CuckooFilter:
        buckets = 1 << max(1, int(np.ceil(np.log2(max(1, keys) / (SLOTS * 0.8)))))
        return cls(np.zeros((buckets, SLOTS), np.uint32))

    @classmethod
    def loads(cls, payload: bytes) -> CuckooFilter:
        return cls(np.frombuffer(payload, np.uint32).reshape(-1, SLOTS).copy())

    def dumps(self) -> bytes:
        return self.slots.tobytes()

    def places(self, k1: np.ndarray, k2: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Fingerprint and both buckets of keys; the shard already took bits of k1, so the bucket takes its low bits."""
        mark = (k2.view(np.uint64) >> np.uint64(32)).astype(np.uint32)
        mark[mark == 0] = 1
        one = k1.view(np.uint64) & np.uint64(len(self.slots) - 1)
        return mark, one, self.other(one, mark)

    def other(self, bucket: np.ndarray, mark: np.ndarray) -> np.ndarray:
        step = (mark.astype(np.uint64) * np.uint64(SECOND)) >> np.uint64(7)
        return bucket ^ (step & np.uint64(len(self.slots) - 1))

    def contains(self, k1: np.ndarray, k2: np.ndarray) -> np.ndarray:
        mark, one, two = self.places(k1, k2)
        return (self.slots[one] == mark[:, None]).any(1) | (self.slots[two] == mark[:, None]).any(1)

    def insert(self, k1: np.ndarray, k2: np.ndarray) -> bool:
        """False if the filter is too full; it must then be built anew, larger."""
        for mark, one, two in zip(*(x.tolist() for x in self.places(k1, k2))):
            if not self._put(mark, one, two):
                return False
        return True

    def _put(self, mark: int, one: int, two: int) -> bool:
        for bucket in (one, two):
            free = np.flatnonzero(self.slots[bucket] == 0)
            if len(free):
                self.slots[bucket, free[0]] = mark
                return True
        bucket = two
        for kick in range(500):  # the mark that it displaces moves to its other bucket
            slot = (mark + kick) % SLOTS
            mark, self.slots[bucket, slot] = int(self.slots[bucket, slot]), mark
            bucket = int(self.other(np.array([bucket], np.uint64), np.array([mark], np.uint32))[0])
            free = np.flatnonzero(self.slots[bucket] == 0)
            if len(free):
                self.slots[bucket, free[0]] = mark
                return True
        return False

    def delete(self, k1: np.ndarray, k2: np.ndarray) -> None:
        """Takes out one copy of each key's mark; only keys that were inserted may be deleted."""
        for mark, one, two in zip(*(x.tolist() for x in self.places(k1, k2))):
            for bucket in (one, two):
                held = np.flatnonzero(self.slots[bucket] == mark)
                if len(held):
                    self.slots[bucket, held[0]] = 0
                    break


def _built(k1: np.ndarray, k2: np.ndarray) -> CuckooFilter:
    size = len(k1)
    while True:
        made = CuckooFilter.sized(size)
        if made.insert(k1, k2):
            return made
        size *= 2


def _shard(k1: np.ndarray, shards: int) -> np.ndarray:
    return ((k1.view(np.uint64) >> np.uint64(40)) % np.uint64(shards)).astype(np.int64)


# ---------------------------------------------------------------- lines


def line_keys(text: str | None, min_chars: int = 1) -> tuple[list[bytes], list[bytes | None]]:
    """Lines of a text as bytes, and their keys; None for keys of fewer code points than min_chars."""
    data = (text or "").encode("utf-8", "surrogatepass")
    lines = data.split(b"\n")
    keys = [x.strip(SPACE) for x in data.lower().split(b"\n")]  # bytes.lower() lowers A-Z alone
    if min_chars > 1:
        return lines, [k if len(k) >= min_chars and len(k.decode("utf-8", "surrogatepass")) >= min_chars else None for k in keys]
    return lines, [k if k or not min_chars else None for k in keys]


def _hashed(keys: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """128 bits of a key as two signed longs: at 10^11 keys an equal pair is still less likely than one in 10^15."""
    raw = np.frombuffer(b"".join([xxhash.xxh3_128_digest(k) for k in keys]), ">u8").astype(np.uint64).view(np.int64)
    return np.ascontiguousarray(raw[0::2]), np.ascontiguousarray(raw[1::2])


def line_counts(docs: DataFrame, min_chars: int = 1) -> DataFrame:
    """(k1, k2, n): the number of documents (rows) that hold each key; empty lines have no key."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                seen: list[bytes] = []
                for text in batch.column(0).slice(at, 1000):
                    seen += {k for k in line_keys(text.as_py(), min_chars)[1] if k is not None}
                k1, k2 = _hashed(seen)
                yield pa.RecordBatch.from_arrays([pa.array(k1), pa.array(k2)], names=["k1", "k2"])

    return docs.select("text").mapInArrow(run, "k1 long, k2 long").groupBy("k1", "k2").agg(F.count(F.lit(1)).alias("n"))


# ---------------------------------------------------------------- the index


@dataclass
class LineIndex:
    counts: DataFrame
    filters: DataFrame
    shards: int
    min_docs: int
    min_chars: int

    @classmethod
    def build(cls, docs: DataFrame, min_docs: int = 10, min_chars: int = 1) -> LineIndex:
        """Index of all rows of docs; each row counts as one document, repeated rows too."""
        counts = materialise(line_counts(docs, min_chars))
        hot = counts.where(F.col("n") >= min_docs)
        shards = max(1, -(-hot.count() // SHARD_KEYS))
        return cls(counts, _filters(hot, shards), shards, min_docs, min_chars)

    def insert(self, docs: DataFrame) -> LineIndex:
        return self._changed(line_counts(docs, self.min_chars))

    def delete(self, docs: DataFrame) -> LineIndex:
        """Takes out documents that were inserted before, given with the same texts; it is an error if the index doesn't hold all their lines."""
        return self._changed(line_counts(docs, self.min_chars).withColumn("n", -F.col("n")))

    def _changed(self, by: DataFrame) -> LineIndex:
        both = self.counts.withColumn("was", F.col("n")).unionByName(by.withColumn("was", F.lit(0).cast("long")))
        now = materialise(both.groupBy("k1", "k2").agg(F.sum("n").alias("n"), F.sum("was").alias("was")))
        if not now.where("n < 0").isEmpty():
            raise ValueError("documents are deleted that the index doesn't hold")
        counts, hot = now.where("n > 0").drop("was"), now.where(F.col("n") >= self.min_docs)
        many = hot.count()
        if many > 2 * self.shards * SHARD_KEYS:  # the filters would grow without end: more of them
            shards = -(-many // SHARD_KEYS)
            return LineIndex(counts, _filters(hot, shards), shards, self.min_docs, self.min_chars)
        crossed = now.where((F.col("n") >= self.min_docs) != (F.col("was") >= self.min_docs))
        filters = materialise(_updated(self.filters, crossed.withColumn("put", F.col("n") >= self.min_docs), self.shards))
        full = filters.where("payload is null").select("shard")
        if not full.isEmpty():  # these are built anew, larger, from the exact counts
            hot = hot.withColumn("shard", _shard_of(self.shards)).join(full, "shard", "left_semi")
            filters = materialise(filters.where("payload is not null").unionByName(_filters(hot, self.shards)))
        return LineIndex(counts, filters, self.shards, self.min_docs, self.min_chars)

    def apply(self, docs: DataFrame, send_bytes: int = SEND_BYTES, out: tuple[str, str] = ("n_lines", "n_dropped")) -> DataFrame:
        """docs (rows that the index holds) with text cut to the lines that stay, and the numbers of lines before and of dropped ones in the columns out, which replace
        columns of these names. Other columns stay as they are. send_bytes: filters of more bytes than that aren't sent to all executors."""
        size = self.filters.agg(F.sum(F.length("payload"))).first()[0] or 0
        if size > send_bytes:
            return self.sharded(docs, out)
        payloads = {r["shard"]: r["payload"] for r in self.filters.collect()}
        return _cut(docs, _by_filters(payloads, self.mistaken(payloads), self.shards), self.min_chars, out)

    def mistaken(self, payloads: dict[int, bytes]) -> set[tuple[int, int]]:
        """Keys of the index that a filter takes for hot though they aren't: about one in 500 million of its keys."""
        shards = self.shards

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            look = _Probe(payloads, shards)
            for batch in batches:
                k1, k2 = (np.ascontiguousarray(c.to_numpy(zero_copy_only=False)) for c in batch.columns)
                yield batch.filter(pa.array(look(k1, k2)))

        cold = self.counts.where(F.col("n") < self.min_docs).select("k1", "k2")
        return {(r[0], r[1]) for r in cold.mapInArrow(run, cold.schema).collect()}

    def sharded(self, docs: DataFrame, out: tuple[str, str] = ("n_lines", "n_dropped"), salts: int = 32) -> DataFrame:
        """The same decision by the same filters, each held by the task that the keys of its lines come to. A filter has salts copies, so that one very frequent line spreads.

        Texts are told apart by 128 bits of hash; equal ones share their decision."""
        keys = text_keys(docs, self.min_chars).withColumns({"shard": _shard_of(self.shards), "salt": F.pmod("d1", F.lit(salts)).cast("int")})
        filters = self.filters.select("shard", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt"), "payload")
        cold = self.counts.where(F.col("n") < self.min_docs).select(F.lit(0).cast("long").alias("d1"), F.lit(0).cast("long").alias("d2"), "k1", "k2", _shard_of(self.shards), F.pmod("k2", F.lit(salts)).cast("int").alias("salt"), F.lit(True).alias("cold"))
        rows = filters.unionByName(keys.withColumn("cold", F.lit(False)).unionByName(cold), allowMissingColumns=True).withColumn("at", F.col("payload").isNull())
        rows = rows.repartition(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), "shard", "salt").sortWithinPartitions("shard", "salt", "at")

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            at, now = None, None
            for batch in batches:
                shard, salt, filters_ = (batch.column(k).to_numpy(zero_copy_only=False) for k in (0, 1, 2))
                cut = [0, *(np.flatnonzero((shard[1:] != shard[:-1]) | (salt[1:] != salt[:-1]) | ~filters_[:-1]) + 1).tolist(), len(shard)]
                for lo, hi in zip(cut, cut[1:]):
                    if hi > lo and (where := (shard[lo], salt[lo])) != at:
                        at, now = where, None
                    if hi > lo and not filters_[lo]:
                        now = CuckooFilter.loads(batch.column(8)[lo].as_py())
                    elif hi > lo and now is not None:
                        part = batch.slice(lo, hi - lo)
                        k1, k2 = (np.ascontiguousarray(part.column(k).to_numpy(zero_copy_only=False)) for k in (5, 6))
                        yield part.select(["d1", "d2", "k1", "k2", "cold"]).filter(pa.array(now.contains(k1, k2)))

        hits = materialise(rows.select("shard", "salt", "at", "d1", "d2", "k1", "k2", "cold", "payload").mapInArrow(run, "d1 long, d2 long, k1 long, k2 long, cold boolean"))
        wrong = hits.where("cold").select("k1", "k2").distinct()
        each = hits.where("not cold").join(wrong, ["k1", "k2"], "left_anti").groupBy("d1", "d2").agg(F.collect_set(F.struct("k1", "k2")).alias("hot"))
        names = docs.columns
        d1, d2, hot = (private(names, n) for n in ("d1", "d2", "hot"))
        each = each.select(F.col("d1").alias(d1), F.col("d2").alias(d2), F.col("hot").alias(hot))
        return _cut(_with_text_hash(docs, d1, d2).join(each, [d1, d2], "left").drop(d1, d2), None, self.min_chars, out, hot)


def text_keys(docs: DataFrame, min_chars: int) -> DataFrame:
    """(d1, d2, k1, k2): the hash of each text with each key of its lines."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 1000):
                batch = whole.slice(at, 1000)
                seen = [list({k for k in line_keys(t.as_py(), min_chars)[1] if k is not None}) for t in batch.column(0)]
                n = list(map(len, seen))
                d = [np.repeat(x, n) for x in _text_hashes(batch.column(0))]
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in (*d, *_hashed([k for keys in seen for k in keys]))], names=["d1", "d2", "k1", "k2"])

    return docs.select("text").mapInArrow(run, "d1 long, d2 long, k1 long, k2 long").distinct()


def _text_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    return _hashed([(t.as_py() or "").encode("utf-8", "surrogatepass") for t in texts])


def _with_text_hash(docs: DataFrame, d1: str, d2: str) -> DataFrame:
    """docs with the hash of the text in the columns d1 and d2."""
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = _text_hashes(batch.column(batch.schema.get_field_index("text")))
            yield pa.RecordBatch.from_arrays([*batch.columns, *map(pa.array, found)], names=[*names, d1, d2])

    return docs.mapInArrow(run, ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields), f"`{d1}` long", f"`{d2}` long"]))


class _Probe:
    """Membership of keys in sharded filters, for one task."""

    def __init__(self, payloads: dict[int, bytes], shards: int):
        self.parts = {s: CuckooFilter.loads(p) for s, p in payloads.items()}
        self.shards = shards

    def __call__(self, k1: np.ndarray, k2: np.ndarray) -> np.ndarray:
        out = np.zeros(len(k1), bool)
        shard = _shard(k1, self.shards)
        for s, part in self.parts.items():
            at = np.flatnonzero(shard == s) if self.shards > 1 else slice(None)
            out[at] = part.contains(k1[at], k2[at])
        return out


def _by_filters(payloads: dict[int, bytes], wrong: set[tuple[int, int]], shards: int):
    def made():
        look = _Probe(payloads, shards)

        def hot(k1: np.ndarray, k2: np.ndarray) -> np.ndarray:
            out = look(k1, k2)
            if wrong:
                for i in np.flatnonzero(out).tolist():
                    out[i] = (int(k1[i]), int(k2[i])) not in wrong
            return out

        return hot

    return made


def _cut(docs: DataFrame, made, min_chars: int, out: tuple[str, str], given: str | None = None) -> DataFrame:
    """Drops hot lines; made() gives the test of keys, or each row brings its hot keys in the column given."""
    plain = [f for f in docs.schema.fields if f.name != given and f.name.lower() not in {n.lower() for n in out}]
    names = [f.name for f in plain]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hot = made() if made else None
        for whole in batches:
            for at in range(0, whole.num_rows, 500):
                batch = whole.slice(at, 500)
                texts = [x.as_py() for x in batch.column(batch.schema.get_field_index("text"))]
                split = [line_keys(t, min_chars) for t in texts]
                k1, k2 = _hashed([k for _, keys in split for k in keys if k is not None])
                if given:
                    sets = [{(h["k1"], h["k2"]) for h in s or ()} for s in batch.column(batch.schema.get_field_index(given)).to_pylist()]
                    owner = [i for i, (_, keys) in enumerate(split) for k in keys if k is not None]
                    drop = iter([(a, b) in sets[i] for a, b, i in zip(k1.tolist(), k2.tolist(), owner)])
                else:
                    drop = iter(hot(k1, k2).tolist())
                kept, n, gone = [], [], []
                for text, (lines, keys) in zip(texts, split):
                    stay = [x for x, k in zip(lines, keys) if k is None or not next(drop)]
                    n.append(len(lines))
                    gone.append(len(lines) - len(stay))
                    kept.append(text if len(stay) == len(lines) else b"\n".join(stay).decode("utf-8", "surrogatepass"))
                columns = [pa.array(kept, pa.string()) if c == "text" else batch.column(batch.schema.get_field_index(c)) for c in names]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(n, pa.int64()), pa.array(gone, pa.int64())], names=[*names, *out])

    ddl = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in plain), *(f"`{n}` long" for n in out)])
    return docs.select(*names, *([given] if given else [])).mapInArrow(run, ddl)


def _shard_of(shards: int):
    return F.pmod(F.shiftrightunsigned("k1", 40), F.lit(shards)).cast("long").alias("shard")


def _filters(hot: DataFrame, shards: int) -> DataFrame:
    def build(pdf):
        import pandas as pd

        made = _built(pdf["k1"].to_numpy(), pdf["k2"].to_numpy())
        return pd.DataFrame({"shard": [pdf["shard"].iloc[0]], "n": [len(pdf)], "payload": [made.dumps()]})

    keyed = hot.select("k1", "k2", _shard_of(shards))
    return materialise(keyed.groupBy("shard").applyInPandas(build, "shard long, n long, payload binary"))


def _updated(filters: DataFrame, crossed: DataFrame, shards: int) -> DataFrame:
    """Filters after keys became hot (put) or stopped being so; payload is null for a shard that got too full."""

    def change(key, old, keys):
        import pandas as pd

        made = CuckooFilter.loads(old["payload"].iloc[0]) if len(old) else CuckooFilter.sized(1)
        out, new = keys[~keys["put"]], keys[keys["put"]]
        made.delete(out["k1"].to_numpy(), out["k2"].to_numpy())
        n = (int(old["n"].iloc[0]) if len(old) else 0) + len(new) - len(out)
        fits = n <= 0.9 * made.slots.size and made.insert(new["k1"].to_numpy(), new["k2"].to_numpy())
        return pd.DataFrame({"shard": [key[0]], "n": [n], "payload": [made.dumps() if fits else None]})

    keyed = crossed.select("k1", "k2", "put", _shard_of(shards))
    return filters.groupBy("shard").cogroup(keyed.groupBy("shard")).applyInPandas(change, "shard long, n long, payload binary")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract columns: doc_id, n_lines (before dropping), n_dropped, kept_sha256."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    kept = LineIndex.build(docs).apply(docs)
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce(F.col("text"), F.lit("")), 256).alias("kept_sha256"))


ORACLE = r"""
WITH l AS (
  SELECT rowid AS r, doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS i
  FROM (SELECT row_number() OVER () AS rowid, doc_id, text FROM documents)),
k AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k FROM l),
hot AS (SELECT k FROM k WHERE k <> '' GROUP BY k HAVING count(DISTINCT r) >= 10)
SELECT any_value(k.doc_id) AS doc_id, count(*) AS n_lines, count(hot.k) AS n_dropped, sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE hot.k IS NULL), '')) AS kept_sha256
FROM k LEFT JOIN hot ON k.k = hot.k GROUP BY r
"""
