"""Shards by proportional stratified interleaving, in DataFrame operations only.

Rows of each source are shuffled with a seed and ranked; a row's place is its fractional rank (rank + 1/2) / rows of its source. In the order of these
places every stretch holds the sources in their shares, so equal cuts of it give shards that all match the mixture. Ranks come from counts of small
buckets (see common.ranked): no task holds a whole source, and only keys are shuffled, not texts, if the caller leaves them out.

The law is 'rows': shard counts differ by at most one. Null sources are one source of their own; rows are never dropped; equal rows have
places of their own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimloom.llm.common import fraction_bucket, materialise, private, ranked, table

SHARDS, SEED = 24, 17
#: Rows of one bucket, the unit that is sorted in one piece.
BUCKET = 256


def interleave(rows: DataFrame, shards: int, stratum: str = "source", key: list[str] | None = None, seed: int = SEED, out: tuple[str, str] = ("shard", "slot")) -> DataFrame:
    """rows with their shard (0 to shards - 1) and slot (from 0 in each shard), in the columns out, which replace columns of these names.

    key: the columns that tell rows apart for the seeded shuffle; rows that are equal there take neighbouring places, in no fixed order. Empty tables give empty ones.
    """
    rows = rows.drop(*out)
    names = rows.columns
    s, h, b, rank, size, place, at, shard = (private(names, n) for n in ("stratum", "mixed", "bucket", "rank", "size", "place", "at", "shard"))
    mixed = F.md5(F.concat_ws("|", F.lit(seed), *(F.coalesce(F.col(c).cast("string"), F.lit("")) for c in key or names)))
    source = F.concat(F.when(F.col(stratum).isNull(), "0").otherwise("1"), F.coalesce(F.col(stratum).cast("string"), F.lit("")))
    base = materialise(rows.withColumns({s: source, h: mixed}))
    total = base.count()
    buckets = max(1, total // BUCKET)
    inner = ranked(base.withColumn(b, fraction_bucket(F.col(h), buckets)), [s], b, [h], rank).drop(b)
    placed = inner.join(base.groupBy(s).agg(F.count(F.lit(1)).alias(size)), s).withColumn(place, (F.col(rank) + 0.5) / F.col(size))
    whole = ranked(placed.withColumn(b, F.floor(F.col(place) * buckets).cast("long")), [], b, [place, h, s], at)
    first = F.expr(f"({shard} * {max(1, total)} + {shards - 1}) div {shards}")
    whole = whole.withColumn(shard, F.expr(f"{at} * {shards} div {max(1, total)}"))
    return whole.select(*names, F.col(shard).cast("int").alias(out[0]), (F.col(at) - first).cast("long").alias(out[1]))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract columns: doc_id, size, text_crc32, law, shard, slot, grown_shard; and source."""
    data = F.encode(F.coalesce("text", F.lit("")), "UTF-8")
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", (F.octet_length(data) + 8).cast("long").alias("size"), F.crc32(data).alias("text_crc32"))
    out = interleave(docs, SHARDS, key=["doc_id", "text_crc32", "size"])
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "source")
