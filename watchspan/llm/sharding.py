"""Shards by jump consistent hashing, with gapless slots inside each shard.

The jump hash walks a pseudo-random sequence that only depends on the key; the last jump below the number of shards is the
shard. One more shard therefore takes its rows from all others and moves no row between them. There is no table of
points, and a row's shard needs no other row. All is built from column expressions; the sequence's 64-bit
multiplication is put together from 32-bit halves, since Spark's arithmetic does not wrap around.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

_MULTIPLIER = 2862933555777941757  # fixed value of the published algorithm
_LOW = (1 << 32) - 1


def _step(high: Column, low: Column) -> tuple[Column, Column]:
    """The next state of the sequence, state * multiplier + 1 modulo 2^64, in halves of 32 bits."""
    m_high, m_low = _MULTIPLIER >> 32, _MULTIPLIER & _LOW
    half = F.lit(0xFFFF)
    p0 = low.bitwiseAND(half) * F.lit(m_low) + F.lit(1)
    p1 = F.shiftright(low, 16) * F.lit(m_low)
    t = p0 + F.shiftleft(p1.bitwiseAND(half), 16)
    carry = F.shiftright(t, 32) + F.shiftright(p1, 16)

    def low_product(x: Column, y: int) -> Column:
        return (x.bitwiseAND(half) * F.lit(y)).bitwiseAND(F.lit(_LOW)) + F.shiftleft((F.shiftright(x, 16) * F.lit(y)).bitwiseAND(half), 16)

    top = carry + low_product(high, m_low) + low_product(low, m_high)
    return top.bitwiseAND(F.lit(_LOW)), t.bitwiseAND(F.lit(_LOW))


def jump_shards(key: Column, shards: int) -> Column:
    """struct(shard, grown): the shard of a long key among `shards` and among one more. A null key counts as 0.

    Each step moves to a higher shard, so `shards + 1` steps suffice; steps after the last jump do nothing.
    """
    if shards < 1:
        raise ValueError("at least one shard")
    key = F.coalesce(key.cast("long"), F.lit(0).cast("long"))
    zero = F.lit(0).cast("long")
    start = F.struct(
        F.shiftrightunsigned(key, 32).alias("high"), key.bitwiseAND(F.lit(_LOW)).alias("low"), zero.alias("next"), zero.alias("shard"), zero.alias("grown")
    )

    def step(s: Column, _: Column) -> Column:
        high, low = _step(s["high"], s["low"])
        at = s["next"]
        ahead = F.floor((at + 1) * (F.lit(float(1 << 31)) / (F.shiftright(high, 1) + 1).cast("double"))).cast("long")
        moved = F.struct(
            high.alias("high"), low.alias("low"), ahead.alias("next"), F.when(at < shards, at).otherwise(s["shard"]).alias("shard"), at.alias("grown")
        )
        return F.when(at > shards, s).otherwise(moved)

    done = F.aggregate(F.sequence(F.lit(0), F.lit(shards)), start, step)
    return F.struct(done["shard"].cast("int").alias("shard"), done["grown"].cast("int").alias("grown"))


def shard_by_key(docs: DataFrame, shards: int, key: str = "doc_id", text: str = "text", buckets: int = 4096) -> DataFrame:
    """One row per row of docs: the key, size (UTF-8 bytes of the text plus 8), text_crc32, law, shard, slot, grown_shard.

    Law `key`: the key and the number of shards decide. Slots count the rows of a shard from 0 without gaps, by bucket of
    the key's crc32, key (null first), checksum and size; rows equal in all of these are interchangeable. Slots are numbered
    inside buckets, whose starts come from counts per bucket (at most shards * buckets rows) over the keys alone, so no
    task sees a whole shard. A null text has size 8 and the checksum 0 of empty bytes; a null key has a shard of its own key 0.
    """
    bucket = (F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")) % buckets).cast("int")
    at = F.col("_at")
    placed = docs.select(F.col(f"`{key}`").alias(key), jump_shards(F.col(f"`{key}`"), shards).alias("_at"))
    counts = placed.groupBy(at["shard"].alias("shard"), bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("shard", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    raw = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    rows = docs.select(
        F.col(f"`{key}`").alias(key), (F.octet_length(raw) + 8).cast("long").alias("size"), F.crc32(raw.cast("binary")).alias("text_crc32"),
        jump_shards(F.col(f"`{key}`"), shards).alias("_at"),
    )
    rows = rows.select(key, "size", "text_crc32", at["shard"].alias("shard"), at["grown"].alias("grown_shard"), bucket.alias("bucket"))
    inside = Window.partitionBy("shard", "bucket").orderBy(F.col(key).asc_nulls_first(), "text_crc32", "size")
    rows = rows.withColumn("inside", F.row_number().over(inside) - 1).join(starts, ["shard", "bucket"])
    return rows.select(key, "size", "text_crc32", F.lit("key").alias("law"), "shard", (F.col("start") + F.col("inside")).cast("long").alias("slot"), "grown_shard")


def crc32_sql(bytes_sql: str) -> str:
    """crc32 of a BLOB-valued expression in DuckDB, from its hexadecimal digits and the table of the reflected polynomial."""
    table = []
    for i in range(256):
        for _ in range(8):
            i = (i >> 1) ^ (0xEDB88320 if i & 1 else 0)
        table.append(i)
    digits = f"list_transform(regexp_extract_all(hex({bytes_sql}), '..'), lambda d: ('0x' || d)::BIGINT)"
    step = f"lambda c, b: xor(c >> 8, {table}[(xor(c, b) & 255) + 1])"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {digits}), {step}), 4294967295)"


def sharding_sql(shards: int, buckets: int = 4096) -> str:
    return f"""
WITH RECURSIVE base AS (
  SELECT row_number() OVER () AS rid, doc_id, strlen(coalesce(text, '')) + 8 AS size,
         {crc32_sql("encode(coalesce(text, ''))")} AS text_crc32,
         {crc32_sql("encode(coalesce(doc_id::VARCHAR, ''))")} % {buckets} AS bucket,
         CASE WHEN coalesce(doc_id, 0) < 0 THEN doc_id::HUGEINT + 18446744073709551616 ELSE coalesce(doc_id, 0)::HUGEINT END AS key
  FROM documents),
walk(rid, key, place, nxt) AS (
  SELECT rid, key, -1::BIGINT, 0::BIGINT FROM base
  UNION ALL
  SELECT rid, k, nxt, floor((nxt + 1) * (2147483648.0::DOUBLE / ((k // 8589934592) + 1)::DOUBLE))::BIGINT
  FROM (SELECT rid, nxt, ((key % 18446744073709551616) * {_MULTIPLIER}::HUGEINT + 1) % 18446744073709551616 AS k FROM walk WHERE nxt <= {shards})),
ends AS (SELECT rid, max(place) FILTER (WHERE place < {shards}) AS shard, max(place) AS grown FROM walk WHERE place >= 0 GROUP BY rid)
SELECT doc_id, size::BIGINT AS size, text_crc32::BIGINT AS text_crc32, 'key' AS law, shard::INTEGER AS shard,
       (row_number() OVER (PARTITION BY shard ORDER BY bucket, doc_id NULLS FIRST, text_crc32, size) - 1)::BIGINT AS slot, grown::INTEGER AS grown_shard
FROM base JOIN ends USING (rid)"""
