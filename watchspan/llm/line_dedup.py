"""Lines that many documents share, kept in one of them: a range-partitioned sort of line hashes that yields keep bitmaps.

Only hashes travel: every long enough line becomes (hash, document, position). The hashes are dealt out by ranges and
sorted by hash and document, the largest document first; the first document of a hash keeps its lines, the lines of all
later ones are dropped. What comes back is no text but a bitmap per document, without the words of it that keep all lines.
Column expressions only.

A hash with at least a thousandth of all lines would fill a task. Such hashes, a thousand at most, are found by a sketch over
all lines and also ranged by a salt of their document; the salts of one hash are put together by a summary that
has one row per such hash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from watchspan.llm.common import stored

LEAST_CHARS, LEAST_DOCS = 40, 5
SALTS = 64
_HOT = 1000  # a hash is hot from one in so many lines on, so there are at most so many
_SPACE = " \t\n\x0b\x0c\r"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def line_key(line: Column) -> Column:
    """The line without white space at both ends, A-Z in lower case."""
    return F.translate(F.btrim(line, F.lit(_SPACE)), _UPPER, _LOWER)


def split_lines(text: Column) -> Column:
    """The lines of a text; a null or empty one has one empty line."""
    return F.split(F.coalesce(text, F.lit("")), "\n")


def _own(docs: DataFrame, key: str, text: str) -> list[Column]:
    """What names a row: its id, and a hash of its text since rows may share an id."""
    return [F.col(f"`{key}`").alias("id"), F.xxhash64(F.coalesce(F.col(f"`{text}`"), F.lit(""))).alias("version")]


def keep_bitmaps(
    docs: DataFrame, key: str = "doc_id", text: str = "text", least_chars: int = LEAST_CHARS, least_docs: int = LEAST_DOCS
) -> DataFrame:
    """(id, version, keep) of the documents that lose lines: keep is an array of (word, bits).

    Bit b of word w is 1 where line 64 * w + b stays; words that are missing keep all their lines. A line whose key has at
    least `least_chars` code points and occurs in at least `least_docs` documents stays only in the largest id that holds
    it, there with all its repeats. Rows with one id are one document; rows without an id are together one, the least.
    `version` is the hash of the row's text: rows with the same id and text share a bitmap.
    """
    line = F.col("line")
    lines = docs.select(*_own(docs, key, text), F.posexplode(F.transform(split_lines(F.col(f"`{text}`")), line_key)).alias("pos", "line"))
    lines = lines.filter(F.length(line) >= least_chars)
    lines = stored(lines.select("id", "version", "pos", F.xxhash64(line).alias("high"), F.xxhash64(F.lit(1), line).alias("low")), "line-hashes")

    seen = lines.agg(F.expr(f"approx_top_k(high, {_HOT}, {10 * _HOT})").alias("top"), F.count(F.lit(1)).alias("n")).first()
    hot = [r["item"] for r in seen["top"] or [] if r["count"] * _HOT >= seen["n"]]
    salt = F.when(F.col("high").isin(hot), F.pmod(F.xxhash64("id"), F.lit(SALTS)).cast("int")) if hot else F.lit(None).cast("int")
    dealt = lines.withColumn("salt", F.coalesce(salt, F.lit(-1))).repartitionByRange("high", "salt")

    # the range of (high, salt) already holds every group of the windows, so they add a sort and no shuffle
    group = Window.partitionBy("high", "salt", "low")
    turn = F.dense_rank().over(group.orderBy(F.col("id").desc_nulls_last()))
    ranked = dealt.withColumn("turn", turn).withColumn("n_docs", F.max("turn").over(group))
    salted = F.col("salt") >= 0
    found = stored(ranked.filter(salted | ((F.col("n_docs") >= least_docs) & (F.col("turn") > 1))), "shared-lines")

    parts = found.filter(salted & (F.col("turn") == 1)).groupBy("high", "low", "salt").agg(F.max("n_docs").alias("n_docs"), F.max("id").alias("top"))
    whole = parts.groupBy("high", "low").agg((F.sum("n_docs") >= least_docs).alias("often"), F.max("top").alias("top"))
    later = F.when(F.col("id").isNull(), F.col("top").isNotNull()).otherwise(F.col("id") < F.col("top"))
    dropped = found.join(F.broadcast(whole), ["high", "low"], "left").filter(~salted | (F.col("often") & later))

    words = dropped.groupBy("id", "version", F.shiftright("pos", 6).alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, pos & 63)")).alias("gone"))
    bitmap = F.sort_array(F.collect_list(F.struct("word", F.bitwise_not("gone").alias("bits"))))
    return words.groupBy("id", "version").agg(bitmap.alias("keep"))


def apply_bitmaps(docs: DataFrame, bitmaps: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of docs: the key, n_lines, n_dropped, keep (null where nothing is dropped) and the kept text."""
    # the lines are made below the join: above it they would be split again for every line kept
    rows = docs.select(*_own(docs, key, text), split_lines(F.col(f"`{text}`")).alias("lines"))
    maps = bitmaps.select(F.col("id").alias("of_id"), F.col("version").alias("of_version"), "keep")
    rows = rows.join(maps, F.col("id").eqNullSafe(F.col("of_id")) & (F.col("version") == F.col("of_version")), "left")
    gone = F.expr("flatten(transform(keep, w -> transform(filter(sequence(0, 63), b -> shiftrightunsigned(w.bits, b) & 1L = 0L), b -> w.word * 64 + b)))")
    stay = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), gone)
    kept = F.when(F.col("keep").isNull(), F.col("lines")).otherwise(F.transform(stay, lambda i: F.get("lines", i)))
    lost = F.aggregate("keep", F.lit(0), lambda n, w: n + 64 - F.bit_count(w["bits"]))
    return rows.select(
        F.col("id").alias(key), F.size("lines").cast("long").alias("n_lines"), F.coalesce(lost, F.lit(0)).cast("long").alias("n_dropped"),
        "keep", F.array_join(kept, "\n").alias("kept_text"),
    )


def dedup_lines(docs: DataFrame, key: str = "doc_id", text: str = "text", least_chars: int = LEAST_CHARS, least_docs: int = LEAST_DOCS) -> DataFrame:
    """The documents without repeated lines: key, n_lines, n_dropped, keep, kept_text. Other columns are left out."""
    return apply_bitmaps(docs, keep_bitmaps(docs, key, text, least_chars, least_docs), key, text)


def lines_sql(least_chars: int = LEAST_CHARS, least_docs: int = LEAST_DOCS) -> str:
    space = " || ".join(f"chr({ord(c)})" for c in _SPACE)
    return f"""
WITH docs AS (SELECT row_number() OVER () AS rid, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
lines AS (SELECT rid, doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS pos FROM docs),
keyed AS (SELECT *, translate(trim(line, {space}), '{_UPPER}', '{_LOWER}') AS key FROM lines),
often AS (
  SELECT key, max(doc_id) AS top FROM keyed WHERE length(key) >= {least_chars}
  GROUP BY key HAVING count(DISTINCT doc_id) + max((doc_id IS NULL)::INTEGER) >= {least_docs}),
told AS (
  SELECT rid, doc_id, line, pos, often.key IS NOT NULL AND (CASE WHEN doc_id IS NULL THEN top IS NOT NULL ELSE doc_id < top END) AS gone
  FROM keyed LEFT JOIN often USING (key))
SELECT doc_id, count(*) AS n_lines, count_if(gone)::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM told GROUP BY rid, doc_id"""
