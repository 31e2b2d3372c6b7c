"""Document fingerprints as invertible Bloom lookup sketches of paragraph digests.

A text is cut where its own content says so: after a line break, and after a word whose hash is a multiple of eight. So an
edit changes only the paragraphs it touches. Each paragraph has a 64-bit digest of its bytes and its occurrence number in
the text. A sketch holds cells of (count, sum of keys, sum of checks); a key goes to one cell in each of three parts.

Two versions are compared by subtracting their sketches cell by cell. Common paragraphs cancel; a cell left with one key
gives it away, taking that key out lays open others, and when all cells are empty the keys taken out are exactly the
paragraphs that differ. If some cells stay full, the sketches were too small for the difference, and both are built again
with four times the cells. All pairs of a slice of rows are peeled together.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.types import StructType

from watchspan.llm.common import _BYTE, _SPACE, flat, mix, run_hashes, slices, unused
from watchspan.operators.rank import global_rank

CELLS, GROWTH, PARTS = 24, 4, 3
SLICE_BYTES = 1 << 20
_CHECK = np.uint64(0x8EBC6AF09C88C6E3)


def paragraph_keys(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Keys of the paragraphs of texts given as bytes, and where each text's begin (and the last end); the keys of a text
    are distinct and in no particular order."""
    n = len(offsets) - 1
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(n + 1, np.int64)
    begins = offsets[:-1][np.diff(offsets) > 0]
    word = ~_SPACE[data]
    start = word.copy()
    start[1:] &= ~word[:-1]
    start[begins] = word[begins]
    cut = np.zeros(len(data), bool)
    cut[1:] = (data[:-1] == 10) & (data[1:] != 10)
    held = np.flatnonzero(word)
    if len(held):
        places = np.flatnonzero(start)
        hashes = run_hashes(_BYTE[data[held]], np.flatnonzero(start[held]))
        texts = np.searchsorted(offsets, places, "right")
        ends = (hashes[:-1] & np.uint64(7)) == 0
        cut[places[1:][ends & (texts[1:] == texts[:-1])]] = True
    cut[begins] = True
    places = np.flatnonzero(cut)
    digests = run_hashes(_BYTE[data], places)
    text = np.searchsorted(offsets, places, "right") - 1
    order = np.lexsort((digests, text))
    digests, text = digests[order], text[order]
    same = np.zeros(len(digests), bool)
    same[1:] = (digests[1:] == digests[:-1]) & (text[1:] == text[:-1])
    at = np.arange(len(digests))
    occurrence = at - np.maximum.accumulate(np.where(same, 0, at))
    keys = mix(digests + occurrence.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return keys, np.searchsorted(text, np.arange(n + 1))


def cells_of(keys: np.ndarray, owner: np.ndarray, cells: int) -> list[np.ndarray]:
    """For each of the parts, the cell of each key among the cells of all owners."""
    part = cells // PARTS
    return [owner * cells + i * part + (mix(keys + np.uint64((i + 1) * int(_CHECK) & (1 << 64) - 1)) % np.uint64(part)).astype(np.int64) for i in range(PARTS)]


def build(keys: np.ndarray, owner: np.ndarray, owners: int, cells: int, sign: np.ndarray | None = None):
    """Counts, key sums and check sums of the sketches of all owners; a sign of -1 subtracts a key."""
    counts, sums, checks = np.zeros(owners * cells, np.int64), np.zeros(owners * cells, np.uint64), np.zeros(owners * cells, np.uint64)
    sign = np.ones(len(keys), np.int64) if sign is None else sign
    signed, check = keys * sign.view(np.uint64), mix(keys ^ _CHECK) * sign.view(np.uint64)
    for at in cells_of(keys, owner, cells):
        np.add.at(counts, at, sign)
        np.add.at(sums, at, signed)
        np.add.at(checks, at, check)
    return counts, sums, checks


def peel(counts: np.ndarray, sums: np.ndarray, checks: np.ndarray, owners: int, cells: int):
    """Take single keys out of sketches until none is left: keys, owners and signs taken out, and which owners came out empty."""
    keys_out, owners_out, signs_out = [], [], []
    look = np.flatnonzero(counts)
    while True:
        sign = counts[look]
        one = np.abs(sign) == 1
        at, sign = look[one], sign[one]
        keys = sums[at] * sign.view(np.uint64)
        whole = checks[at] == mix(keys ^ _CHECK) * sign.view(np.uint64)
        at, sign, keys = at[whole], sign[whole], keys[whole]
        owner = at // cells
        places = np.array(cells_of(keys, owner, cells)).reshape(PARTS, len(keys))
        own = (places == at).any(axis=0)
        pure = np.zeros(len(counts), bool)
        pure[at[own]] = True
        first = np.full(len(at), -1)
        for p in places[::-1]:
            first = np.where(pure[p] & (sums[p] * counts[p].view(np.uint64) == keys), p, first)
        take = own & (first == at)
        if not take.any():
            break
        keys, owner, sign, places = keys[take], owner[take], sign[take], places[:, take]
        keys_out.append(keys)
        owners_out.append(owner)
        signs_out.append(sign)
        signed, check = keys * sign.view(np.uint64), mix(keys ^ _CHECK) * sign.view(np.uint64)
        for p in places:
            np.subtract.at(counts, p, sign)
            np.subtract.at(sums, p, signed)
            np.subtract.at(checks, p, check)
        look = np.unique(places)
    empty = np.ones(owners, bool)
    empty[np.flatnonzero((counts != 0) | (sums != 0) | (checks != 0)) // cells] = False
    join = lambda x, kind: np.concatenate(x) if x else np.zeros(0, kind)
    return join(keys_out, np.uint64), join(owners_out, np.int64), join(signs_out, np.int64), empty


def difference(left: tuple[np.ndarray, np.ndarray], right: tuple[np.ndarray, np.ndarray], cells: int = CELLS):
    """Keys that only one side of each pair has: keys, pairs and signs (1: only left), sorted by pair, and the cells each
    pair took. Both sides are (keys, offsets) of as many texts."""
    n = len(left[1]) - 1
    owner = np.concatenate([np.repeat(np.arange(n), np.diff(left[1])), np.repeat(np.arange(n), np.diff(right[1]))])
    keys = np.concatenate([left[0], right[0]])
    sign = np.concatenate([np.ones(len(left[0]), np.int64), -np.ones(len(right[0]), np.int64)])
    used, found = np.zeros(n, np.int64), []
    open_ = np.arange(n)
    while len(open_):
        place = np.full(n, -1)
        place[open_] = np.arange(len(open_))
        mine = place[owner] >= 0
        keys, owner, sign = keys[mine], owner[mine], sign[mine]
        k, o, s, empty = peel(*build(keys, place[owner], len(open_), cells, sign), len(open_), cells)
        done = empty[o]
        found.append((k[done], open_[o[done]], s[done]))
        used[open_[empty]] = cells
        open_ = open_[~empty]
        cells *= GROWTH
    k, o, s = (np.concatenate([f[i] for f in found]) if found else np.zeros(0, np.int64) for i in range(3))
    order = np.argsort(o, kind="stable")
    return k[order].astype(np.uint64), o[order].astype(np.int64), s[order].astype(np.int64), used


def likeness(left: np.ndarray, right: np.ndarray, pairs: np.ndarray) -> np.ndarray:
    """Shared paragraphs over all paragraphs of each pair; 1 for two texts without any."""
    n = np.diff(left) + np.diff(right)
    d = np.bincount(pairs, minlength=len(n))
    return np.where(n > 0, (n - d) / np.maximum(n + d, 1), 1.0)


def printed(keys: tuple[np.ndarray, np.ndarray]) -> list[str]:
    """The sketches of texts at their first size: number of paragraphs, then count, key sum and check of each cell, as base64."""
    n = len(keys[1]) - 1
    counts, sums, checks = build(keys[0], np.repeat(np.arange(n), np.diff(keys[1])), n, CELLS)
    raw = np.zeros((n, CELLS), [("count", "<i4"), ("key", "<u8"), ("check", "<u4")])
    raw["count"], raw["key"] = counts.reshape(n, CELLS), sums.reshape(n, CELLS)
    raw["check"] = (checks >> np.uint64(32)).astype(np.uint32).reshape(n, CELLS)
    sizes = np.diff(keys[1]).tolist()
    return [f"{m}:{base64.b64encode(r.tobytes()).decode()}" for m, r in zip(sizes, raw, strict=True)]


def compare(pairs: DataFrame, left: str, right: str, prefix: str = "", digests: bool = True) -> DataFrame:
    """pairs with, after `prefix`: likeness (shared paragraphs over all, 0 to 1), fingerprint_left, fingerprint_right,
    cells (those the comparison took) and, if `digests`, only_left and only_right: the digests of differing paragraphs.

    Null texts count as empty. Two empty texts have likeness 1 and equal fingerprints; equal texts always have. Columns of
    the new names are replaced; all others pass unchanged.
    """
    kinds = {"likeness": "double", "fingerprint_left": "string", "fingerprint_right": "string", "cells": "long"}
    kinds |= {"only_left": "array<long>", "only_right": "array<long>"} if digests else {}
    names = [c for c in pairs.columns if c not in {prefix + k for k in kinds}]
    one, other = unused("_left", names), unused("_right", names)
    base = pairs.select(*(pairs[f"`{c}`"] for c in names), pairs[f"`{left}`"].alias(one), pairs[f"`{right}`"].alias(other))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, one, SLICE_BYTES):
            a = paragraph_keys(*flat(batch.column(one)))
            b = paragraph_keys(*flat(pc.fill_null(batch.column(other), "").cast(pa.large_string())))
            keys, owner, sign, used = difference(a, b)
            out = [pa.array(likeness(a[1], b[1], owner)), pa.array(printed(a)), pa.array(printed(b)), pa.array(used)]
            for s in (1, -1) if digests else ():
                mine = sign == s
                ends = np.searchsorted(owner[mine], np.arange(batch.num_rows + 1))
                out.append(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(keys[mine].view(np.int64))))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), *out], [*names, *(prefix + k for k in kinds)])

    fields = [f for f in base.schema.fields if f.name not in (one, other)]
    added = StructType.fromDDL(", ".join(f"`{prefix}{k}` {t}" for k, t in kinds.items()))
    return base.mapInArrow(run, StructType([*fields, *added.fields]))


def with_next(docs: DataFrame, rows: int = 2_000, most: int = 1 << 16) -> DataFrame:
    """docs (doc_id long, text) with next_text: the text of the next document by descending doc_id; after the last comes the first.

    Documents go to buckets of about `rows` neighbours, at most `most` buckets. Their bounds are every so manieth of all (id, hash
    of the text) in order, so ids may lie anywhere, and rows without id or with the same id are split as well; only rows equal in
    both stay together. The first document of each bucket is also sent to the bucket before it, so texts are shuffled once
    and no sort of texts is global. Rows that repeat a doc_id follow each other by the hash of their text, rows without id
    come last. A table of one row has itself as the next.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64(F.coalesce("text", F.lit(""))).alias("tie"))
    order = [F.col("doc_id").desc_nulls_last(), F.col("tie")]
    ranked = global_rank(docs.select("doc_id", "tie"), order, "rank")
    step = max(rows, docs.count() // most + 1)
    heads = ranked.filter(F.col("rank") % step == 1).orderBy("rank").select("doc_id", "tie").distinct().collect()
    heads = sorted({(r.doc_id is None, -(r.doc_id or 0), r.tie) for r in heads})

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bounds = _ordered(np.array([h[0] for h in heads], bool), np.array([-h[1] for h in heads], np.int64), np.array([h[2] for h in heads], np.int64))
        for batch in batches:
            ids = batch.column("doc_id")
            mine = _ordered(np.array(ids.is_null()), np.array(ids.fill_null(0), np.int64), np.array(batch.column("tie"), np.int64))
            both = [np.concatenate([b, m]) for b, m in zip(bounds, mine, strict=True)]
            n = len(heads)
            row = np.arange(len(both[0])) >= n
            by = np.lexsort((row, *both[::-1]))  # a head goes before the rows equal to it
            before = np.cumsum(by < n)
            bucket = np.empty(len(both[0]), np.int32)
            bucket[by] = before - 1
            bucket = bucket[n:]
            first = np.logical_and.reduce([b[bucket] == m for b, m in zip(bounds, mine, strict=True)]) if n else np.zeros(0, bool)
            host = pa.array((bucket - 1) % max(n, 1), pa.int32(), mask=~first)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(bucket), host], [*batch.schema.names, "bucket", "host"])

    placed = docs.mapInArrow(place, "doc_id long, text string, tie long, bucket int, host int")
    both = F.array(F.struct(F.lit(False).alias("guest"), F.col("bucket").alias("at")), F.struct(F.lit(True).alias("guest"), F.col("host").alias("at")))
    placed = placed.select("doc_id", "text", "tie", F.inline(F.filter(both, lambda x: x["at"].isNotNull())))
    inside = Window.partitionBy("at").orderBy("guest", *order)
    return placed.withColumn("next_text", F.lead("text").over(inside)).filter(~F.col("guest")).select("doc_id", "text", "next_text")


def _ordered(missing: np.ndarray, ids: np.ndarray, ties: np.ndarray) -> list[np.ndarray]:
    """Columns to sort by, the most significant first: rows without id last, others by falling id, then by the tie."""
    return [missing, np.where(missing, 0, ~ids), ties]
