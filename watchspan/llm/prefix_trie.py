"""The trie of all conversations' prefixes, with a count-min sketch that keeps lone tails out of the shuffle.

A prefix is named by two sums of hashes of its (position, turn) pairs. A count-min sketch over the names of all prefixes never
counts too low, so an estimate of one proves that a single conversation has the prefix, and all longer ones of that
conversation. Such tails become nodes where they are read. Only prefixes that may be shared, and the first of each tail that
has to learn its parent's name, are grouped exactly. A false estimate costs a row in that shuffle and changes nothing else.

The sketch has two rows of cells, one for each sum. Only whether a cell counted two or more is kept: two bitmaps of at most
2^27 bits, made in slabs by separate tasks and sent to all tasks, 32 MB together whatever the input. Beyond about
10^7 prefixes it lets more of them through to the exact grouping.

No conversation and no node is gathered in one task: running counts and sums go over range-partitioned rows with an
offset for each partition, joins on conversations and nodes are salted, and the members that end at a node are joined to pieces
of text in parallel before one task digests the pieces one after another.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from watchspan.llm.common import discard, stored
from watchspan.operators.joins import lookup_join

LANES = ("one", "two")
_BITS = 62
MASK = (1 << _BITS) - 1  # sums are kept modulo 2^62, so that two of them fit into a long
_SLAB_BITS = 20
_LEAST_BITS, _MOST_BITS = 16, 27
_PIECE = 4096  # ids joined to one piece of text
_WORD = r"[^\x20\x09-\x0D]+"
_NOTHING = hashlib.sha256(b"").hexdigest()


def running(df: DataFrame, key: str, order: list[Column], sums: tuple[str, ...] = ()) -> DataFrame:
    """df (a stored copy) with `nth`, from 1, and `sum_<column>` modulo 2^62 over the rows of each key in the given order.

    `key` is a long without nulls; `sums` are longs from 0 to 2^62 - 1. Rows are sorted by ranges of key and order. A key
    whose rows lie in several partitions gets its offsets from one summary row per partition it lies in; there are fewer
    than two per partition, so they fit on the driver.
    """
    totals = [f"sum_{c}" for c in sums]
    dealt = df.repartitionByRange(F.col(key), *order).sortWithinPartitions(F.col(key), *order)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, last, carry = TaskContext.get().partitionId(), None, np.zeros(1 + len(sums), np.uint64)
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            keys = batch.column(key).to_numpy(zero_copy_only=False)
            first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
            of = np.repeat(np.arange(len(first)), np.diff(np.append(first, n)))
            steps = [np.ones(n, np.uint64)] + [batch.column(c).to_numpy(zero_copy_only=False).astype(np.uint64) for c in sums]
            so_far = []
            for j, step in enumerate(steps):
                total = np.cumsum(step)
                total -= np.where(first > 0, total[first - 1], np.uint64(0))[of]
                if keys[0] == last:
                    total[of == 0] += carry[j]
                so_far.append(total & np.uint64(MASK))
            last, carry = keys[-1], np.array([t[-1] for t in so_far], np.uint64)
            extra = [pa.array(np.full(n, part, np.int32))] + [pa.array(t.astype(np.int64)) for t in so_far]
            yield pa.RecordBatch.from_arrays([*batch.columns, *extra], [*batch.schema.names, "part", "nth", *totals])

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields] + ["part int", "nth bigint"] + [f"{t} bigint" for t in totals]
    placed = stored(dealt.mapInArrow(task, ", ".join(fields)), "running")

    ends = placed.groupBy("part").agg(F.min(key).alias("low"), F.max(key).alias("high")).orderBy("part").collect()
    split = [b["low"] for a, b in zip(ends, ends[1:], strict=False) if a["high"] == b["low"]]
    if not split:
        return placed.drop("part")
    parts = placed.filter(F.col(key).isin(sorted(set(split)))).groupBy(key, "part")
    parts = parts.agg(F.max("nth").alias("nth"), *(F.max_by(t, "nth").alias(t) for t in totals)).orderBy(key, "part").collect()
    offsets, at, before = [], None, [0] * (1 + len(totals))
    for r in parts:
        before = before if r[0] == at else [0] * len(before)
        offsets.append((r[0], r[1], *before))
        at, before = r[0], [(b + r[i + 2]) & MASK for i, b in enumerate(before)]
    names = [f"before_{t}" for t in ("nth", *totals)]
    table = df.sparkSession.createDataFrame(offsets, ", ".join(["of bigint", "of_part int", *(f"{x} bigint" for x in names)]))
    joined = placed.join(F.broadcast(table), (F.col(key) == F.col("of")) & (F.col("part") == F.col("of_part")), "left")
    moved = {t: (F.col(t) + F.coalesce(f"before_{t}", F.lit(0))).bitwiseAND(F.lit(MASK)) for t in ("nth", *totals)}
    return joined.withColumns(moved).select(*df.columns, "nth", *totals)


def ordered_turns(rows: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv, pos, digest, words): the turns of each conversation numbered from 1 by `turn`, null first.

    Null roles and texts are empty. Turns of one number go by `digest`, the MD5 of "<bytes of role>:<role><text>"; such that
    are equal in all are interchangeable. Rows without a conversation's id are in none and left out.
    """
    who, said = (F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in (role, text))
    turns = rows.filter(F.col(f"`{key}`").isNotNull()).select(
        F.col(f"`{key}`").cast("bigint").alias("conv"), F.col(f"`{turn}`").alias("turn"),
        F.unhex(F.md5(F.concat(F.octet_length(who).cast("string"), F.lit(":"), who, said))).alias("digest"),
        F.regexp_count(said, F.lit(_WORD)).cast("bigint").alias("words"),
    )
    placed = running(turns, "conv", [F.col("turn").asc_nulls_first(), F.col("digest")])
    return placed.select("conv", F.col("nth").alias("pos"), "digest", "words")


def with_shared_heads(turns: DataFrame, block: int = 20, most: int = 4) -> tuple[DataFrame, DataFrame]:
    """Conversations that begin like the first one of their block: (turns, conversations).

    Conversation c gets the first h turns of conversation c - c % block (as many as it has), h = crc32 of the decimal c modulo
    `most`, and its own turns after its first h. Turns are (conv, pos, size, digest, words), conversations (conv, size); a
    conversation may be left with no turn.
    """
    h = (F.crc32(F.col("conv").cast("string").cast("binary")) % most).cast("bigint")
    head = F.when(F.col("pos") < most, F.struct("pos", "digest", "words"))
    own = turns.groupBy("conv").agg(F.count(F.lit(1)).alias("n"), F.array_sort(F.collect_list(head)).alias("heads"))
    first = own.select(F.col("conv").alias("first"), "heads")
    plan = own.select("conv", "n", h.alias("h"), (F.col("conv") - F.col("conv") % block).alias("first")).join(first, "first", "left")
    taken = F.slice(F.coalesce("heads", F.array().cast(own.schema["heads"].dataType)), F.lit(1), F.col("h").cast("int"))
    plan = plan.withColumn("taken", taken).withColumn("n_taken", F.size("taken").cast("bigint"))
    plan = plan.withColumn("size", F.col("n_taken") + F.greatest(F.col("n") - F.col("h"), F.lit(0)))
    plan = stored(plan.select("conv", "size", "taken", "n_taken"), "heads")
    heads = plan.select("conv", "size", F.inline("taken")).select("conv", "pos", "size", "digest", "words")
    rest = lookup_join(turns.filter(F.col("pos") > h), plan.select("conv", "size", "n_taken"), ["conv"], "pos")
    rest = rest.select("conv", (F.col("pos") - h + F.col("n_taken")).alias("pos"), "size", "digest", "words")
    return heads.unionByName(rest), plan.select("conv", "size")


def sketch_of_repeats(names: DataFrame, bits: int) -> list[np.ndarray]:
    """For both lanes, the bitmap of the 2^bits cells that count two or more rows."""
    slab_bits = min(_SLAB_BITS, bits)
    slabs = 1 << (bits - slab_bits)

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple[int, bytes]] = []
            for lane in range(2):
                at = batch.column(lane).to_numpy(zero_copy_only=False) & ((1 << bits) - 1)
                at = np.sort(at)
                third = np.append([False, False], at[2:] == at[:-2])[: len(at)]  # two of a cell tell as much as more
                at = at[~third]
                of = at >> slab_bits
                for part in np.split(at, np.flatnonzero(np.diff(of)) + 1):
                    if len(part):
                        out.append((lane * slabs + int(part[0] >> slab_bits), (part & ((1 << slab_bits) - 1)).astype(np.uint32).tobytes()))
            yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in out], pa.int32()), pa.array([x for _, x in out], pa.binary())], ["slab", "cells"])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[int, np.ndarray] = {}
        for batch in batches:
            for slab, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                at, n = np.unique(np.frombuffer(blob, np.uint32), return_counts=True)
                held = counts.setdefault(slab, np.zeros(1 << slab_bits, np.uint8))
                held[at] = np.minimum(held[at] + n, 2)
        for slab, held in counts.items():
            packed = zlib.compress(np.packbits(held >= 2).tobytes(), 1)
            yield pa.RecordBatch.from_arrays([pa.array([slab], pa.int32()), pa.array([packed], pa.binary())], ["slab", "bitmap"])

    merged = names.mapInArrow(cells, "slab int, cells binary").repartition(64, "slab").mapInArrow(merge, "slab int, bitmap binary")
    out = np.zeros((2, slabs, (1 << slab_bits) // 8), np.uint8)
    for r in merged.collect():  # at most 2 * 2^27 bits
        out[r["slab"] // slabs, r["slab"] % slabs] = np.frombuffer(zlib.decompress(r["bitmap"]), np.uint8)
    return [lane.reshape(-1) for lane in out]


def screened(prefixes: DataFrame) -> DataFrame:
    """The prefixes with `alone` (one conversation at most has this prefix) and `parent_alone` (or the one before it), where the sketch proves it."""
    bits = min(max(_LEAST_BITS, (8 * prefixes.count()).bit_length()), _MOST_BITS)
    maps = prefixes.sparkSession.sparkContext.broadcast(sketch_of_repeats(prefixes.select("one", "two"), bits))

    def once(batch: pa.RecordBatch, names: tuple[str, str]) -> np.ndarray:
        found = np.zeros(batch.num_rows, bool)
        for lane, name in zip(maps.value, names, strict=True):
            at = batch.column(name).to_numpy(zero_copy_only=False) & ((1 << bits) - 1)
            found |= (lane[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1 == 0
        return found

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            above = once(batch, ("up_one", "up_two")) & (batch.column("depth").to_numpy(zero_copy_only=False) > 1)
            flags = [pa.array(once(batch, LANES) | above), pa.array(above)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *flags], [*batch.schema.names, "alone", "parent_alone"])

    fields = [f"{f.name} {f.dataType.simpleString()}" for f in prefixes.schema.fields]
    return prefixes.mapInArrow(task, ", ".join([*fields, "alone boolean", "parent_alone boolean"]))


def joined_digests(rows: DataFrame, by: list[str], value: str) -> DataFrame:
    """(by, digest): SHA-256 of each group's values in ascending order, in decimal, comma-joined.

    Ranges of sorted rows become pieces of at most 4,096 values; one task digests a group's pieces one after another.
    """
    kinds = ", ".join(f"{c} bigint" for c in by)

    def groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, list]]:
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in range(batch.num_columns)]
            yield from zip(zip(*columns[: len(by)], strict=True), zip(*columns[len(by) :], strict=True), strict=True)

    def emit(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
        return pa.RecordBatch.from_pylist([dict(zip(names, r, strict=True)) for r in rows], pa.schema([(n, pa.string() if n in ("piece", "digest") else pa.int64()) for n in names]))

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [*by, "first", "piece"]
        at, held, out = None, [], []
        for group, (v,) in groups(batches):
            if held and (group != at or len(held) == _PIECE):
                out.append((*at, held[0], ",".join(map(str, held))))
                held = []
                if len(out) == 1024:
                    yield emit(out, names)
                    out = []
            at = group
            held.append(v)
        if held:
            out.append((*at, held[0], ",".join(map(str, held))))
        yield emit(out, names)

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [*by, "digest"]
        at, state, out = None, None, []
        for group, (_, piece) in groups(batches):
            if group == at:
                state.update(b",")
            else:
                if state is not None:
                    out.append((*at, state.hexdigest()))
                    if len(out) == 4096:
                        yield emit(out, names)
                        out = []
                at, state = group, hashlib.sha256()
            state.update(piece.encode())
        if state is not None:
            out.append((*at, state.hexdigest()))
        yield emit(out, names)

    dealt = rows.select(*(F.col(c).cast("bigint").alias(c) for c in [*by, value])).repartitionByRange(*by, value).sortWithinPartitions(*by, value)
    parts = dealt.mapInArrow(pieces, f"{kinds}, first bigint, piece string")
    return parts.repartition(*by).sortWithinPartitions(*by, "first").mapInArrow(digest, f"{kinds}, digest string")


def prefix_trie(turns: DataFrame, conversations: DataFrame) -> DataFrame:
    """One row per node: conv_id (the smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    `turns` are (conv, pos, size, digest, words) with positions from 1 to size, `conversations` (conv, size), each once, those
    without turns too. A node is a distinct sequence of first turns; its members are the conversations that start with it.
    saved_tokens sums (n_convs - 1) * words of a node's last turn over its subtree, ends_sha256 digests the members that end at
    it. No conversations: no nodes, not even the root.

    Nodes of one smallest member form a chain that ends at its last turn or where it meets a smaller member's. A subtree's
    sum is then the sum of its members' whole chains less what its own chain holds above it, so that two grouped
    sums and a running one give all subtrees without walking the tree.
    """
    lanes = [F.xxhash64(F.lit(i), "pos", "digest").bitwiseAND(F.lit(MASK)).alias(f"own_{lane}") for i, lane in enumerate(LANES)]
    named = running(turns.select("conv", "pos", "size", "words", *lanes), "conv", [F.col("pos")], tuple(f"own_{lane}" for lane in LANES))
    mask = F.lit(MASK)
    prefixes = named.select(
        "conv", F.col("pos").alias("depth"), "size", "words", *(F.col(f"sum_own_{x}").alias(x) for x in LANES),
        *((F.col(f"sum_own_{x}") - F.col(f"own_{x}")).bitwiseAND(mask).alias(f"up_{x}") for x in LANES),
    )
    known = stored(screened(prefixes), "screened")
    discard(named)
    place, up = ["depth", *LANES], ["up_depth", *(f"up_{x}" for x in LANES)]

    root = conversations.select("conv", F.lit(0).cast("bigint").alias("depth"), "size", F.lit(0).cast("bigint").alias("words"), *(F.lit(0).cast("bigint").alias(c) for c in (*LANES, "up_one", "up_two")))
    members = known.filter(~F.col("alone")).drop("alone", "parent_alone").unionByName(root)
    edge = known.filter(F.col("alone") & ~F.col("parent_alone"))  # the first node of a tail

    grouped = members.groupBy(*place).agg(
        F.min("conv").alias("conv"), F.count(F.lit(1)).alias("n_convs"), F.max("words").alias("words"), *(F.max(f"up_{x}").alias(f"up_{x}") for x in LANES)
    )
    grouped = stored(grouped.withColumn("up_depth", F.col("depth") - 1), "nodes")
    edge = edge.withColumn("up_depth", F.col("depth") - 1)
    below = grouped.filter("depth > 0").select(*up).unionByName(edge.select(*up)).groupBy(*up).agg(F.count(F.lit(1)).alias("n_children"))
    below = below.select(*(F.col(c).alias(p) for c, p in zip(up, place, strict=True)), "n_children")
    nodes = grouped.join(below, place, "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)))
    nodes = nodes.withColumn("weight", (F.col("n_convs") - 1) * F.col("words"))
    chains = running(nodes, "conv", [F.col("depth")], ("weight",))

    # what each conversation's chain holds; it has one leaf at most, in the chain or in its tail
    leaf = (F.col("n_children") == 0).cast("bigint").alias("leaf")
    held = chains.select("conv", "weight", leaf).unionByName(edge.select("conv", F.lit(0).cast("bigint").alias("weight"), F.lit(1).cast("bigint").alias("leaf")))
    held = held.groupBy("conv").agg(F.sum("weight").alias("chain_weight"), F.max("leaf").alias("chain_leaves"))
    under = lookup_join(members.select("conv", *place), held, ["conv"], "depth").groupBy(*place)
    under = under.agg(F.sum("chain_weight").alias("chain_weight"), F.sum("chain_leaves").alias("n_leaves"))

    parents = grouped.select(*(F.col(p).alias(c) for c, p in zip(up, place, strict=True)), F.col("conv").alias("parent"))
    ends = joined_digests(members.filter(F.col("depth") == F.col("size")), place, "conv")
    shared = lookup_join(chains, parents, up, "one").join(under, place).join(ends, place, "left")
    # a parent that is not among the grouped nodes was proven to be alone, so it is the same conversation's
    shared = shared.select(
        F.col("conv").alias("conv_id"), "depth", F.when(F.col("depth") > 0, F.coalesce("parent", "conv")).alias("parent_conv_id"), "n_convs", "n_children", "n_leaves",
        (F.col("chain_weight") - F.col("sum_weight") + F.col("weight")).alias("saved_tokens"), F.coalesce("digest", F.lit(_NOTHING)).alias("ends_sha256"),
    )

    def lone(rows: DataFrame, parent: Column) -> DataFrame:
        last = F.col("depth") == F.col("size")
        one = F.lit(1).cast("bigint")
        return rows.select(
            F.col("conv").alias("conv_id"), "depth", parent.alias("parent_conv_id"), one.alias("n_convs"), F.when(last, 0).otherwise(1).cast("bigint").alias("n_children"),
            one.alias("n_leaves"), F.lit(0).cast("bigint").alias("saved_tokens"), F.when(last, F.sha2(F.col("conv").cast("string"), 256)).otherwise(_NOTHING).alias("ends_sha256"),
        )

    # a false estimate inside a tail begins another edge, whose parent lies in the tail
    heads = lone(lookup_join(edge.select("conv", "depth", "size", *up), parents, up, "conv"), F.coalesce("parent", "conv"))
    tails = lone(known.filter("parent_alone"), F.col("conv"))
    return shared.unionByName(heads).unionByName(tails)
