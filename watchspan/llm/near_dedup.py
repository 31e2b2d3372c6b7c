"""Near-duplicate groups: MinHash bands propose pairs, odd sketches estimate them, full shingle sets decide.

1. Each text becomes its set of k-word shingles (64-bit hashes), a MinHash signature, 32 band keys of four samples
   each, and an odd sketch: a 256-bit map in which every (position, MinHash sample) flips one bit. Equal sets
   collapse to one class before anything else, so exact copies cost one row each.
2. Two sets of Jaccard similarity J share a band with probability 1 - (1 - J^4)^32; a pair at exactly 0.8 is missed
   once in 2e7.
3. Bands never emit all pairs. In each round every band with members of several components pairs them with one drawn
   centre only; the XOR population count of the odd sketches drops pairs that are clearly below the threshold and picks
   each member's likeliest centre among its bands; the full sets confirm it. Members of one component need no further pair.
4. A last sweep looks at all pairs of different components that are left inside a band, so that no link depends on the
   choice of a centre. A band is cut into tiles of bounded size, and each pair of tiles is one group of rows with their
   full sets. Sketches are compared in blocks, likely pairs are confirmed on the spot in the first band they share, most
   similar first, and pairs that an earlier link has joined are skipped. Only links that join components leave the task.
5. Components are the fixed point of minimum labels over confirmed links.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from watchspan.llm.common import flat, mix, shingle_hashes, slices, stored, word_hashes
from watchspan.operators.joins import lookup_join

SAMPLES, BANDS, SKETCH_WORDS = 128, 32, 4
TILE, TILE_SHINGLES = 512, 500_000

_A = mix(np.arange(1, SAMPLES + 1, dtype=np.uint64)).astype(np.uint32) | np.uint32(1)
_B = mix(np.arange(1001, SAMPLES + 1001, dtype=np.uint64)).astype(np.uint32)
_SLOT = mix(np.arange(5001, SAMPLES + 5001, dtype=np.uint64))


def signatures(sets: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """MinHash samples (sets x SAMPLES), odd sketches (sets x SKETCH_WORDS) and band keys (sets x BANDS); no set is empty."""
    n = len(starts)
    low = (sets >> np.uint64(32)).astype(np.uint32) ^ sets.astype(np.uint32)
    samples = np.empty((SAMPLES, n), np.uint32)
    for j in range(SAMPLES):
        samples[j] = np.minimum.reduceat((low ^ _B[j]) * _A[j], starts)
    samples = samples.T.astype(np.uint64)
    bit = (mix(samples + _SLOT) & np.uint64(64 * SKETCH_WORDS - 1)).astype(np.int64)
    flips = np.zeros((n, 64 * SKETCH_WORDS), np.uint8)
    np.add.at(flips, (np.repeat(np.arange(n), SAMPLES), bit.ravel()), 1)
    sketches = np.packbits(flips & 1, axis=1).view(np.uint64)
    rows = SAMPLES // BANDS
    bands = np.zeros((n, BANDS), np.uint64)
    for r in range(rows):
        bands = mix(bands * np.uint64(0x9E3779B97F4A7C15) + samples[:, r::rows] + _SLOT[:BANDS])
    return samples, sketches, bands


def similarity(odd_bits: np.ndarray) -> np.ndarray:
    """Jaccard similarity that so many odd bits in the XOR of two sketches speak for."""
    n = 64 * SKETCH_WORDS
    share = np.minimum(2 * odd_bits / n, 1 - 1e-9)
    return 1 + n / (4 * SAMPLES) * np.log(1 - share)


def most_odd_bits(threshold: float, sigmas: float = 6.0) -> int:
    """Odd bits beyond which a pair at the threshold is practically excluded: six deviations of the estimate below it."""
    deviation = (threshold * (1 - threshold) / SAMPLES) ** 0.5
    least = max(0.0, threshold - sigmas * 1.25 * deviation)
    return int(np.sum(similarity(np.arange(64 * SKETCH_WORDS // 2)) >= least)) - 1


def _long(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def _lists(x: np.ndarray) -> pa.Array:
    return pa.FixedSizeListArray.from_arrays(_long(np.ascontiguousarray(x).ravel()), x.shape[1]).cast(pa.list_(pa.int64()))


def _sets_of(batch: pa.RecordBatch, k: int, turn: int):
    """Sets and nodes of a slice. A text without an id has a number drawn from its set as its node, in the `turn`th way."""
    words, firsts = word_hashes(*flat(batch.column("text")))
    sets, ends = shingle_hashes(words, firsts, k)
    full = np.flatnonzero(np.diff(ends) > 0)
    starts = ends[:-1][full]
    one = np.add.reduceat(mix(sets), starts) if len(full) else np.zeros(0, np.uint64)
    ids = batch.column("doc_id")
    node = np.array(ids.fill_null(0), np.int64)
    unnamed = np.array(ids.is_null())[full]
    drawn = mix(one + np.uint64(turn) * np.uint64(0x9E3779B97F4A7C15)).view(np.int64)
    node[full] = np.where(unnamed, drawn, node[full])
    return sets, ends, full, starts, one, node


def _describe(k: int, turn: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, most=1 << 20):
            sets, ends, full, starts, one, node = _sets_of(batch, k, turn)
            n = batch.num_rows
            key1, key2 = np.zeros(n, np.uint64), np.zeros(n, np.uint64)
            sketches, bands = np.zeros((n, SKETCH_WORDS), np.uint64), np.zeros((n, BANDS), np.uint64)
            if len(full):
                key1[full], key2[full] = one, np.add.reduceat(mix(sets ^ np.uint64(0xA0761D6478BD642F)), starts)
                _, sketches[full], bands[full] = signatures(sets, starts)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), _long(node), pa.array(np.diff(ends)), _long(key1), _long(key2), _lists(sketches), _lists(bands)],
                ["doc_id", "node", "n_shingles", "key1", "key2", "sketch", "bands"],
            )

    return run


def _full_sets(k: int, turn: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, most=1 << 20):
            sets, ends, full, _, _, node = _sets_of(batch, k, turn)
            raw = [sets[ends[i] : ends[i + 1]].tobytes() for i in full]
            yield pa.RecordBatch.from_arrays([_long(node[full]), pa.array(raw, pa.binary())], ["node", "set"])

    return run


def _confirm(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for i, (a, b) in enumerate(zip(batch.column("set_a"), batch.column("set_b"), strict=True)):
                a, b = np.frombuffer(a.as_buffer(), np.uint64), np.frombuffer(b.as_buffer(), np.uint64)
                shared = _shared(a, b)
                if 100 * shared >= percent * (len(a) + len(b) - shared):
                    keep.append(i)
            yield batch.select(["a", "b"]).take(pa.array(keep, pa.int64()))

    return run


def _shared(a: np.ndarray, b: np.ndarray) -> int:
    both = np.concatenate([a, b])
    both.sort(kind="stable")
    return int(np.count_nonzero(both[1:] == both[:-1]))


def _joined(group: pa.Table, bits: int, percent: int) -> list[tuple[int, int]]:
    """Links between different components of one pair of tiles that join what was apart."""
    node, label, n, tile = (group.column(c).to_numpy() for c in ("node", "label", "n_shingles", "tile"))
    sketch, bands = (group.column(c).combine_chunks().flatten().to_numpy().reshape(group.num_rows, -1) for c in ("sketch", "bands"))
    sketch, band = sketch.view(np.uint64), group.column("band")[0].as_py()
    first = np.flatnonzero(tile == group.column("left")[0].as_py())
    second = np.flatnonzero(tile == group.column("right")[0].as_py())
    if not len(first) or not len(second):
        return []  # tiles are chosen by hash, so either may hold no node
    found = []
    for at in range(0, len(first), 128):
        a = first[at : at + 128, None]
        odd = np.bitwise_count(sketch[a[:, 0]][:, None, :] ^ sketch[second][None, :, :]).sum(axis=2)
        near = (odd <= bits) & (label[a] != label[second][None, :])
        near &= 100 * np.minimum(n[a], n[second][None, :]) >= percent * np.maximum(n[a], n[second][None, :])
        x, y = np.nonzero(near)
        odd, x, y = odd[x, y], a[x, 0], second[y]
        own = np.argmax(bands[x] == bands[y], axis=1) == band
        found.append((odd[own], x[own], y[own]))
    odd, x, y = (np.concatenate([f[i] for f in found]) for i in range(3))
    parent: dict[int, int] = {}

    def root(v: int) -> int:
        while (up := parent.get(v, v)) != v:
            parent[v] = parent.get(up, up)
            v = parent[v]
        return v

    sets, links = group.column("set"), []
    for i in np.argsort(odd, kind="stable").tolist():
        p, q = int(x[i]), int(y[i])
        low, high = root(int(label[p])), root(int(label[q]))
        if low == high:
            continue
        shared = _shared(np.frombuffer(sets[p].as_buffer(), np.uint64), np.frombuffer(sets[q].as_buffer(), np.uint64))
        if 100 * shared >= percent * (int(n[p]) + int(n[q]) - shared):
            parent[high] = low
            links.append((int(node[p]), int(node[q])))
    return links


def _sweep(bits: int, percent: int):
    """Joining links of (band, key, left, right) groups, which arrive sorted; a group may span Arrow batches."""
    groups = ["band", "key", "left", "right"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: pa.Table | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch])
            table = table if rest is None else pa.concat_tables([rest, table])
            change = np.zeros(table.num_rows, bool)
            for c in groups:
                v = table.column(c).to_numpy()
                change[1:] |= v[1:] != v[:-1]
            starts = [0, *np.flatnonzero(change).tolist()]
            links = [x for a, b in zip(starts, starts[1:]) for x in _joined(table.slice(a, b - a), bits, percent)]
            rest = table.slice(starts[-1])
            yield _pairs(links)
        if rest is not None:
            yield _pairs(_joined(rest, bits, percent))

    return run


def _pairs(links: list[tuple[int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([x for x, _ in links], pa.int64()), pa.array([y for _, y in links], pa.int64())], ["a", "b"])


def components(links: DataFrame) -> DataFrame:
    """(node, label): the smallest node reachable over links (a, b). Minimum labels spread over links and along labels until none changes."""
    ends = stored(links.select(F.col("a").alias("v"), F.col("b").alias("w")).union(links.select("b", "a")).distinct(), "ends")
    labels = stored(ends.groupBy("v").agg(F.min("w").alias("w")).select("v", F.least("v", "w").alias("label")), "labels")
    while True:
        spread = ends.join(labels.withColumnRenamed("v", "w"), "w").groupBy("v").agg(F.min("label").alias("near"))
        lower = labels.join(spread, "v").select("v", "label", F.least("label", "near").alias("low"))
        jump = labels.select(F.col("v").alias("low"), F.col("label").alias("far"))
        after = lower.join(jump, "low", "left").select("v", F.least("low", "far").alias("new"), "label")
        after = stored(after, "labels")
        labels = after.select("v", F.col("new").alias("label"))
        if after.filter("new < label").isEmpty():
            return labels.select(F.col("v").alias("node"), "label")


def near_groups(docs: DataFrame, words: int = 5, percent: int = 80, rounds: int = 3) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row of docs (doc_id long, text string; other columns are ignored).

    Links: 100 * |A and B| >= percent * |A or B| on sets of `words`-word shingles. A text with fewer words has its
    whole sequence as its one shingle; null, empty and blank texts have none and link with nothing. component_id is the
    smallest doc_id reachable. Rows that repeat a doc_id count as one node. A row without id takes part by its text: its
    component_id is the smallest id in its group, null if the group has none, and such a group keeps all its rows.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    keys = ["key1", "key2", "n_shingles"]
    described = "doc_id long, node long, n_shingles long, key1 long, key2 long, sketch array<long>, bands array<long>"
    turn = 0
    while True:
        rows = stored(docs.mapInArrow(_describe(words, turn), described), "shingles")
        full = rows.filter("n_shingles > 0").withColumn("unnamed", F.col("doc_id").isNull())
        # a drawn node must be neither an id nor that of another set
        drawn = full.filter("unnamed").select("node", *keys).distinct()
        if drawn.isEmpty():
            break
        taken = full.filter("not unnamed").join(drawn.select("node"), "node", "left_semi")
        if taken.isEmpty() and drawn.groupBy("node").count().filter("count > 1").isEmpty():
            break
        turn += 1
    any_unnamed = not drawn.isEmpty()
    # a class goes by its smallest id, by a drawn node only if no row has one
    classes = full.groupBy(*keys).agg(F.min(F.struct("unnamed", F.col("node").alias("class"))).alias("c")).select(*keys, "c.unnamed", "c.class")
    named = full.select(*keys, "unnamed", F.col("node").alias("class"), "sketch", "bands")
    nodes = stored(named.join(classes, [*keys, "unnamed", "class"], "left_semi").dropDuplicates([*keys, "class"]), "classes")
    links = _links(docs, nodes.select(F.col("class").alias("node"), "n_shingles", "sketch", "bands"), words, percent, rounds, turn)
    groups = classes.withColumn("group", F.col("class"))
    if links is not None:
        labels = components(links).withColumnsRenamed({"node": "class", "label": "group"})
        groups = classes.join(labels, "class", "left").withColumn("group", F.coalesce("group", "class"))
    if any_unnamed:
        # components with a drawn node go by their smallest id, if they have one
        groups = stored(groups, "groups")
        mixed = groups.join(groups.filter("unnamed").select("group").distinct(), "group", "left_semi")
        least = mixed.groupBy("group").agg(F.min(F.when(~F.col("unnamed"), F.col("class"))).alias("least"), F.lit(True).alias("mixed"))
        groups = lookup_join(groups, least, ["group"], "class").withColumn("group", F.when(F.col("mixed"), F.col("least")).otherwise(F.col("group")))
    groups = groups.select(*keys, "group")
    labelled = lookup_join(rows.filter("n_shingles > 0").select("doc_id", *keys), groups, keys, "doc_id")
    whole = labelled.select("doc_id", "n_shingles", F.col("group").alias("component_id"))
    alone = rows.filter("n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return whole.unionByName(alone).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def _links(docs: DataFrame, nodes: DataFrame, words: int, percent: int, rounds: int, turn: int) -> DataFrame | None:
    """Confirmed links (a, b) that connect all nodes of a component; None if no band has two members."""
    bits = most_odd_bits(percent / 100)
    banded = nodes.select("node", F.posexplode("bands").alias("band", "key"))
    shared = banded.groupBy("band", "key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
    members = stored(banded.join(shared, ["band", "key"]), "bands")
    if members.isEmpty():
        return None
    met = members.select("node").distinct()
    sketches = stored(nodes.join(met, "node"), "sketches")
    named = docs.filter("doc_id is not null").join(met.withColumnRenamed("node", "doc_id"), "doc_id", "left_semi")
    unnamed = docs.filter("doc_id is null")
    sets = stored(named.unionByName(unnamed).mapInArrow(_full_sets(words, turn), "node long, set binary"), "sets")

    def side(name: str) -> DataFrame:
        return sketches.select(F.col("node").alias(name), F.col("n_shingles").alias(f"n_{name}"), F.col("sketch").alias(f"sketch_{name}"))

    def estimated(pairs: DataFrame) -> DataFrame:
        """Pairs whose sizes and sketches allow a link, with their odd bits."""
        odd = sum((F.bit_count(F.col("sketch_a")[i].bitwiseXOR(F.col("sketch_b")[i])) for i in range(SKETCH_WORDS)), F.lit(0))
        both = pairs.join(side("a"), "a").join(side("b"), "b")
        both = both.filter(100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b"))
        return both.select("a", "b", odd.alias("odd")).filter(F.col("odd") <= bits)

    def confirmed(pairs: DataFrame) -> DataFrame:
        with_sets = pairs.select("a", "b").join(sets.select(F.col("node").alias("a"), F.col("set").alias("set_a")), "a")
        with_sets = with_sets.join(sets.select(F.col("node").alias("b"), F.col("set").alias("set_b")), "b")
        return with_sets.select("a", "b", "set_a", "set_b").mapInArrow(_confirm(percent), "a long, b long")

    links: DataFrame | None = None
    labels: DataFrame | None = None
    for turn in range(rounds):
        mixed = _mixed_bands(members, labels)
        mixed = mixed.withColumn("draw", F.xxhash64("node", "band", F.lit(turn)))
        pick = mixed.groupBy("band", "key").agg(F.min("draw").alias("draw"))
        centres = mixed.join(pick, ["band", "key", "draw"])
        centres = centres.groupBy("band", "key").agg(F.min("node").alias("centre"), F.min("label").alias("centre_label"))
        pairs = mixed.join(centres, ["band", "key"]).filter("label <> centre_label").select(F.col("node").alias("a"), F.col("centre").alias("b"))
        likely = estimated(pairs.distinct())
        best = likely.groupBy("a").agg(F.min(F.struct("odd", "b")).alias("best")).select("a", F.col("best.b").alias("b"))
        fresh = stored(confirmed(best), "links")
        if fresh.isEmpty():
            break
        links = fresh if links is None else links.union(fresh)
        labels = components(links)
    fresh = stored(_swept(_mixed_bands(members, labels), sketches.join(sets, "node"), bits, percent), "links")
    if fresh.isEmpty():
        return links
    return fresh if links is None else links.union(fresh)


def _mixed_bands(members: DataFrame, labels: DataFrame | None) -> DataFrame:
    """Members of bands that hold several components, with their component's label."""
    if labels is None:
        return members.withColumn("label", F.col("node"))
    labelled = members.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    mixed = labelled.groupBy("band", "key").agg(F.min("label").alias("low"), F.max("label").alias("high")).filter("low < high")
    return stored(labelled.join(mixed.select("band", "key"), ["band", "key"]).select("node", "band", "key", "label"), "mixed")


def _swept(mixed: DataFrame, full: DataFrame, bits: int, percent: int) -> DataFrame:
    """Links between components that share a band, from tiles of about TILE rows and TILE_SHINGLES shingles."""
    sized = mixed.join(full.select("node", "n_shingles"), "node")
    sizes = sized.groupBy("band", "key").agg(F.greatest(F.count(F.lit(1)) / TILE, F.sum("n_shingles") / TILE_SHINGLES).alias("tiles"))
    tiled = mixed.join(sizes, ["band", "key"]).withColumn("tiles", F.ceil("tiles").cast("int"))
    tiled = tiled.withColumn("tile", F.pmod(F.xxhash64("node"), F.col("tiles")).cast("int"))
    tiled = tiled.select("*", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)).alias("other"))
    tiled = tiled.withColumn("left", F.least("tile", "other")).withColumn("right", F.greatest("tile", "other"))
    held = tiled.join(full, "node").select("band", "key", "left", "right", "tile", "node", "label", "n_shingles", "sketch", "bands", "set")
    groups = ["band", "key", "left", "right"]
    held = held.repartition(*groups).sortWithinPartitions(*groups)
    return held.mapInArrow(_sweep(bits, percent), "a long, b long")
