"""The prefix trie against brute force: nulls, ties, repeats, one very long conversation, a sketch that is far too small."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from watchspan.llm import prefix_trie

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "conv_id long, turn long, role string, text string"


def brute(rows):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            r, x = role or "", text or ""
            tie = hashlib.md5(f"{len(r.encode())}:{r}{x}".encode()).digest()
            own[conv].append(((turn is not None, turn or 0), tie, (r, x)))
    own = {c: [t[2] for t in sorted(v)] for c, v in own.items()}
    built = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - (c % 20 if c >= 0 else -(-c % 20))
        built[c] = own.get(base, [])[:h] + turns[h:]
    members = defaultdict(list)
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    saved, leaves, children = defaultdict(int), defaultdict(int), defaultdict(int)
    for node in members:
        children[node[:-1]] += len(node) > 0
    for node, convs in members.items():
        weight = (len(convs) - 1) * len(WORD.findall(node[-1][1])) if node else 0
        for d in range(len(node) + 1):
            saved[node[:d]] += weight
            leaves[node[:d]] += not children[node]
    out = []
    for node, convs in members.items():
        ends = ",".join(str(c) for c in sorted(convs) if len(built[c]) == len(node))
        parent = min(members[node[:-1]]) if node else None
        out.append((min(convs), len(node), parent, len(convs), children[node], leaves[node], saved[node], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def conversations():
    r = random.Random(2)
    rows = []
    for c in range(-45, 160):
        for t in range(r.randint(1, 6)):
            rows.append((c, t, r.choice(["user", "assistant", None]), r.choice(["Hello there", "a  b\tc", "", None, "ä ö"])))
    rows += [(200 + c, t, "user", f"turn {t} of many") for c in range(40) for t in range(5)]
    rows += [(300, t, "user", f"word {t % 7}") for t in range(800)]
    rows += [(301, t, "user", f"word {t % 7}") for t in range(800)]
    rows += [(400, None, "user", "first"), (400, 1, "user", "third"), (400, None, "user", "also first"), (400, 1, "user", "third")]
    rows += [(None, 1, "user", "in no conversation"), (401, 5, None, None), (999_999_999_999, 1, "user", "Hello there")]
    r.shuffle(rows)
    return rows


def nodes(spark, rows, extra=()):
    table = spark.createDataFrame(rows, SCHEMA).repartition(5).withColumns({c: F.lit("mine") for c in extra})
    found = prefix_trie.prefix_trie(*prefix_trie.with_shared_heads(prefix_trie.ordered_turns(table)))
    assert found.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return sorted(map(tuple, found.collect()), key=str)


@pytest.mark.parametrize("bits", [(16, 27), (3, 5)])
def test_equals_brute_force(spark, monkeypatch, bits):
    monkeypatch.setattr(prefix_trie, "_LEAST_BITS", bits[0])
    monkeypatch.setattr(prefix_trie, "_MOST_BITS", bits[1])
    monkeypatch.setattr(prefix_trie, "_PIECE", 7)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1" if bits[0] == 3 else before)
    try:
        assert nodes(spark, conversations(), ("conv", "pos", "digest", "depth", "size", "words", "part", "nth")) == brute(conversations())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.mark.parametrize("bits", [10, 12])
def test_false_estimates_inside_tails(spark, monkeypatch, bits):
    """A sketch that proves most tails and takes some of their inner prefixes for shared ones."""
    monkeypatch.setattr(prefix_trie, "_LEAST_BITS", bits)
    monkeypatch.setattr(prefix_trie, "_MOST_BITS", bits)
    rows = [(c, t, "user", f"turn {t} of {c}") for c in range(60) for t in range(8)]
    assert nodes(spark, rows) == brute(rows)


def test_small_tables(spark):
    assert nodes(spark, []) == []
    assert nodes(spark, [(None, 1, "user", "x")]) == []
    for rows in ([(5, 1, "user", "x y")], [(1, 1, None, None), (2, 1, None, None), (3, 1, None, None)]):
        assert nodes(spark, rows) == brute(rows)


def test_running_over_many_partitions(spark):
    r = random.Random(4)
    rows = [(0 if i % 3 else r.randint(-3, 6), i, r.randrange(1 << 62)) for i in range(3000)]
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = prefix_trie.running(spark.createDataFrame(rows, "k long, o long, v long").repartition(7), "k", [F.col("o")], ("v",)).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    want, count, total = {}, defaultdict(int), defaultdict(int)
    for k, o, v in sorted(rows):
        count[k] += 1
        total[k] = (total[k] + v) % (1 << 62)
        want[k, o] = (count[k], total[k])
    assert {(x.k, x.o): (x.nth, x.sum_v) for x in got} == want


def test_sketch_never_counts_too_low(spark):
    r = random.Random(6)
    values = [r.randrange(1 << 62) for _ in range(400)]
    rows = [(v, v ^ 12345) for v in values for _ in range(1 + (v % 3 == 0))]
    maps = prefix_trie.sketch_of_repeats(spark.createDataFrame(rows, "one long, two long").repartition(3), 12)
    for v in values:
        if v % 3 == 0:
            for lane, x in zip(maps, (v, v ^ 12345), strict=True):
                cell = x & 4095
                assert lane[cell >> 3] >> (7 - cell % 8) & 1
