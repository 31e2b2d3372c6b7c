"""Periodic runs against brute force: random words, planted periods, nulls, long texts, clashing names."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from watchspan.llm import periodic_runs
from watchspan.llm.common import documents
from watchspan.llm.queries import QUERIES


def brute(words, least_words=6, least_periods=4):
    found = []
    for q in range(1, len(words) // least_periods + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            size = j + q - i
            smaller = any(all(words[x] == words[x + p] for x in range(i, i + size - p)) for p in range(1, q))
            if j > i and size >= max(least_words, least_periods * q) and not smaller:
                found.append((i, size, q))
            i = j + 1
    return sorted(found)


def changed(key, words):
    h = zlib.crc32(str("" if key is None else key).encode())
    g, n = h // 10, len(words)
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def expected(key, text):
    words = changed(key, (text or "").encode().split())
    runs = brute(words)
    best = min(((-size, i, q) for i, size, q in runs), default=None)
    gone = {x for i, size, q in runs for x in range(i + q, i + size)}
    digest = lambda b: hashlib.sha256(b).hexdigest()
    longest = (None,) * 4 if best is None else (best[1], -best[0], best[2], -best[0] * 1000 // best[2])
    kept = b" ".join(w for i, w in enumerate(words) if i not in gone)
    return (key, len(runs), *longest, digest("".join(f"{i},{size},{q}\n" for i, size, q in runs).encode()), digest(kept))


def random_words(r):
    words = [r.choice("abcdefgh"[: r.randint(1, 8)]) for _ in range(r.randint(0, 70))]
    if words and r.random() < 0.6:
        part = [r.choice("abc") for _ in range(r.randint(1, 7))]
        words += part * r.randint(2, 9) + part[: r.randint(0, 3)]
    return words + words[: r.randint(0, 5)]


@pytest.mark.parametrize("least", [(6, 4), (1, 2), (3, 3), (4, 5)])
def test_runs_equal_brute_force(least):
    r = random.Random(sum(least))
    for _ in range(150):
        texts = [random_words(r) for _ in range(r.randint(0, 4))]
        assert periodic_runs.runs_of_texts(texts, *least) == [brute(t, *least) for t in texts]


def test_suffix_array_and_prefixes():
    r = random.Random(3)
    for _ in range(100):
        values = np.array([r.randint(0, 3) for _ in range(r.randint(1, 60))] + [9])
        order = periodic_runs.suffix_array(values)
        assert order.tolist() == sorted(range(len(values)), key=lambda i: values[i:].tolist())
        place = np.argsort(order)
        shared = periodic_runs.common_prefixes(values, order, place)
        for k in range(1, len(values)):
            a, b = values[order[k - 1] :].tolist(), values[order[k] :].tolist()
            assert shared[k] == next((x for x in range(min(len(a), len(b))) if a[x] != b[x]), min(len(a), len(b)))


def test_query_equals_brute_force(spark, monkeypatch):
    r = random.Random(1)
    rows = [(i, "\n \t".join(random_words(r))) for i in range(120)]
    rows += [(500, None), (501, ""), (502, " \n"), (None, "a " * 9), (None, None), (503, "a a " * 4), (503, "a a " * 4), (-4, "x y " * 40)]
    rows += [(600 + i, " ".join(f"w{k % (40 + i)}" for k in range(900)) + " end") for i in range(12)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit("mine") for c in ("key", "runs", "collapsed", "best", "listed", "start")})
    found = periodic_runs.digests(periodic_runs.find_runs(docs, change=periodic_runs.planted))
    assert sorted(map(tuple, found.collect()), key=str) == sorted((expected(*r) for r in rows), key=str)


def test_long_text(spark):
    period = " ".join(f"v{i}" for i in range(700))
    text = " ".join(["start", *[period] * 60, "a " * 30_000])
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    runs = periodic_runs.find_runs(docs).first()["runs"]
    assert [tuple(x) for x in runs] == [(1, 42_000, 700), (42_001, 30_000, 1)]


def test_registered_query(spark, sf_dir):
    rows = [(r.doc_id, r.text) for r in documents(spark, sf_dir).collect()]
    short = [r for r in rows if len((r[1] or "").split()) < 400]
    got = {r.doc_id: tuple(r) for r in QUERIES["op12_periodic_runs"](spark, sf_dir).collect()}
    assert len(got) == len(rows) and any(r[1] for r in got.values())
    for r in short:
        assert got[r[0]] == expected(*r)


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert periodic_runs.digests(periodic_runs.find_runs(docs)).collect() == []
