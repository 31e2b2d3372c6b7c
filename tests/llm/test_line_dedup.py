"""Line deduplication against brute force: nulls, repeats, long texts, hot lines, clashing names."""

import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from watchspan.llm import line_dedup

LINE = "this Line is held by several documents, and it is long enough to count"
OTHER = "another line of forty code points, at least: äöüß and so on and so on"
LONG = "\n".join(f"line {i % 700} of a very long text that goes on for many, many lines" for i in range(5000))
ROWS = (
    [(i, f"own line {i} which is long enough to be counted as a line\n  {LINE.upper() if i % 2 else LINE}\t\nshort\n") for i in range(8)]
    + [(100 + i, f"{OTHER}\n{OTHER}\nx{i}") for i in range(5)]
    + [(200 + i, LONG + f"\n{i}") for i in range(6)]
    + [(300, None), (301, ""), (302, "\n"), (303, "short\nshort"), (None, LINE), (None, f"{LINE}\n{OTHER}")]
    + [(7, LINE), (7, LINE), (104, f"y\n{OTHER}")]
    + [(400 + i, "held by four documents only, so every one of them keeps it") for i in range(4)]
)


def brute(rows, least_chars, least_docs):
    def key(line):
        return "".join(c.lower() if c.isascii() else c for c in line.strip(" \t\n\x0b\x0c\r"))

    held = defaultdict(set)
    for i, text in rows:
        for line in (text or "").split("\n"):
            if len(key(line)) >= least_chars:
                held[key(line)].add(i)
    rank = lambda i: (i is not None, i)
    out = []
    for i, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if len(held[key(x)]) < least_docs or i == max(held[key(x)], key=rank)]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=str)


@pytest.mark.parametrize("hot", [1, 1000])
@pytest.mark.parametrize("least", [(40, 5), (1, 2), (6, 3)])
def test_equals_brute_force(spark, monkeypatch, least, hot):
    monkeypatch.setattr(line_dedup, "_HOT", hot)
    docs = spark.createDataFrame(ROWS, "doc_id long, text string").repartition(3)
    docs = docs.withColumns({c: F.lit("mine") for c in ("id", "version", "keep", "lines", "pos", "salt", "word", "high")})
    got = line_dedup.dedup_lines(docs, least_chars=least[0], least_docs=least[1])
    assert sorted(((r.doc_id, r.n_lines, r.n_dropped, r.kept_text) for r in got.collect()), key=str) == brute(ROWS, *least)


def test_bitmaps_name_the_dropped_lines(spark):
    docs = spark.createDataFrame(ROWS[:8], "doc_id long, text string")
    maps = {r.id: [tuple(w) for w in r.keep] for r in line_dedup.keep_bitmaps(docs).collect()}
    assert maps == {i: [(0, ~2)] for i in range(7)}


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert line_dedup.dedup_lines(docs).collect() == []


def test_windows_add_no_shuffle(spark, monkeypatch):
    plans = []
    kept = line_dedup.stored
    monkeypatch.setattr(line_dedup, "stored", lambda df, label: plans.append(df._jdf.queryExecution().toString()) or kept(df, label))
    line_dedup.keep_bitmaps(spark.createDataFrame(ROWS, "doc_id long, text string"))
    executed = plans[1].split("Physical Plan")[1]
    assert len(re.findall(r"Exchange rangepartitioning", executed)) == 1 and "hashpartitioning" not in executed
