"""Ids at both ends of 64 bits, rows without id, very large components, and user columns of every internal name."""

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from watchspan.llm import fingerprints, language_id, license_scan, mixing, sentencepiece_codec, topk, toxicity
from watchspan.llm.common import documents
from watchspan.llm.near_dedup import near_groups
from watchspan.llm.queries import PIECES, QUERIES

LOW, HIGH = -(1 << 63), (1 << 63) - 1
A = " ".join(f"alpha{i}" for i in range(40))
B = " ".join(f"beta{i}" for i in range(40))
C = " ".join(f"gamma{i}" for i in range(40))


def test_near_groups_of_any_id_and_of_none(spark):
    rows = [(HIGH, A), (HIGH - 1, A), ((1 << 62) + 5, B), ((1 << 62) + 6, B + " more"), (LOW, C), (None, C), (None, A), (None, "only here one two"),
            (None, "only here one two"), (LOW + 2, ""), (None, ""), (7, None)]
    got = sorted(((r.doc_id, r.component_id, r.kept) for r in near_groups(spark.createDataFrame(rows, "doc_id long, text string"), words=4).collect()), key=str)
    want = [(HIGH, HIGH - 1, False), (HIGH - 1, HIGH - 1, True), ((1 << 62) + 5, (1 << 62) + 5, True), ((1 << 62) + 6, (1 << 62) + 5, False),
            (LOW, LOW, True), (None, LOW, False), (None, HIGH - 1, False), (None, None, True), (None, None, True), (LOW + 2, LOW + 2, True), (None, None, True), (7, 7, True)]
    assert got == sorted(want, key=str)


def brute_next(rows):
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, -(rows[i][0] or 0)))
    return [(rows[i][0], rows[i][1], rows[order[(k + 1) % len(order)]][1]) for k, i in enumerate(order)]


@pytest.mark.parametrize("size", [2, 5, 2000])
def test_next_document_of_any_ids(spark, size):
    ids = [LOW, LOW + 2, -5, 0, 5, HIGH - 2, HIGH, 1, 2, 3, 1000, 10**15]
    rows = [(i, f"text of {i}") for i in ids]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert sorted(map(tuple, fingerprints.with_next(frame, rows=size).collect())) == sorted(brute_next(rows))


@pytest.mark.parametrize("size", [2, 2000])
def test_next_document_with_repeated_and_missing_ids(spark, size):
    rows = [(None, f"none {i}") for i in range(20)] + [(5, f"five {i}") for i in range(20)] + [(9, "nine")] * 3 + [(1, None)]
    got = fingerprints.with_next(spark.createDataFrame(rows, "doc_id long, text string"), rows=size).collect()
    assert sorted(((r.doc_id, r.text) for r in got), key=str) == sorted(rows, key=str)
    # every text is the next one of exactly one row: a ring over all rows, by falling id
    assert sorted((r.next_text for r in got), key=str) == sorted((t for _, t in rows), key=str)
    assert {r.next_text[:4] if r.next_text else None for r in got if r.doc_id == 9} == {"nine", "five"}
    alone = spark.createDataFrame([(3, "x")], "doc_id long, text string")
    assert fingerprints.with_next(alone).collect() == [(3, "x", "x")]
    assert fingerprints.with_next(alone.limit(0)).collect() == []


def test_fingerprint_query_equals_brute_force(spark, sf_dir):
    rows = sorted(((r.doc_id, r.text or "") for r in documents(spark, sf_dir).collect()), reverse=True)
    got = {r.doc_id: r for r in QUERIES["op10_fingerprints"](spark, sf_dir).collect()}
    assert len(got) == len(rows)
    for k, (i, text) in enumerate(rows):
        other = rows[(k + 1) % len(rows)][1]
        half = len(text) // 2
        edited = text[: len(text) - half] + other[:half]
        r = got[i]
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        assert (r.fingerprint == r.edited_fingerprint) == (text == edited) or r.near_edited < 1
        keys = []
        for t in (text, edited, other):
            raw = t.encode()
            keys.append(set(fingerprints.paragraph_keys(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))[0].tolist()))
        for near, b in ((r.near_edited, keys[1]), (r.near_next, keys[2])):
            both = len(keys[0] | b)
            assert near == pytest.approx(len(keys[0] & b) / both if both else 1.0)


def test_top_k_of_large_components(spark):
    big = 5e12
    rows = [(0, [1.0, 0.0]), (1, [big, 1.0]), (2, [-big, 1.0]), (3, [0.5, big]), (100, [0.0, 1.0])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = [tuple(r) for r in topk.top_k(frame, frame.filter("vec_id % 100 = 0")).collect()]
    whole = {i: [int(np.floor(1024 * x)) for x in v] for i, v in rows}
    want = []
    for q in (0, 100):
        scores = sorted((-sum(a * b for a, b in zip(whole[q], v, strict=True)), i) for i, v in whole.items() if i != q)
        want += [(q, k + 1, i, -s) for k, (s, i) in enumerate(scores)]
    assert sorted(got) == sorted(want)
    for bad in ([(0, [big, 0.0]), (1, [big, 0.0])], [(0, [1e30, 0.0]), (1, [1.0, 1.0])]):
        with pytest.raises(Exception, match="64 bits"):
            topk.top_k(spark.createDataFrame(bad, frame.schema), spark.createDataFrame(bad, frame.schema)).collect()


NAMES = ("_text", "_left", "_right", "_filled", "_words", "_buckets", "_odds", "_likely", "_clean", "_units", "_lines", "_blocks", "id", "node", "tie", "bucket")


def test_columns_of_internal_names_pass_unchanged(spark):
    rows = [(i, f"some plain words number {i} and a few more of them", "en", i % 2) for i in range(30)] + [(40, None, "en", 1), (41, "", None, 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, toxic int")
    wide = docs.withColumns({n: F.concat(F.lit(n), F.col("doc_id")) for n in NAMES})
    model = sentencepiece_codec.read_model(PIECES)
    mixed, _ = mixing.mix(wide, docs.select("doc_id", F.lit("one").alias("domain")), {"one": 1.0})
    outputs = {
        "toxicity": toxicity.score(wide, toxicity.train(docs, docs.select("doc_id", "toxic"))),
        "language": language_id.identify(wide, language_id.train(docs.select("text", "lang"))),
        "licence": license_scan.scan(wide),
        "mixing": mixed,
        "sentencepiece": sentencepiece_codec.encode(wide, model),
        "fingerprints": fingerprints.compare(wide, "text", "lang"),
    }
    for name, out in outputs.items():
        found = {r.doc_id: tuple(r[n] for n in NAMES) for r in out.collect()}
        assert found == {i: tuple(f"{n}{i}" for n in NAMES) for i, *_ in rows}, name
