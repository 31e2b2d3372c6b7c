"""The training-data operators against brute force on small tables with nulls, empty and long texts, ties and repeats."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece
from pyspark.sql import functions as F

from watchspan.llm import fingerprints, hmm, language_id, license_scan, mixing, near_dedup, sentencepiece_codec, sharding, topk, toxicity
from watchspan.llm.common import word_hashes
from watchspan.llm.near_dedup import near_groups
from watchspan.llm.queries import PIECES, QUERIES

LONG = " ".join(f"w{i % 977}" for i in range(20_000))
ROWS = [
    (1, "The quick brown fox jumps over the lazy dog near the river bank today", "en"),
    (2, "The quick brown fox jumps over the lazy dog near the river bank today", "en"),
    (3, "the QUICK brown fox", None),
    (4, "", "en"),
    (5, None, "fr"),
    (6, " \n\t ", "fr"),
    (7, "le chat noir dort sur la table de la cuisine", "fr"),
    (8, LONG, "en"),
    (None, "le chat noir dort", None),
    (9, "1234 567", "fr"),
    (9, "1234 567", "fr"),
]
SCHEMA = "doc_id long, text string, lang string"
# columns of names that operators use inside or add
EXTRA = ("score", "ids", "node", "shard", "slot", "label", "toxic_score", "mix_rate", "license_matches", "_text", "word", "set")


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA).withColumns({c: F.lit("x") for c in EXTRA})


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA).withColumns({c: F.lit("x") for c in EXTRA})


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if c.isascii() else c for c in text or ""))


def test_toxicity(spark, docs, empty):
    texts = [(i, f"plain words about gardens number {i} " * 5, 0) for i in range(60)] + [(100 + i, f"plain words about gardens vile scum filth {i} " * 5, 1) for i in range(30)]
    known = spark.createDataFrame([(i, t) for i, t, _ in texts], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in texts] + [(None, 1), (3, None)], "doc_id long, toxic int")
    model = toxicity.train(known, labels)
    unseen = spark.createDataFrame([(1, "calm words about gardens " * 5), (2, "vile scum filth " * 5)], "doc_id long, text string")
    got = {r.doc_id: r for r in toxicity.score(unseen, model).collect()}
    assert got[1].toxic_score < 0.5 < got[2].toxic_score
    assert got[2].toxic_passages[0].start == 0 and not got[1].toxic_passages
    assert toxicity.score(docs, model).count() == len(ROWS)
    assert toxicity.score(empty, toxicity.train(empty, labels.limit(0))).count() == 0


def test_maximal_segments_equal_their_definition():
    rng = np.random.default_rng(3)
    for _ in range(200):
        scores = rng.choice([-1.0, -1.0, 2.0, 3.0], 14)
        hits = [(i, s) for i, s in enumerate(scores.tolist()) if s > 0]

        def best(lo, hi):
            top = max(((sum(scores[a : b + 1]), -(b - a), -a) for a in range(lo, hi) for b in range(a, hi)), default=None)
            if top is None or top[0] <= 0:
                return []
            a = -top[2]
            b = a - top[1]
            return best(lo, a) + [(a, b, top[0])] + best(b + 1, hi)

        got = toxicity.maximal_segments(hits, 1.0)
        assert sum(s for *_, s in got) == pytest.approx(sum(s for *_, s in best(0, 14)))
        assert max((s for *_, s in got), default=0) == max((s for *_, s in best(0, 14)), default=0)


def jump(key, n):
    key, b, j = (key or 0) % (1 << 64), -1, 0
    while j < n:
        b = j
        key = (key * 2862933555777941757 + 1) % (1 << 64)
        j = int((b + 1) * (float(1 << 31) / ((key >> 33) + 1)))
    return b


def test_sharding(spark, docs, empty):
    got = sharding.shard_by_key(docs, 5).collect()
    assert len(got) == len(ROWS)
    want = Counter((i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode()), jump(i, 5), jump(i, 6)) for i, t, _ in ROWS)
    assert Counter((r.doc_id, r["size"], r.text_crc32, r.shard, r.grown_shard) for r in got) == want
    for s in {r.shard for r in got}:
        slots = sorted(r.slot for r in got if r.shard == s)
        assert slots == list(range(len(slots)))
    assert all(r.grown_shard in (r.shard, 5) for r in got)
    keys = spark.createDataFrame([(k,) for k in (-1, -(1 << 63), (1 << 63) - 1, 12345678901)], "k long")
    assert all(r.s.shard == jump(r.k, 24) for r in keys.select("k", sharding.jump_shards(F.col("k"), 24).alias("s")).collect())
    assert sharding.shard_by_key(empty, 5).count() == 0


def license_windows(text, templates, threshold):
    """All windows of a text by definition: the best from each word, without those that overlap a better one."""
    words, out = license_scan.words_of(text or ""), set()
    pairs = list(zip(words, words[1:]))
    for name, template in templates.items():
        t = license_scan.words_of(template)
        t = Counter(zip(t, t[1:]))
        size, best = sum(t.values()), []
        for a in range(len(pairs)):
            bag, top = Counter(), (0.0, a)
            for b in range(a, len(pairs)):
                bag[pairs[b]] += 1
                score = 2 * sum((bag & t).values()) / (b - a + 1 + size)
                if score > top[0]:
                    top = (score, b)
            # a window that does not begin with a bigram of the template is worse than the one without its first word
            if top[0] >= threshold and pairs[a] in t:
                best.append((a, top[1], top[0]))
        for a, b, s in best:
            if not any(c <= b and a <= d and (r > s or (r == s and c < a)) for c, d, r in best):
                out.add((name, a + 1, b - a + 2, round(s, 9)))
    return out


def test_license_scan(spark, docs, empty):
    mit, apache = "Released under the MIT License.", license_scan.NOTICES["Apache-2.0"]
    texts = [
        f"Intro words here\n{mit}\nmore", "released UNDER the mit licence", f"{mit} {mit}", f"{mit} {mit} " * 6, mit, None, "", " \n ", "license", "the " * 40,
        "This file is licensed under the Apache License, Version 2.0. See NOTICE for more of it.",
        "// Licensed under the\n//   Apache License,\n// Version 2.0. And on it goes", f"{apache[:-1]} or so {apache}", "a b a b a b a b a b a b a b", "x a b a b a y b a b a b",
        "Licensed under\u00a0the APACHE\u0130 license version 2 0 \u212a",
    ]
    rng = random.Random(5)
    notices = [n for n in license_scan.NOTICES.values() if len(n) < 300]
    for _ in range(60):
        words = " ".join(rng.choices(notices, k=2)).split()
        for _ in range(rng.randrange(8)):
            at = rng.randrange(len(words))
            words[at : at + rng.randrange(2)] = rng.choice((["odd"], [], [rng.choice(words)], ["the", "license"]))
        texts.append(rng.choice((" ", "\n", "\n # ")).join(words))
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    short = {n: t for n, t in license_scan.NOTICES.items() if len(t) < 300} | {"loop": "a b a b a b a b", "pair": "odd word"}
    for threshold in (0.8, 0.6, 1.0):
        found = 0
        for r in license_scan.scan(frame, short, threshold).collect():
            got = [(m.license, m.place, m.words, round(m.score, 9)) for m in r.license_matches]
            assert len(set(got)) == len(got) and set(got) == license_windows(r.text, short, threshold), r.text
            found += len(got)
        assert found > 60
    assert license_scan.scan(docs).count() == len(ROWS)
    assert license_scan.scan(empty).count() == 0
    assert license_scan.scan(frame, {}).filter("size(license_matches) > 0").count() == 0
    with pytest.raises(ValueError, match="two words"):
        license_scan.scan(frame, {"one": "license"})


def test_whole_licenses_in_long_texts(spark):
    whole = {n: t for n, t in license_scan.NOTICES.items() if n.endswith("full")}
    rows = []
    for i, (name, t) in enumerate(sorted(whole.items())):
        words = t.split()
        del words[10::30]
        lines = [" ".join(words[k : k + 9]) for k in range(0, len(words), 9)]
        rows.append((i, "some code here; " * 3000 + "\n * ".join(lines) + " other text" * 3000, name))
    frame = spark.createDataFrame(rows, "doc_id long, text string, name string")
    for r in license_scan.scan(frame).collect():
        own = [m for m in r.license_matches if m.license == r.name]
        assert len(own) == 1 and 9000 <= own[0].place <= 9002 + 40 and own[0].score >= 0.8, r.name
    clean = spark.createDataFrame([(1, "the software is provided for use of the license " * 2000)], "doc_id long, text string")
    assert not license_scan.scan(clean).first().license_matches



def test_language_id(spark, docs, empty):
    model = language_id.train(docs.select("text", "lang"))
    got = [(r.doc_id, r.lang_pred, r.lang_score) for r in language_id.identify(docs, model).collect()]
    assert len(got) == len(ROWS)
    by = {i: p for i, p, _ in got if i is not None}
    assert by[1] == "en" and by[7] == "fr" and by[4] == by[5] == by[6] == by[9] == "und"
    assert all(0 <= s <= 1 for *_, s in got)
    nothing = language_id.train(empty.select("text", "lang"))
    assert {r.lang_pred for r in language_id.identify(docs, nothing).collect()} == {"und"}


def test_mixing_reaches_targets(spark, docs, empty):
    rows = [(i, ("apple pear plum " if i % 4 else "iron steel zinc ") * (5 + i % 7)) for i in range(80)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, "fruit" if i % 4 else "metal") for i in range(0, 80, 2)] + [(None, "fruit"), (1, None)], "doc_id long, domain string")
    mixed, model = mixing.mix(frame, labels, {"fruit": 0.5, "metal": 0.5})
    got = mixed.collect()
    total = sum(r.mix_tokens for r in got)
    for d in range(len(model.domains)):
        reached = sum(r.mix_rate * r.mix_tokens * r.mix_posteriors[d] for r in got)
        assert reached == pytest.approx(total / 2, rel=0.01)
    assert all(r.mix_rate >= 0 and sum(r.mix_posteriors) == pytest.approx(1) and abs(r.mix_copies - r.mix_rate) < 1 for r in got)
    none, _ = mixing.mix(frame, labels, {"fruit": 1.0}, lose_none=False)
    by = {r.doc_id: r.mix_rate for r in none.collect()}
    assert by[4] < by[1]
    again, _ = mixing.mix(docs, labels, {"fruit": 1.0})
    assert again.count() == len(ROWS)
    assert mixing.mix(empty, labels, {"fruit": 1.0})[0].count() == 0
    assert {r.mix_rate for r in mixing.mix(docs, labels.limit(0), {"fruit": 1.0})[0].collect()} == {1.0}


def soft_docs(spark):
    """Posteriors with a domain below one hundredth in most documents."""
    rng = np.random.default_rng(8)
    rows = [(i, int(rng.integers(1, 400)), rng.dirichlet([6, 2, 0.02]).tolist()) for i in range(400)]
    return spark.createDataFrame(rows, "doc_id long, mix_tokens long, mix_posteriors array<double>")


def reached(held, model):
    rows = mixing.apply_rates(held, model).collect()
    sums = [sum(r.mix_rate * r.mix_tokens * r.mix_posteriors[d] for r in rows) for d in range(len(rows[0].mix_posteriors))]
    return np.array(sums), rows


def test_mixing_reaches_a_small_target_on_its_own_scale(spark):
    names = mixing.DomainModel(["a", "b", "c"], [0.0] * 3, [[0.0]] * 3)
    held = soft_docs(spark)
    model = mixing.fit(held, names, {"a": 0.8, "b": 0.195, "c": 0.005})
    sums, rows = reached(held, model)
    assert sums == pytest.approx(np.array([0.8, 0.195, 0.005]) * sum(r.mix_tokens for r in rows), rel=1e-3)
    with pytest.warns(UserWarning, match="no rates reach"):
        assert mixing.fit(held, names, {"c": 1.0}).residuals["c"] < -0.1


def test_mixing_reaches_shares_without_losing_documents(spark):
    names = mixing.DomainModel(["a", "b", "c"], [0.0] * 3, [[0.0]] * 3)
    held = soft_docs(spark)
    sums, rows = reached(held, mixing.fit(held, names, {"a": 0.6, "b": 0.38, "c": 0.02}, lose_none=True))
    assert sums / sums.sum() == pytest.approx([0.6, 0.38, 0.02], rel=1e-3)
    assert all(r.mix_rate >= 1 and r.mix_copies >= 1 for r in rows)


def test_posteriors_are_not_rounded(spark):
    model = mixing.DomainModel(["a", "b"], [math.log(0.996), math.log(0.004)], [[0.0], [0.0]])
    frame = spark.createDataFrame([(1, "word")], "doc_id long, text string")
    assert mixing.with_posteriors(frame, model).first().mix_posteriors == pytest.approx([0.996, 0.004])


def test_rates_equal_projected_gradient_in_numpy(spark):
    steps, momentum = [[0.3, -0.2], [0.1, 0.4], [-0.2, 0.9]], [0.0, 0.3, 0.4]
    p = spark.createDataFrame([([0.25, 0.75],), ([1.0, 0.0],), ([0.0, 1.0],)], "p array<double>")
    for r in p.select("p", mixing.rates(F.col("p"), steps, momentum)[0].alias("rate")).collect():
        rate = ahead = 1.0
        for e, m in zip(steps, momentum):
            new = max(0.0, ahead - sum(a * b for a, b in zip(r.p, e)))
            rate, ahead = new, new + m * (new - rate)
        assert r.rate == pytest.approx(rate)


def test_sentencepiece_equals_library(spark, docs, empty):
    model = sentencepiece_codec.read_model(PIECES)
    sp = sentencepiece.SentencePieceProcessor(model_proto=model)
    coded = sentencepiece_codec.decode(sentencepiece_codec.encode(docs, model), model)
    for r in coded.collect():
        assert r.ids == sp.encode(r.text or "")
        assert r.decoded == sp.decode(r.ids)
    odd = ["  two  blanks ", "▁mark", "emoji 😀  nbsp", "a" * 3000, "tab\tnew\nline", "　wide"]
    frame = spark.createDataFrame(list(enumerate(odd)), "doc_id long, text string")
    assert all(r.ids == sp.encode(r.text) for r in sentencepiece_codec.encode(frame, model).collect())
    assert sentencepiece_codec.encode(empty, model).count() == 0


def test_sentencepiece_takes_little_text_at_a_time(spark, monkeypatch):
    model = sentencepiece_codec.read_model(PIECES)
    sp = sentencepiece.SentencePieceProcessor(model_proto=model)
    docs = spark.createDataFrame([], "doc_id long, text string")
    monkeypatch.setattr(type(docs), "mapInArrow", lambda self, run, schema: run)
    texts = [f"word{i} of text " * 500 for i in range(400)]
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(400)), "text": texts})
    got = list(sentencepiece_codec.encode(docs, model)(iter([batch])))
    assert [x for b in got for x in b.column("doc_id").to_pylist()] == list(range(400))
    assert all(ids == sp.encode(texts[i]) for b in got for i, ids in zip(b.column("doc_id").to_pylist(), b.column("ids").to_pylist()))
    assert max(sum(map(len, b.column("text").to_pylist())) for b in got) <= 1 << 20


def test_sentencepiece_ids_are_laid_as_arrays():
    sp = sentencepiece.SentencePieceProcessor(model_proto=sentencepiece_codec.read_model(PIECES))
    texts = ["a b  c", "", " lead and trail ", "b a", "   ", "▁ a▁b", "ünï\tcode\nlines"]
    table = sentencepiece_codec.WordTable(sp, 4)  # starts anew
    for part in (texts, texts[:1], texts[3:4], texts[1:2], []):
        ids = table.ids(part)
        assert isinstance(ids, pa.ListArray) and ids.to_pylist() == [sp.encode(t) for t in part]
    assert sentencepiece_codec._rows(pa.array([[1], None, [], [2, 3]], pa.list_(pa.int32())).slice(1)) == [[], [], [2, 3]]


def test_top_k_equals_brute_force(spark):
    rng = np.random.default_rng(7)
    vectors = rng.normal(0, 0.2, (900, 8)).tolist()
    vectors[200:500] = [vectors[200]] * 300  # a large group of copies: ties by id
    rows = list(enumerate(vectors)) + [(900, None), (1000, [float("nan")] * 8), (1100, [None] + [0.1] * 7), (1200, [float("inf")] * 8), (None, vectors[0]), (1300, [0.5, 0.5])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("score", F.lit(1)).repartition(3)
    got = Counter(tuple(r) for r in topk.top_k(frame, frame.filter("vec_id % 100 = 0")).collect())
    real = {i: np.floor(1024 * np.array(v + [0] * (8 - len(v)), np.float32).astype(float)).astype(int) for i, v in rows if i is not None and v and None not in v and np.isfinite(v).all()}
    want = Counter()
    for q in (i for i in real if i % 100 == 0):
        best = sorted((-int(real[q] @ x), i) for i, x in real.items() if i != q)[:10]
        want.update((q, rank + 1, i, -s) for rank, (s, i) in enumerate(best))
    assert got == want
    few = frame.filter("vec_id < 4")
    assert topk.top_k(few, few.filter("vec_id = 0")).count() == 3
    assert topk.top_k(frame.limit(0), frame.limit(0)).count() == 0


def test_top_k_leaves_blocks_out():
    rng = np.random.default_rng(1)
    centres = rng.normal(0, 300, (16, 8))
    rows = np.concatenate([(c + rng.normal(0, 10, (256, 8))) for c in centres]).astype(np.int64)
    _, _, scored = topk.search(np.array([-1]), rows[:1], np.arange(len(rows)), rows, 10)
    assert scored < len(rows) / 2


def test_top_k_of_large_integers_is_exact():
    a = np.array([[2**40, 3]])
    assert topk.product(a, np.array([[2**20, 7]]))[0, 0] == 2**60 + 21


def test_hmm_base_and_counts(spark, docs, empty):
    held = F.col("doc_id") == 3
    got = hmm.score(docs, held).collect()
    train = Counter(w for i, t, _ in ROWS if i != 3 for w in [*words_of(t), None])
    n, v = sum(train.values()), len(train)
    assert len(got) == len(ROWS) and {r.train_tokens for r in got} == {n}
    want = Counter()
    for i, t, _ in ROWS:
        tokens = [*words_of(t), None]
        base = sum(math.log10((train[w] + 0.5) / (n + 0.5 * (v + 1))) for w in tokens)
        want[i, i == 3, len(tokens), sum(train[w] > 0 for w in tokens), round(base, 4)] += 1
    assert Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, round(r.base_score, 4)) for r in got) == want
    assert all(math.isfinite(r.score) for r in got)
    assert hmm.score(empty, held).count() == 0
    unlearned = hmm.score(docs, F.lit(True)).collect()
    assert all(r.score == pytest.approx(r.base_score) and r.n_known == 0 for r in unlearned)


def test_hmm_recursions_equal_sums_over_paths():
    rng = np.random.default_rng(5)
    k = hmm.STATES
    first, moves, ratio = rng.dirichlet(np.ones(k)), rng.dirichlet(np.ones(k), k), rng.random((4, k)) + 0.1
    texts = [[0, 1, 2], [3], [1, 1]]
    packed = hmm.Packed(np.array(sum(texts, [])), np.array([len(t) for t in texts]))
    gamma, moved, begun = packed.expected(ratio, first, moves)
    scale, _ = packed.forward(ratio, first, moves, False)
    want_moves, want_first = np.zeros((k, k)), np.zeros(k)
    for rank, i in enumerate(packed.order):
        paths = {}
        for path in np.ndindex(*[k] * len(texts[i])):
            p = first[path[0]] * ratio[texts[i][0], path[0]]
            for a, b, w in zip(path, path[1:], texts[i][1:]):
                p *= moves[a, b] * ratio[w, b]
            paths[path] = p
        total = sum(paths.values())
        assert np.log(scale[packed.text == rank]).sum() == pytest.approx(math.log(total))
        for path, p in paths.items():
            want_first[path[0]] += p / total
            for a, b in zip(path, path[1:]):
                want_moves[a, b] += p / total
    assert np.allclose(moved, want_moves) and np.allclose(begun, want_first)
    assert np.allclose(gamma.sum(axis=1), 1)


def test_hmm_blocks_hold_each_text_once(monkeypatch):
    monkeypatch.setattr(hmm, "BLOCK", 9)
    rng = np.random.default_rng(6)
    lengths = np.array([3, 1, 20, 5, 4, 1, 8])
    tokens, ratio = rng.integers(0, 30, lengths.sum()), rng.random((30, hmm.STATES)) + 0.1
    first, moves = np.full(hmm.STATES, 1 / hmm.STATES), hmm._sticky()
    whole = hmm.Packed(tokens, lengths)
    want = whole.expected(ratio, first, moves)
    met, moved, begun, gain, sums = [], 0, 0, 0, np.zeros((30, hmm.STATES))
    for mine, packed in hmm._blocks(tokens, lengths):
        gamma, m, b = packed.expected(ratio, first, moves)
        np.add.at(sums, packed.tokens, gamma)
        met, moved, begun, gain = [*met, *mine], moved + m, begun + b, gain + packed.gain
        assert len(mine) == 1 or len(packed.tokens) <= 9
    one = np.zeros_like(sums)
    np.add.at(one, whole.tokens, want[0])
    assert sorted(met) == list(range(7)) and gain == pytest.approx(whole.gain)
    assert np.allclose(moved, want[1]) and np.allclose(begun, want[2]) and np.allclose(sums, one)


def test_hmm_long_texts_equal_recursions_scaled_at_each_place():
    rng = np.random.default_rng(7)
    k, lengths = hmm.STATES, np.array([70, 16, 17, 1, 33, 32, 48])
    first, moves = rng.dirichlet(np.ones(k)), rng.dirichlet(np.ones(k), k)
    tokens, ratio = rng.integers(0, 9, lengths.sum()), rng.gamma(0.3, 2, (9, k)) + 0.003
    packed = hmm.Packed(tokens, lengths)
    gamma, moved, _ = packed.expected(ratio, first, moves)
    scale, _ = packed.forward(ratio, first, moves, False)
    assert (scale != 1).sum() <= sum(n // 16 + 1 for n in lengths)  # shares are scaled to one now and then, not at each token
    want_moves, ends = np.zeros((k, k)), np.cumsum(lengths)
    for rank, i in enumerate(packed.order):
        met, shares, total = ratio[tokens[ends[i] - lengths[i] : ends[i]]], [], 0.0
        for place, r in enumerate(met):
            a = (shares[-1] @ moves if place else first) * r
            total += math.log(a.sum())
            shares.append(a / a.sum())
        assert np.log(scale[packed.text == rank]).sum() == pytest.approx(total)
        back, want = np.ones(k), []
        for place in range(len(met) - 1, -1, -1):
            want.append(shares[place] * back / (shares[place] @ back))
            if place:
                x = shares[place - 1][:, None] * moves * (met[place] * back)[None, :]
                want_moves += x / x.sum()
                back = moves @ (met[place] * back)
                back /= back.sum()
        assert np.allclose(gamma[packed.text == rank], want[::-1])
    assert np.allclose(moved, want_moves)


def test_hmm_slices_hold_texts_in_the_order_of_blocks(monkeypatch):
    monkeypatch.setattr(hmm, "BLOCK", 9)
    rng = np.random.default_rng(8)
    lengths = np.array([3, 1, 20, 5, 4, 1, 8])
    words, held = rng.integers(0, 12, lengths.sum()).astype(np.uint64), np.array([False, True, False, False, True, False, False])
    row = hmm._slice(0, [(words, lengths, held, list(range(7)))]).to_pylist()[0]
    out = np.repeat(held, lengths)
    for which, names, mine in (("learned", np.unique(words[~out]), ~held), ("others", np.unique(words), held)):
        tokens = np.frombuffer(row[which], np.uint16)
        blocks = hmm._blocks(words[np.repeat(mine, lengths)], lengths[mine])
        for (a, packed), (b, again) in zip(blocks, hmm._blocks(tokens, lengths[mine], True), strict=True):
            assert a.tolist() == b.tolist() and packed.edges == again.edges
            assert packed.tokens.tolist() == names[again.tokens].tolist()


def test_hmm_texts_are_dealt_once(spark, docs):
    scored = hmm.score(docs, F.col("doc_id") == 3)
    plan = scored._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1  # the ratios', not that of the texts
    assert not [t for t in spark.catalog.listTables() if t.name.startswith(("slices_", "buckets_"))]
    assert scored.count() == len(ROWS)


def test_hmm_beats_the_base(spark):
    rng = np.random.default_rng(2)
    tongues = [[f"{c}{i}" for i in range(60)] for c in "ab"]
    rows = [(i, " ".join(rng.choice(tongues[i % 2], 40))) for i in range(400)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = hmm.score(frame, F.col("doc_id") % 5 == 1).filter("held_out").agg(F.sum("base_score"), F.sum("score")).first()
    assert got[1] > got[0] + 800  # telling two tongues apart is worth 963 at most


def test_hmm_equals_full_training_until_the_likelihood_rests(spark, monkeypatch):
    monkeypatch.setattr(hmm, "ENTRIES", 40)  # several buckets
    monkeypatch.setattr(hmm, "CLOSE", 0.02)
    rng = np.random.default_rng(3)
    texts = [" ".join(rng.choice([f"{'ab'[i % 2]}{j}" for j in range(30)], 12)) + f" rare{i}" for i in range(60)]
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(3)
    got = {r.doc_id: r.score for r in hmm.score(frame, F.col("doc_id") % 5 == 1).collect()}
    k, train = hmm.STATES, [t for i, t in enumerate(texts) if i % 5 != 1]
    count = Counter(w for t in train for w in [*t.split(), None])
    n, v, once = sum(count.values()), len(count), sum(c == 1 for c in count.values())
    unit = n + 0.5 * (v + 1)
    base = {w: (c + 0.5) / unit for w, c in count.items()}
    seen = [w for w in count if w]
    raw = word_hashes(np.frombuffer(" ".join(seen).encode(), np.uint8), np.array([0, len(" ".join(seen))]))[0]
    ratio = dict(zip([*seen, None], hmm._drawn(np.append(raw, hmm.END))))
    first, moves, before, passes = np.full(k, 1 / k), hmm._sticky(), -np.inf, 0

    def forward(words, r):
        a, out, total = None, [], 0.0
        for w in words:
            a = (first if a is None else a @ moves) * r(w)
            total += math.log(a.sum())
            a = a / a.sum()
            out.append(a)
        return out, total

    while True:
        e, moved, begun, gain, passes = {w: np.zeros(k) for w in count}, np.zeros((k, k)), np.zeros(k), 0.0, passes + 1
        for t in train:
            words = [*t.split(), None]
            shares, own = forward(words, ratio.get)
            gain += own
            b = np.ones(k)
            for i in range(len(words) - 1, -1, -1):
                g = shares[i] * b / (shares[i] @ b)
                e[words[i]] += g
                if i:
                    x = shares[i - 1][:, None] * moves * (ratio[words[i]] * b)[None, :]
                    moved += x / x.sum()
                    b = moves @ (ratio[words[i]] * b)
                    b /= b.sum()
            begun += g
        totals = sum(e.values())
        prior = hmm.PRIOR * totals.sum() / k
        kept = 1 / (1 - prior * 0.5 / unit / (totals + prior))
        ratio = {w: (e[w] / base[w] + prior) / (totals + prior) * kept for w in count}
        first, moves = (begun + 1 / k) / (begun + 1 / k).sum(), moved + hmm._sticky()
        moves /= moves.sum(axis=1, keepdims=True)
        if gain - before <= hmm.CLOSE * n:
            break
        before = gain
    assert passes > 3
    rare = sum(e[w] for w in count if count[w] == 1)
    unseen = np.clip((rare + prior * once * 1.5 / unit) / (totals + prior), 0.5 / unit, 0.5)
    for i, t in enumerate(texts):
        words = [*t.split(), None]
        _, own = forward(words, lambda w: ratio[w] * (1 - unseen) if w in ratio else unseen * unit / 0.5)
        assert got[i] == pytest.approx(sum(math.log10(base.get(w, 0.5 / unit)) for w in words) + own / math.log(10), rel=1e-3)


def shingles(text, k):
    w = words_of(text)
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())


def test_near_groups_equal_brute_force(spark, docs, empty):
    rng = np.random.default_rng(11)
    rows = []
    for g in range(12):
        base = [f"g{g}x{i}" for i in range(60)]
        for c in range(6):
            t = list(base)
            for _ in range(int(rng.integers(0, 4))):
                t[int(rng.integers(60))] = f"n{rng.integers(9)}"
            rows.append((g * 6 + c, " ".join(t)))
    rows += [(500, ""), (501, None), (502, "two words"), (503, "Two  WORDS")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    sets = {i: shingles(t, 4) for i, t in rows}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in sets:
        for j in sets:
            if i < j and sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in near_groups(frame, words=4).collect()}
    assert got == {i: (len(s), find(i), find(i) == i) for i, s in sets.items()}
    assert near_groups(docs, words=4).count() == len(ROWS)
    assert near_groups(empty).count() == 0


def test_near_groups_of_nodes_spread_over_many_tiles(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "TILE_SHINGLES", 20)
    rows = []
    for g in range(15):  # two texts each that share bands but are less than 0.8 alike, and a copy of one
        base = [f"g{g}x{i}" for i in range(60)]
        other = [f"n{i}" if i in (10, 30, 50) else w for i, w in enumerate(base)]
        rows += [(3 * g, " ".join(base)), (3 * g + 1, " ".join(other)), (3 * g + 2, " ".join(base[:-1]))]
    got = {r.doc_id: r.component_id for r in near_groups(spark.createDataFrame(rows, "doc_id long, text string"), words=4).collect()}
    assert got == {i: i - i % 3 if i % 3 != 1 else i for i, _ in rows}


def test_fingerprints(spark):
    a = "\n\n".join(f"paragraph number {i} with words" for i in range(40))
    b = a.replace("number 7 ", "number seven ")
    rows = [(1, a, a), (2, a, b), (3, "", ""), (4, a, "something else")]
    frame = spark.createDataFrame(rows, "doc_id long, l string, r string")
    got = {r.doc_id: r for r in fingerprints.compare(frame, "l", "r", "f_", digests=False).collect()}
    assert got[1].f_fingerprint_left == got[1].f_fingerprint_right and got[1].f_likeness == got[3].f_likeness == 1
    assert got[2].f_fingerprint_left != got[2].f_fingerprint_right and 0.8 < got[2].f_likeness < 1
    assert got[4].f_likeness < 0.1


def test_fingerprints_query_bounds_arrow_batches(spark, sf_dir):
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    spark.conf.unset(name)
    try:
        QUERIES["op10_fingerprints"](spark, sf_dir)
        assert spark.conf.get(name) == "4m" and fingerprints.SLICE_BYTES <= 1 << 20
    finally:
        spark.conf.unset(name)
