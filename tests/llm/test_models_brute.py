"""Toxicity and language scores against plain versions of their definitions, and what nulls, ties and empty texts get."""

import math
import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from watchspan.llm import language_id, toxicity


def test_segments_of_any_scores_equal_their_definition():
    r = random.Random(4)

    def best(scores, lo, hi):
        top = max(((sum(scores[a : b + 1]), -(b - a), -a) for a in range(lo, hi) for b in range(a, hi)), default=None)
        if top is None or top[0] <= 0:
            return []
        a = -top[2]
        b = a - top[1]
        return best(scores, lo, a) + [(a, b, top[0])] + best(scores, b + 1, hi)

    for _ in range(300):
        scores = [r.choice([-3, -2, -1, 0, 1, 2, 4]) + 0.0 for _ in range(r.randint(0, 14))]
        got = toxicity.maximal_segments(*[x for x in (toxicity.scored_hits(scores)[0], 1.0, toxicity.scored_hits(scores)[1])])
        want = best(scores, 0, len(scores))
        assert sorted(s for *_, s in got) == sorted(s for *_, s in want)


def labelled(spark):
    r = random.Random(9)
    plain, vile = [f"plain{i}" for i in range(40)], [f"vile{i}" for i in range(8)]
    rows = []
    for i in range(160):
        words = [r.choice(plain) for _ in range(r.randint(5, 40))]
        toxic = int(i % 4 == 0)
        if toxic:
            at = r.randrange(len(words))
            words[at:at] = [r.choice(vile) for _ in range(6)]
        rows.append((i, " ".join(words), toxic))
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    return rows, docs, spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int")


def test_toxic_weights_and_evidence_equal_plain_ones(spark):
    rows, docs, labels = labelled(spark)
    model = toxicity.train(docs, labels)
    counts = {0: Counter(), 1: Counter()}
    for _, text, y in rows:
        counts[y].update(toxicity.features(text))
    n = [sum(counts[y].values()) for y in (0, 1)]
    every = set(counts[0]) | set(counts[1])
    prior, raw, spread = 0.1, {}, {}
    for f in every:
        y = [counts[k][f] for k in (0, 1)]
        a, a0 = prior * sum(y), prior * sum(n)
        odds = [math.log((y[k] + a) / (n[k] + a0 - y[k] - a)) for k in (0, 1)]
        raw[f], spread[f] = odds[1] - odds[0], sum(1 / (v + a) for v in y)
    heads = {f: raw[f] / (1 + spread[f]) for f in every if f.endswith("*")}
    want = {f: (raw[f] + spread[f] * (heads.get(f[:4] + "*", 0.0) if f not in heads and len(f) > 4 else 0.0)) / (1 + spread[f]) for f in every}
    names = sorted(want)
    values, known = model.weights.find([*names, "never met"])
    assert known.tolist() == [True] * len(names) + [False] and len(model.weights.hashes) == len(names)
    assert values[:-1].tolist() == pytest.approx([want[f] for f in names])
    texts = [(1, "vile1 vile2 vile3 plain1"), (2, "plain1 plain2"), (3, None), (4, ""), (5, "vileX unknown"), (6, "vile1 vile2 vile3 plain1")]
    got = {r.doc_id: r for r in toxicity.score(spark.createDataFrame(texts, "doc_id long, text string"), model).collect()}
    for i, text in texts:
        words = re.findall(r"\w+", (text or "").lower())
        scores = [want.get(w, heads.get(w[:4] + "*", 0.0) if len(w) > 4 else 0.0) - model.gap for w in words]
        hits, lost = toxicity.scored_hits(scores)
        expected = [model.rate * len(words) * math.exp(-model.decay * s) for *_, s in toxicity.maximal_segments(hits, 0.0, lost)]
        assert got[i].toxic_evidence == pytest.approx(sum(max(0.0, -math.log(max(e, 1e-300))) for e in expected))
        assert got[i].toxic_score == pytest.approx(model.probability(got[i].toxic_evidence))
        assert len(got[i].toxic_passages) == sum(e <= 0.05 for e in expected)
    assert got[3].toxic_score == got[4].toxic_score == min(r.toxic_score for r in got.values()) < 0.5 < got[1].toxic_score == got[6].toxic_score


def test_labels_beyond_the_bound_are_drawn(spark):
    _, docs, labels = labelled(spark)
    few = toxicity._labelled(docs, labels, 50)
    assert few.count() == 50
    assert sorted(map(tuple, few.collect())) == sorted(map(tuple, toxicity._labelled(docs.repartition(7), labels.repartition(5), 50).collect()))


def plain_language(rows, texts, lengths=4):
    counts = defaultdict(Counter)  # (language, size): items
    for text, lang in rows:
        for w in language_id.letter_runs(text):
            counts[lang, 0][w] += 1
            for k in range(1, lengths + 1):
                counts[lang, k].update(language_id.grams_of(w, k))
    langs = sorted({lang for lang, _ in counts})
    totals = {k: sum(c.values()) for k, c in counts.items()}
    penalty = 1 + max(math.log10(t) for t in totals.values())

    def value(size, item):
        known = [counts[lang, size][item] for lang in langs]
        if not any(known):
            return None
        return [math.log10(totals[lang, size]) - math.log10(n) if n else penalty for lang, n in zip(langs, known, strict=True)]

    out = []
    for text in texts:
        rows_ = []
        for w in language_id.letter_runs(text or ""):
            row = value(0, w)
            for k in range(lengths, 0, -1):
                if row is None and (found := [v for g in language_id.grams_of(w, k) if (v := value(k, g))]):
                    row = [sum(x) / len(found) for x in zip(*found, strict=True)]
            rows_.append(row or [penalty] * len(langs))
        if not rows_:
            out.append(("und", 0.0))
            continue
        mean = [sum(x) / len(rows_) for x in zip(*rows_, strict=True)]
        likely = [10 ** ((min(mean) - m) * math.sqrt(len(rows_))) for m in mean]
        out.append((langs[mean.index(min(mean))], 1 / sum(likely)))
    return out


def test_language_scores_equal_plain_ones(spark):
    rows = [("the river and the bank", "en"), ("le chat et la table", "fr"), ("der hund und die katze", "de"), ("the cat", "en"), ("la mer", "fr"), ("äöü größe", "de")]
    texts = ["the table and", "chatons et rivers", "xyzzy", "größer", "1234 !!", "", None, "q", "la", "The THE the"]
    model = language_id.train(spark.createDataFrame(rows + [("no language", None), (None, "fr")], "text string, lang string"))
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r for r in language_id.identify(frame, model).collect()}
    for i, (lang, share) in enumerate(plain_language(rows, texts)):
        assert got[i].lang_pred == lang and got[i].lang_score == pytest.approx(share), texts[i]


def test_equal_languages_go_by_name_and_many_are_taken(spark):
    rows = [(f"word common{i % 3}", f"l{i:04d}") for i in range(700)]
    model = language_id.train(spark.createDataFrame(rows, "text string, lang string"))
    found = language_id.identify(spark.createDataFrame([(1, "word")], "doc_id long, text string"), model).first()
    assert len(model.langs) == 700 and found.lang_pred == "l0000"


def test_labelled_texts_beyond_the_bound_are_drawn_evenly(spark):
    rows = [(i, f"text {i}", "en" if i % 10 else "fr") for i in range(2000)]
    drawn = language_id._drawn(spark.createDataFrame(rows, "doc_id long, text string, lang string"), 400)
    sizes = {r["lang"]: r["count"] for r in drawn.groupBy("lang").count().collect()}
    assert sizes["fr"] == 200 and 150 < sizes["en"] < 250
