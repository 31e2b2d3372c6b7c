"""Mixing to target weights with soft membership.

Learning. A labelled table (id, domain) names the domain of some documents. Words are hashed to `buckets`; a multinomial
model with smoothed counts gives each bucket a log-probability per domain. At most `most_labels` labelled ids are used,
those of the smallest hash, so that they can be broadcast and no text is shuffled.

Membership. A document's log-odds are the domain's prior plus the word scores, weighed as if the text had as many
independent words as the square root of its length.

Fit. Rates of `least` or more shall bring the expected tokens of each domain, sum r t p, to its target: least squares over as many
rates as there are documents. Projected gradient steps solve it. A step moves every rate against the residuals, weighed by the
document's posteriors, and back to `least` where it went below. Residuals are measured in the metric of the domains'
covariance over the rates that are not at their bound, in which one step would do if no further rate met it; so a dozen steps
suffice. A rate is told by its document's posteriors and the weighed residuals of all steps, so these are the model: a step
takes one aggregate over the stored documents, of which sums per domain and pair of domains reach the driver, and applying the
model needs neither a join nor a shuffle. Every few steps the documents' rates are stored, so that a step need not go back to the
first one. Without a budget and with `lose_none` the shares alone are the target. Steps end when every domain is within `close`
of its own target or when the residuals rest. If they rest above that, no moderate rates reach the targets: steps in plain
tokens from rates of 1 on then tell the rates. Residuals are kept with the model, and a warning tells of them.

Everything is column expressions.
"""

from __future__ import annotations

import warnings
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from watchspan.llm.common import discard, stored, unused

REST, STORE = 12, 8  # steps over which the largest residual shall fall by a quarter, and after which rates are stored
_ADDED = ("mix_tokens", "mix_posteriors", "mix_rate", "mix_copies")


@dataclass(frozen=True)
class DomainModel:
    domains: list[str]
    priors: list[float]  # log share of each domain
    weights: list[list[float]]  # by domain and bucket


@dataclass(frozen=True)
class RateModel:
    """Steps of the rate and their momentum, as `rates` takes them, and what the fit left of each domain's target."""

    steps: list[list[float]]
    momentum: list[float]
    least: float = 0.0
    residuals: dict[str, float] = field(default_factory=dict)  # relative to the domain's own target, to all tokens where that is 0


def words_of(text: Column) -> Column:
    """Lower-case words between white space; none for null, empty and blank texts."""
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[\s]+"), lambda w: w != "")


def _bucket(word: Column, buckets: int) -> Column:
    return F.pmod(F.hash(word), F.lit(buckets))


def train(docs: DataFrame, labelled: DataFrame, text: str = "text", key: str = "doc_id", buckets: int = 2048, most_labels: int = 20_000) -> DomainModel:
    """Learn from docs and labelled (key, domain string). Rows with a null key or domain are left out; a key with several
    domains counts with the first in order. Without any labelled document there is one domain, the empty name."""
    marks = labelled.select(F.col(key).alias("_key"), "domain").filter("_key is not null and domain is not null")
    n = marks.count()
    draw = F.xxhash64("_key").bitwiseAND(F.lit((1 << 30) - 1))
    # about the right number by a bound on the hash first, so that few rows reach the exact cut
    marks = marks.groupBy("_key").agg(F.min("domain").alias("domain"))
    marks = marks.filter(draw < int((1 << 30) * min(1.0, 1.5 * most_labels / max(n, 1)))).orderBy(draw, "_key").limit(most_labels)
    known = docs.select(F.col(f"`{key}`").alias("_key"), F.col(f"`{text}`").alias("_text")).join(F.broadcast(marks), "_key")
    words = known.select("domain", F.explode(F.concat(words_of(F.col("_text")), F.array(F.lit("")))).alias("word"))
    bucket = F.when(F.col("word") == "", -1).otherwise(_bucket(F.col("word"), buckets))
    counts = {(r.domain, r.bucket): r.n for r in words.groupBy("domain", bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("n")).collect()}
    domains = sorted({d for d, _ in counts}) or [""]
    rows = [counts.get((d, -1), 0) + 1 for d in domains]
    model_priors = [_log(x / sum(rows)) for x in rows]
    # smoothing in proportion to the bucket's total, so that frequent words don't tell small domains apart by chance
    total = [sum(counts.get((d, b), 0) for d in domains) for b in range(buckets)]
    everything = sum(total) + buckets
    weights = []
    for d in domains:
        own = [counts.get((d, b), 0) for b in range(buckets)]
        strength = float(buckets)
        weights.append([_log((c + strength * (t + 1) / everything) / (sum(own) + strength)) for c, t in zip(own, total, strict=True)])
    return DomainModel(domains, model_priors, weights)


def _log(x: float) -> float:
    import math

    return math.log(x)


def with_posteriors(docs: DataFrame, model: DomainModel, text: str = "text") -> DataFrame:
    """docs with mix_tokens (words, long) and mix_posteriors (array of double in the order of model.domains that add up
    to 1). A text without words has the prior. Columns of these names are replaced."""
    names = [c for c in docs.columns if c not in _ADDED]
    buckets = len(model.weights[0])
    kept = [F.col(f"`{c}`") for c in names]
    words, places, odds_of, likely_of = (unused(c, names) for c in ("_words", "_buckets", "_odds", "_likely"))
    base = docs.select(*kept, words_of(F.col(f"`{text}`")).alias(words))
    base = base.select(*kept, F.size(words).cast("long").alias("mix_tokens"), F.transform(words, lambda w: _bucket(w, buckets)).alias(places))
    first = model.weights[0]

    def odds(d: int) -> Column:
        table = F.lit([x - y for x, y in zip(model.weights[d], first, strict=True)])
        evidence = F.aggregate(places, F.lit(0.0), lambda s, b: s + F.get(table, b))
        return F.lit(model.priors[d] - model.priors[0]) + evidence / F.sqrt(F.greatest(F.col("mix_tokens"), F.lit(1)))

    base = base.select(*kept, "mix_tokens", F.array(F.lit(0.0), *(odds(d) for d in range(1, len(model.domains)))).alias(odds_of))
    likely = F.transform(odds_of, lambda x: F.exp(x - F.array_max(odds_of)))
    base = base.select(*kept, "mix_tokens", likely.alias(likely_of))
    total = F.aggregate(likely_of, F.lit(0.0), lambda s, x: s + x)
    return base.select(*kept, "mix_tokens", F.transform(likely_of, lambda x: x / total).alias("mix_posteriors"))


def fit(held: DataFrame, model: DomainModel, targets: dict[str, float], budget: float | None = None, lose_none: bool = False, close: float = 1e-4) -> RateModel:
    """Rates for docs with posteriors. targets: weight of each domain, at least 0, one above 0; a domain not named has 0, and
    a name that the model doesn't know is refused. budget: expected tokens of the mixture, by default those of docs.
    lose_none: no rate is below 1, and without a budget the mixture is as large as its shares then need.
    Ends when every domain is within `close` of its own target (of all tokens where that is 0), or warns of the residuals
    when no rates come closer. Without tokens every rate stays 1.
    """
    unknown = [d for d, w in targets.items() if d not in model.domains and w > 0]
    weights = [max(0.0, float(targets.get(d, 0.0))) for d in model.domains]
    if unknown or not sum(weights):
        raise ValueError(f"no such domain: {unknown}" if unknown else "no weight above 0")
    share = np.array(weights) / sum(weights)
    k, least = len(model.domains), 1.0 if lose_none else 0.0
    free = lose_none and budget is None
    rows = held.select(F.col("mix_tokens").cast("double").alias("t"), F.col("mix_posteriors").alias("p")).filter("t > 0")
    every = rows.agg(F.sum("t")).first()[0]
    if not every:
        return RateModel([], [], least)
    # with a free budget, each domain's tokens less its share of all shall be 0
    shift = share if free else np.zeros(k)
    goal = np.zeros(k) if free else share * (budget or every) / every
    p = [F.get("p", F.lit(d)) for d in range(k)]
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    whole = rows.select("t", "p", F.lit(1.0).alias("rate"))

    def descend(plain: bool) -> tuple[float, np.ndarray, list[list[float]]]:
        """The smallest largest residual, all residuals there, and the steps to it."""
        state, done, steps, best, worst, pace = whole, 0, [], None, [], 0.0

        def at_now() -> DataFrame:
            rate = rates(F.col("p"), steps[done:], [0.0] * (len(steps) - done), least, (F.col("rate"), F.col("rate")))[0]
            return state.select("t", "p", rate.alias("rate"))

        while True:
            if len(steps) - done == STORE:
                older, state, done = state, stored(at_now(), "rates"), len(steps)
                if older is not whole:
                    discard(older)
            loose = F.when((F.col("rate") > least) | F.lit(not steps), F.col("t")).otherwise(0.0)
            q = [x - F.lit(float(y)) for x, y in zip(p, shift, strict=True)]
            found = at_now().agg(*(F.sum(F.col("t") * F.col("rate") * x) for x in p), *(F.sum(loose * q[i] * q[j]) for i, j in pairs)).first()
            found = np.array(list(found), float) / every
            left = found[:k] - shift * found[:k].sum() - goal
            cover = np.zeros((k, k))
            for (i, j), x in zip(pairs, found[k:], strict=True):
                cover[i, j] = cover[j, i] = x
            aim = share * (found[:k].sum() if free else goal.sum())
            residual = left / np.where(aim > 0, aim, max(aim.sum(), 1e-300))
            worst.append(float(np.abs(residual).max()))
            if best is None or worst[-1] < best[0]:
                best = worst[-1], residual, steps[:]
            if worst[-1] <= close or not cover.any() or len(worst) > REST and best[0] > 0.75 * min(worst[:-REST]):
                return best
            pace = pace or 1 / max(float(np.linalg.eigvalsh(cover).max()), 1e-300)
            pull = pace * left if plain else np.linalg.solve(cover + 1e-9 * np.trace(cover) * np.eye(k), left)
            # posteriors add up to 1, so what a share takes off is the same for all domains
            steps.append((pull - pull @ shift).tolist())

    largest, residual, steps = descend(plain=False)
    if largest > close:
        largest, residual, steps = descend(plain=True)
    residuals = dict(zip(model.domains, residual.tolist(), strict=True))
    if largest > close:
        warnings.warn(f"no rates reach the targets; residuals: {residuals}", stacklevel=2)
    return RateModel(steps, [0.0] * len(steps), least, residuals)


def rates(
    posteriors: Column, steps: list[list[float]], momentum: list[float], least: float = 0.0, begin: tuple[Column, Column] | None = None
) -> tuple[Column, Column]:
    """The rate after the steps, and the point ahead of it where the next residual is taken; both begin at 1 unless given."""
    begin = begin or (F.lit(1.0), F.lit(1.0))
    if not steps:
        return begin
    moves = F.lit([[*s, m] for s, m in zip(steps, momentum, strict=True)])
    k = len(steps[0])
    start = F.struct(begin[0].alias("rate"), begin[1].alias("ahead"))

    def step(s: Column, e: Column) -> Column:
        pull = sum((F.get(posteriors, F.lit(d)) * F.get(e, F.lit(d)) for d in range(k)), F.lit(0.0))
        new = F.greatest(F.lit(least), s["ahead"] - pull)
        # the point ahead may leave the allowed range, the rate never does
        return F.struct(new.alias("rate"), (new + F.get(e, F.lit(k)) * (new - s["rate"])).alias("ahead"))

    done = F.aggregate(F.lit(moves), start, step)
    return done["rate"], done["ahead"]


def apply_rates(held: DataFrame, model: RateModel, key: str = "doc_id") -> DataFrame:
    """Rows with mix_rate, and mix_copies: the rate rounded up or down by the hash of key and tokens, right on average."""
    rate = rates(F.col("mix_posteriors"), model.steps, model.momentum, model.least)[0]
    held = held.withColumn("mix_rate", rate)
    draw = F.xxhash64(F.lit("copies"), F.col(f"`{key}`"), F.col("mix_tokens")).bitwiseAND(F.lit((1 << 30) - 1)) / F.lit(float(1 << 30))
    whole = F.floor("mix_rate")
    return held.withColumn("mix_copies", (whole + F.when(draw < F.col("mix_rate") - whole, 1).otherwise(0)).cast("long"))


def mix(docs: DataFrame, labelled: DataFrame, targets: dict[str, float], text: str = "text", key: str = "doc_id", budget: float | None = None, lose_none: bool = False) -> tuple[DataFrame, DomainModel]:
    """docs with mix_tokens, mix_posteriors, mix_rate and mix_copies, and the model that names the domains. Targets for
    domains that no labelled document has are left out; if none is left, all domains weigh the same."""
    model = train(docs, labelled, text, key)
    targets = {d: w for d, w in targets.items() if d in model.domains}
    targets = targets if sum(targets.values()) > 0 else dict.fromkeys(model.domains, 1.0)
    told = with_posteriors(docs, model, text)
    # the fit reads tokens and posteriors only; the documents get theirs again, so that no text is stored
    held = stored(told.select("mix_tokens", "mix_posteriors"), "posteriors")
    return apply_rates(told, fit(held, model, targets, budget, lose_none), key), model
