"""Hidden Markov language model: Baum-Welch counts summed across partitions, sequence likelihood by the scaled forward recursion.

1. Each task turns its texts into slices of about `SLICE_BYTES`: ids into the slice's own sorted list of distinct words, and the training counts of
   these. Words are 64-bit hashes. Ranges of the hash are buckets of about `ENTRIES` slice words. A bucket holds the words
   that fall into it with exact counts, without a cap, and where each slice has them. It is a table, not a driver object.
   Slices and buckets are stored as they are dealt, so that a pass shuffles ratios and sums but neither texts nor buckets.
2. Base: p(w) = (c + 0.5) / (N + 0.5 (V + 1)). The model's emission is the base times a ratio per state. Every word of the
   training texts has ratios of its own. Every unseen word is the same word; when scoring, a state gives it the weight of
   its words that occur once, which comes off all others.
3. A pass of Baum-Welch sends each slice the ratios of its words from the buckets, runs the scaled forward and backward
   recursions over all its training texts, those of like length side by side, and sums the expected counts by word in the buckets. Each pass
   sees all training texts. Passes end when the log-likelihood of these rises by `CLOSE` or less per token.
4. Scoring runs the forward recursion on every text. The log10 probability is the base score plus the logs of the scales.

The parameters on the driver are those of the states: transitions, first states, totals. Tables of a pass are removed after the next.
"""

from __future__ import annotations

import gc
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from watchspan.llm.common import discard, flat, laid, mix, slices, stored, word_hashes

STATES, PRIOR, CLOSE = 6, 0.02, 1e-3
END = np.uint64(0x656E64656E64656E)
SLICE_BYTES, ENTRIES, BLOCK = 16 << 20, 1 << 17, 1 << 19
RESCALE = 16  # places; PRIOR keeps ratios between PRIOR / STATES and its inverse, about, so that products stay far from the limits of a double
_SLICES = (
    "slice long, doc_ids array<long>, held array<boolean>, lengths array<long>, n_words long, learned binary, others binary, trained binary, words binary, train binary"
)


def _encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    number = TaskContext.get().partitionId() << 32
    parts, size = [], 0
    for batch in slices(batches, most=1 << 20):  # hashing needs some 50 bytes for each of text
        data, offsets = flat(batch.column("text"))
        if parts and size + len(data) > SLICE_BYTES:
            yield _slice(number, parts)
            number, parts, size = number + 1, [], 0
        words, firsts = word_hashes(data, offsets)
        # one end behind each text's words
        parts.append((np.insert(words, firsts[1:], END), np.diff(firsts) + 1, np.array(batch.column("held")), batch.column("doc_id").to_pylist()))
        size += len(data)
    if parts:
        yield _slice(number, parts)


def _slice(number: int, parts: list[tuple[np.ndarray, np.ndarray, np.ndarray, list]]) -> pa.RecordBatch:
    """One row: which of its words the training texts have, as bits; the training texts as ids into these words (`learned`) and the
    others as ids into all of them, both in the order in which _blocks takes them."""
    words, lengths, held = (np.concatenate([p[i] for p in parts]) for i in range(3))
    names, ids = np.unique(words, return_inverse=True)
    out = np.repeat(held, lengths)
    train = np.bincount(ids[~out], minlength=len(names))
    trained, kind = train > 0, _kind(len(names))
    learned = (np.cumsum(trained) - 1)[ids[~out]].astype(kind)
    row = {
        "slice": number, "doc_ids": [x for p in parts for x in p[3]], "held": held.tolist(), "lengths": lengths.tolist(), "n_words": len(names),
        "learned": _ordered(learned, lengths[~held]), "others": _ordered(ids[out].astype(kind), lengths[held]),
        "trained": np.packbits(trained).tobytes(), "words": names.tobytes(), "train": train.astype(np.int64).tobytes(),
    }
    kinds = {"doc_ids": pa.list_(pa.int64()), "held": pa.list_(pa.bool_()), "lengths": pa.list_(pa.int64()), "slice": pa.int64(), "n_words": pa.int64()}
    return pa.RecordBatch.from_arrays([pa.array([x], kinds.get(c, pa.binary())) for c, x in row.items()], list(row))


def _ordered(tokens: np.ndarray, lengths: np.ndarray) -> bytes:
    return b"".join(packed.tokens.astype(tokens.dtype).tobytes() for _, packed in _blocks(tokens, lengths))


def _kind(n: int) -> type:
    return np.uint16 if n <= 1 << 16 else np.uint32


def _dealt(buckets: int):
    """A slice's words by bucket: ranges of the hash, so that the buckets' parts end to end are in the slice's order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, words, train in zip(*(batch.column(c).to_pylist() for c in ("slice", "words", "train")), strict=True):
                words, train = np.frombuffer(words, np.uint64), np.frombuffer(train, np.int64)
                bucket = ((words >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)
                at = np.flatnonzero(np.diff(bucket, prepend=-1))
                parts = list(zip(at.tolist(), [*at[1:].tolist(), len(words)]))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(bucket[at]), pa.array(np.full(len(at), number, np.int64)),
                        pa.array([words[a:b].tobytes() for a, b in parts], pa.binary()), pa.array([train[a:b].tobytes() for a, b in parts], pa.binary()),
                    ],
                    ["bucket", "slice", "words", "train"],
                )

    return run


_BUCKETS = "bucket long, words binary, counts binary, slices array<long>, ends array<long>, ids binary, trained binary, v long, n long, once long"


def _merged(group: pa.Table) -> pa.Table:
    """One row for a bucket: its distinct words, their training counts, the places of each slice's words among them, and as bits
    which of these the slice's training texts have."""
    parts = [np.frombuffer(x, np.uint64) for x in group.column("words").to_pylist()]
    words, ids = np.unique(np.concatenate(parts), return_inverse=True)
    counts = np.zeros(len(words), np.int64)
    train = np.concatenate([np.frombuffer(x, np.int64) for x in group.column("train").to_pylist()])
    np.add.at(counts, ids, train)
    row = {
        "bucket": group.column("bucket")[0].as_py(), "words": words.tobytes(), "counts": counts.tobytes(), "slices": group.column("slice").to_pylist(),
        "ends": np.cumsum([len(x) for x in parts]).tolist(), "ids": ids.astype(np.uint32).tobytes(), "trained": np.packbits(train > 0).tobytes(),
        "v": int((counts > 0).sum()), "n": int(counts.sum()), "once": int((counts == 1).sum()),
    }
    return pa.table({k: [x] for k, x in row.items()})


class Room:
    """Numbers that each block needs again, so that their memory is asked for once. Blocks that take turns may share a room."""

    def __init__(self):
        self.held: dict[str, np.ndarray] = {}

    def __call__(self, name: str, *shape: int) -> np.ndarray:
        size = shape[0] * shape[1]
        if name not in self.held or self.held[name].size < size:
            self.held[name] = np.empty(size)
        return self.held[name][:size].reshape(shape)


class Packed:
    """Texts side by side: tokens in the order of their place, longest text first, so that a place's numbers lie together."""

    def __init__(self, tokens: np.ndarray, lengths: np.ndarray, ordered: bool = False, room: Room | None = None):
        self.room = room or Room()
        self.order = np.argsort(-lengths, kind="stable")
        sizes, starts = lengths[self.order], (np.cumsum(lengths) - lengths)[self.order]
        places = np.arange(sizes[0] if len(sizes) else 0)
        self.width = len(sizes) - np.searchsorted(sizes[::-1], places, "right")
        edges = np.concatenate([[0], np.cumsum(self.width)])
        self.edges = edges.tolist()  # where each place begins
        self.last = edges[sizes - 1] + np.arange(len(sizes))  # where each text ends
        tokens = tokens if ordered else tokens[starts[self.text] + np.repeat(places, self.width)]
        self.tokens = tokens.astype(np.int64, copy=False)

    @property
    def text(self) -> np.ndarray:
        """Of each token, the rank of its text."""
        return np.arange(self.edges[-1]) - np.repeat(self.edges[:-1], self.width)

    def forward(self, ratio: np.ndarray, first: np.ndarray, moves: np.ndarray, keep: bool) -> tuple[np.ndarray, np.ndarray | None]:
        """Scales of all tokens, and their forward shares by state. Shares are scaled to one at each `RESCALE`th place and at each
        text's end; the scale of other tokens is one."""
        shape = len(self.tokens), len(first)
        self.met = met = ratio.take(self.tokens, axis=0, out=self.room("met", *shape), mode="clip")
        scale, ones, ends = np.ones(len(met)), np.ones(len(first)), np.ones(len(self.last))
        shares = self.room("shares", *shape) if keep else None
        a, room = None, np.empty((len(ends), len(first)))
        for place, (lo, hi) in enumerate(zip(self.edges, self.edges[1:])):
            if a is not None and not keep and hi - lo < len(a):
                ends[hi - lo : len(a)] = a[hi - lo :] @ ones
            come = first if a is None else np.matmul(a[: hi - lo], moves, out=room[: hi - lo])
            a = np.multiply(come, met[lo:hi], out=shares[lo:hi] if keep else None)
            if place % RESCALE == RESCALE - 1:
                np.matmul(a, ones, out=scale[lo:hi])
                a /= scale[lo:hi, None]
        if keep:
            ends = shares[self.last] @ ones
            shares[self.last] /= ends[:, None]
        elif a is not None:
            ends[: len(a)] = a @ ones
        scale[self.last] *= ends
        return scale, shares

    def expected(self, ratio: np.ndarray, first: np.ndarray, moves: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """State shares of each token, expected moves, and expected first states; `gain` becomes the sum of the scales' logs."""
        scale, shares = self.forward(ratio, first, moves, True)
        self.gain = float(np.log(scale[scale != 1]).sum())
        after, edges = self.met, self.edges  # becomes what a token and all behind it say to the one before
        after[self.last] /= scale[self.last, None]
        scale[self.last] = 1
        back, room = np.ascontiguousarray(moves.T), np.empty((len(self.last), len(first)))
        known = top = 0
        for place in range(len(edges) - 2, -1, -1):
            lo, hi = edges[place], edges[place + 1]
            if known:
                after[lo : lo + known] *= np.matmul(after[hi:top], back, out=room[:known])
            if place % RESCALE == RESCALE - 1:
                after[lo:hi] /= scale[lo:hi, None]
            known, top = hi - lo, hi
        # what comes from the token before, times `after`, is a token's share given the whole text
        begun = edges[1] if len(edges) > 1 else 0
        gamma, moved, width = self.room("gamma", len(first), len(after)), np.zeros(moves.shape), self.width
        gamma[:, :begun] = (first * after[:begun]).T
        before = np.arange(begun, len(after)) - np.repeat(width[:-1], width[1:])
        for lo in range(begun, len(after), 1 << 13):
            said = after[lo : lo + (1 << 13)]
            come = shares.take(before[lo - begun : lo - begun + len(said)], axis=0)
            moved += come.T @ said
            gamma[:, lo : lo + len(said)] = (come @ moves * said).T
        return gamma.T, moves * moved, gamma[:, :begun].sum(axis=1)


def _blocks(tokens: np.ndarray, lengths: np.ndarray, ordered: bool = False) -> Iterator[tuple[np.ndarray, Packed]]:
    """All texts, those of like length side by side, about `BLOCK` tokens at a time; with each block the numbers of its texts. The tokens
    may be `ordered` as the blocks of an earlier call held them, end to end. What a block has worked out holds until the next one works."""
    order, starts = np.argsort(-lengths, kind="stable"), np.cumsum(lengths) - lengths
    ends = np.cumsum(lengths[order])
    lo, room = 0, Room()
    while lo < len(order):
        met = ends[lo - 1] if lo else 0
        hi = max(lo + 1, int(np.searchsorted(ends, met + BLOCK, "right")))
        mine = order[lo:hi]
        sizes = lengths[mine]
        if ordered:
            yield mine, Packed(tokens[met : ends[hi - 1]], sizes, True, room)
        else:
            at = np.repeat(starts[mine] - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
            yield mine, Packed(tokens[at], sizes, False, room)
        lo = hi


def _drawn(words: np.ndarray) -> np.ndarray:
    """First ratios of the states: between a half and one and a half, by the word's hash."""
    spread = [(mix(words ^ np.uint64(k + 1)) >> np.uint64(11)).astype(np.float64) / (1 << 53) for k in range(STATES)]
    return np.stack(spread, axis=1) + 0.5


def _ratios(counts: np.ndarray, sums: np.ndarray, state: dict, last: bool) -> np.ndarray:
    """Ratio of a bucket's words to the base, by state; unseen words only matter when scoring."""
    base = (counts + 0.5) / state["unit"]
    ratio = (sums / base[:, None] + state["prior"]) / (state["totals"] + state["prior"]) * state["scored" if last else "kept"]
    ratio[counts == 0] = state["unseen"] if last else 1.0
    return ratio


def _places(row: dict, trained: bool) -> list[tuple[int, np.ndarray]]:
    """By slice, the places of its words among those of a bucket; `trained`: of the words that its training texts have."""
    ids, ends = np.frombuffer(row["ids"], np.uint32), row["ends"]
    if trained:
        have = np.unpackbits(np.frombuffer(row["trained"], np.uint8), count=len(ids)).astype(bool)
        ids, ends = ids[have], np.concatenate([[0], np.cumsum(have)])[ends].tolist()
    return [(number, ids[a:b]) for number, a, b in zip(row["slices"], [0, *ends], ends)]


def _sent(state: dict | None, last: bool):
    """(slice, bucket, ratio, counts): what each slice needs to know of its words in each bucket; in training, of those that its
    training texts have; counts for scoring only."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                counts = np.frombuffer(row["counts"], np.int64)
                if state is not None:
                    ratio = _ratios(counts, np.frombuffer(row["sums"], np.float32).reshape(-1, STATES), state, last)
                else:
                    ratio = np.ones((len(counts), STATES)) if last else _drawn(np.frombuffer(row["words"], np.uint64))
                ratio, places = ratio.astype(np.float32), _places(row, not last)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([number for number, _ in places]), pa.array([row["bucket"]] * len(places)),
                        pa.array([ratio[at].tobytes() for _, at in places], pa.binary()), pa.array([counts[at].tobytes() if last else None for _, at in places], pa.binary()),
                    ],
                    ["slice", "bucket", "ratio", "counts"],
                )

    return run


_SENT = "slice long, bucket long, ratio binary, counts binary"


def _received(sent: pa.Table) -> tuple[list[int], list[int], np.ndarray, pa.Table]:
    """Buckets in order, the number of a slice's words in each, the ratios of these words, and the sorted rows."""
    sent = sent.sort_by("bucket")
    parts = [np.frombuffer(x, np.float32).reshape(-1, STATES) for x in sent.column("ratio").to_pylist()]
    return sent.column("bucket").to_pylist(), [len(x) for x in parts], np.concatenate(parts).astype(np.float64), sent


def _texts(cut: pa.Table, which: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Tokens of the training texts (`learned`) or of the `others`, the numbers of these texts, and their lengths."""
    row = {c: cut.column(c)[0] for c in (which, "lengths", "held", "n_words")}
    mine = np.flatnonzero(np.array(row["held"].values) == (which == "others"))
    return np.frombuffer(row[which].as_py(), _kind(row["n_words"].as_py())), mine, np.array(row["lengths"].values)[mine]


def _sticky() -> np.ndarray:
    return np.full((STATES, STATES), 0.01 / (STATES - 1)) + np.eye(STATES) * (0.99 - 0.01 / (STATES - 1))


def _expect(state: dict | None):
    """(bucket, slice, sums, states): expected counts of a slice's words by bucket, with those of the states on its first row:
    log-likelihood beside the base, first states, transitions."""
    moves = state["moves"] if state else _sticky()
    first = state["first"] if state else np.full(STATES, 1 / STATES)

    def run(cut: pa.Table, sent: pa.Table) -> pa.Table:
        buckets, sizes, ratio, _ = _received(sent)
        tokens, _, lengths = _texts(cut, "learned")
        sums, states = np.zeros((STATES, len(ratio))), np.zeros(1 + STATES + STATES * STATES)
        for _, packed in _blocks(tokens, lengths, True):
            gamma, moved, begun = packed.expected(ratio, first, moves)
            for k in range(STATES):
                sums[k] += np.bincount(packed.tokens, gamma[:, k], len(ratio))
            states += np.concatenate([[packed.gain], begun, moved.ravel()])
        ends, sums = np.cumsum(sizes).tolist(), sums.T.astype(np.float32, order="C")
        raw = [sums[a:b].tobytes() for a, b in zip([0, *ends], ends)]
        number = cut.column("slice")[0].as_py()
        return pa.table({
            "bucket": pa.array(buckets, pa.int64()), "slice": pa.array([number] * len(buckets), pa.int64()), "sums": pa.array(raw, pa.binary()),
            "states": pa.array([states.tolist(), *[None] * (len(buckets) - 1)], pa.list_(pa.float64())),
        })

    return run


def _summed(bucket: pa.Table, parts: pa.Table) -> pa.Table:
    """A bucket with the expected counts of its words over all slices, and with the sums over these and over the states' rows:
    totals by state, totals of words that occur once, then those of _expect."""
    row = {c: bucket.column(c)[0].as_py() for c in ("bucket", "counts", "slices", "ends", "ids", "trained")}
    counts, places = np.frombuffer(row["counts"], np.int64), dict(_places(row, True))
    sums, states = np.zeros((len(counts), STATES)), np.zeros(1 + STATES + STATES * STATES)
    for number, raw, own in zip(*(parts.column(c).to_pylist() for c in ("slice", "sums", "states")), strict=True):
        sums[places[number]] += np.frombuffer(raw, np.float32).reshape(-1, STATES)  # a slice has each word once
        if own is not None:
            states += own
    row["sums"] = sums.astype(np.float32).tobytes()
    row["states"] = np.concatenate([sums.sum(axis=0), sums[counts == 1].sum(axis=0), states]).tolist()
    return pa.table({k: [x] for k, x in row.items()})


_SUMMED = "bucket long, counts binary, slices array<long>, ends array<long>, ids binary, trained binary, sums binary, states array<double>"


def _maximised(expected: DataFrame, n: int, v: int, once: int) -> tuple[dict, float]:
    """The states' parameters from expected counts, and the log-likelihood beside the base that the pass has met."""
    rows = expected.select(F.posexplode("states").alias("i", "x")).groupBy("i").agg(F.sum("x").alias("x")).collect()
    x = np.array([r.x for r in sorted(rows, key=lambda r: r.i)])
    totals, rare, gain, first, moves = np.split(x, np.cumsum([STATES, STATES, 1, STATES]))
    prior = PRIOR * totals.sum() / STATES
    unit = n + 0.5 * (v + 1)
    unseen = np.clip((rare + prior * once * 1.5 / unit) / (totals + prior), 0.5 / unit, 0.5)
    # the base's unseen word is part of the prior's mass; what a state's words keep adds up to one, when scoring with the unseen word
    kept = 1 / (1 - prior * 0.5 / unit / (totals + prior))
    moves, first = moves.reshape(STATES, STATES) + _sticky(), first + 1 / STATES
    state = {
        "moves": moves / moves.sum(axis=1, keepdims=True), "first": first / first.sum(), "totals": totals, "prior": prior, "unit": unit,
        "kept": kept, "scored": kept * (1 - unseen), "unseen": unseen * unit / 0.5,
    }
    return state, float(gain[0])


def _score(state: dict | None, n: int, v: int):
    low = np.log10(n + 0.5 * (v + 1))
    first = state["first"] if state else np.full(STATES, 1 / STATES)
    moves = state["moves"] if state else _sticky()

    def run(cut: pa.Table, sent: pa.Table) -> pa.Table:
        _, _, ratio, sent = _received(sent)
        counts = np.concatenate([np.frombuffer(x, np.int64) for x in sent.column("counts").to_pylist()])
        weights, found = np.log10(counts + 0.5) - low, counts > 0
        trained = np.unpackbits(np.frombuffer(cut.column("trained")[0].as_py(), np.uint8), count=len(counts))
        held, lengths = (np.array(cut.column(c)[0].values) for c in ("held", "lengths"))
        base, gain, known = np.empty(len(held)), np.empty(len(held)), np.empty(len(held), np.int64)
        for which, places in (("learned", np.flatnonzero(trained)), ("others", None)):
            tokens, texts, sizes = _texts(cut, which)
            for mine, packed in _blocks(tokens if places is None else places[tokens], sizes, True):
                at, text = texts[mine[packed.order]], packed.text
                base[at], known[at] = (np.bincount(text, x[packed.tokens], len(at)) for x in (weights, found))
                scale, _ = packed.forward(ratio, first, moves, False)
                gain[at] = np.bincount(text, np.log10(scale), len(at))
        ids = pa.array(cut.column("doc_ids")[0].as_py(), pa.int64())
        return pa.table({
            "doc_id": ids, "held_out": pa.array(held), "n_tokens": pa.array(lengths), "n_known": pa.array(known),
            "train_tokens": pa.array(np.full(len(lengths), n, np.int64)), "base_score": pa.array(base), "score": pa.array(base + gain),
        })

    return run


def score(docs: DataFrame, held: Column, text: str = "text", key: str = "doc_id") -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score for every row of docs, learned from the rows
    where `held` is not true. Tokens are the words (A-Z lower-cased, cut at white space) and one end per text.

    Null and empty texts are the end alone. Repeated rows count as often as they occur. Without training rows every token is
    unseen and the score is the base score. Other columns are ignored.
    """
    held = F.coalesce(held, F.lit(False))
    rows = docs.select(F.col(f"`{key}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"), held.alias("held"))
    spark = docs.sparkSession
    whole = stored(rows.mapInArrow(_encode, _SLICES), "slices")
    n_slices, n_words = whole.agg(F.count("slice"), F.sum("n_words")).first()
    buckets = -(-(n_words or 1) // ENTRIES)
    cut = laid(whole.drop("words", "train"), "slices", "slice", _parts(n_slices))
    dealt = whole.select("slice", "words", "train").mapInArrow(_dealt(buckets), "bucket long, slice long, words binary, train binary")
    table = laid(dealt.groupBy("bucket").applyInArrow(_merged, _BUCKETS), "buckets", "bucket", _parts(buckets))
    discard(whole)
    del dealt, whole
    _let_go(spark)
    v, n, once = (x or 0 for x in table.agg(F.sum("v"), F.sum("n"), F.sum("once")).first())
    learned, shared = cut.select("slice", "held", "lengths", "n_words", "learned"), table.drop("words", "v", "n", "once")
    state, expected, before = None, None, -np.inf
    while n:
        sent = (table if expected is None else expected).mapInArrow(_sent(state, False), _SENT)
        parts = _by_slice(learned, sent, _expect(state), "bucket long, slice long, sums binary, states array<double>")
        fresh = stored(shared.groupBy("bucket").cogroup(parts.groupBy("bucket")).applyInArrow(_summed, _SUMMED), "expected")
        if expected is not None:
            discard(expected)
        expected, (state, gain) = fresh, _maximised(fresh, n, v, once)
        del sent, parts, fresh
        _let_go(spark)
        if gain - before <= CLOSE * n:
            break
        before = gain
    sent = (table if expected is None else expected).mapInArrow(_sent(state, True), _SENT)
    found = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return _by_slice(cut, sent, _score(state, n, v), found)


def _parts(rows: int) -> int:
    """Parts for rows that are dealt by a hash: twice as many, so that few parts get several rows."""
    return min(max(2 * rows, 1), 2000)


def _let_go(spark: SparkSession) -> None:
    """Shuffle files go when nothing on the driver refers to them."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def _by_slice(cut: DataFrame, sent: DataFrame, run, schema: str) -> DataFrame:
    return cut.groupBy("slice").cogroup(sent.groupBy("slice")).applyInArrow(run, schema)
