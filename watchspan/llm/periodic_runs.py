"""Stretches of words that repeat with a short period, found on an enhanced suffix array.

A square is a stretch of words followed by itself. In the suffix array of the words, the places where one string of d words
occurs and is followed by different words are the children of an LCP interval of value d. A square of period d whose
repetition ends right behind it starts at a place i with i and i + d in two children of that interval. One of the two is not
in the largest child, so it is enough to go through the suffixes of the smaller children and to look up in the inverse suffix
array whether i + d or i - d lies in the interval: O(n log n) look-ups, no tree nodes. Rotating such a square to the left as far
as words repeat gives the run it belongs to; squares of one run with periods that are multiples are merged.

Texts are handled as Arrow slices: all texts of a slice share one array. Words are numbered text by text, so that nothing is
compared across texts. A run of four periods holds each of its words four times, so a word that its text holds less often
ends a stretch, and only stretches of six words or more get into the array.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from watchspan.llm.common import slices

LEAST_WORDS, LEAST_PERIODS = 6, 4  # a run has at least six words and four periods
_PAIRS = 1 << 20


def suffix_array(values: np.ndarray) -> np.ndarray:
    """Suffixes of an integer array in order, by prefix doubling; only suffixes that still tie are sorted again."""
    n = len(values)
    if not n:
        return np.zeros(0, np.int64)
    order = np.argsort(values, kind="stable")
    head = np.ones(n, bool)
    head[1:] = values[order[1:]] != values[order[:-1]]
    rank = np.empty(n + 1, np.int64)
    rank[n] = -1
    rank[order] = np.maximum.accumulate(np.where(head, np.arange(n), 0))
    width = 1
    while True:
        tied = np.flatnonzero(~(head & np.append(head[1:], True)))
        if not len(tied):
            return order
        at = order[tied]
        first, then = rank[at], rank[np.minimum(at + width, n)]
        again = np.lexsort((then, first))
        at, first, then = at[again], first[again], then[again]
        order[tied] = at
        new = np.ones(len(at), bool)
        new[1:] = (first[1:] != first[:-1]) | (then[1:] != then[:-1])
        head[tied] = new
        rank[at] = tied[np.maximum.accumulate(np.where(new, np.arange(len(at)), 0))]
        width *= 2


def common_prefixes(values: np.ndarray, order: np.ndarray, place: np.ndarray) -> list[int]:
    """How many values each suffix shares with the one before it in order (0 for the first)."""
    text, sa, isa = values.tolist(), order.tolist(), place.tolist()
    n, h = len(text), 0
    shared = [0] * n
    for i in range(n):
        r = isa[i]
        if not r:
            h = 0
            continue
        j = sa[r - 1]
        most = n - max(i, j)
        while h < most and text[i + h] == text[j + h]:
            h += 1
        shared[r] = h
        if h:
            h -= 1
    return shared


def intervals(shared: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For every border k: the last border before it with a smaller value, the first after it with one not larger, and with a smaller one.

    Border k lies between suffixes k - 1 and k. Borders of one interval are split from left to right, so two suffixes in
    different children are parted at one border only.
    """
    n = len(shared)
    before, upto, after = [0] * n, [n] * n, [n] * n
    open_: list[int] = []  # borders whose interval is still open; values never fall
    for k in range(1, n):
        v = shared[k]
        while open_ and shared[open_[-1]] > v:
            top = open_.pop()
            after[top] = k
            upto[top] = min(upto[top], k)
        if open_ and shared[open_[-1]] == v:
            upto[open_[-1]] = k
            before[k] = before[open_[-1]]
        elif open_:
            before[k] = open_[-1]
        open_.append(k)
    return np.array(before), np.array(upto), np.array(after)


def _blocks(sizes: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    ends = np.cumsum(sizes)
    first = 0
    while first < len(sizes):
        start = ends[first] - sizes[first]
        last = max(int(np.searchsorted(ends, start + most, "right")), first + 1)
        yield first, last
        first = last


def branching_squares(values: np.ndarray, periods: int = 2) -> tuple[np.ndarray, np.ndarray]:
    """(start, period) of squares whose repetition ends right behind them and that `periods` - 2 equal periods precede.

    The last value must be different from all others.
    """
    order = suffix_array(values)
    n = len(order)
    place = np.empty(n, np.int64)
    place[order] = np.arange(n)
    shared = common_prefixes(values, order, place)
    before, upto, after = intervals(shared)
    depth = np.array(shared, np.int64)
    borders = np.flatnonzero((depth > 0) & (depth * periods <= n))
    depth, low, high, end = depth[borders], before[borders], upto[borders], after[borders]
    small_left = borders - low <= high - borders
    begin = np.where(small_left, low, borders)
    size = np.where(small_left, borders - low, high - borders)
    other_low, other_high = np.where(small_left, borders, low), np.where(small_left, high, borders)
    starts, widths = [], []
    for a, b in _blocks(size, _PAIRS):
        which = np.repeat(np.arange(a, b), size[a:b])
        inside = np.arange(len(which)) - np.repeat(np.cumsum(size[a:b]) - size[a:b], size[a:b])
        at, d = order[begin[which] + inside], depth[which]
        for left in (at, at - d):
            partner = left + d if left is at else left
            ok = (partner >= 0) & (partner < n)
            spot = place[np.where(ok, partner, 0)]
            ok &= (spot >= other_low[which]) & (spot < other_high[which])
            for back in range(1, periods - 1):  # the periods before the square lie in the same interval
                spot = place[np.maximum(left - back * d, 0)]
                ok &= (left - back * d >= 0) & (spot >= low[which]) & (spot < end[which])
            starts.append(left[ok])
            widths.append(d[ok])
    none = np.zeros(0, np.int64)
    return (np.concatenate(starts), np.concatenate(widths)) if starts else (none, none)


def runs_of(values: np.ndarray, least_words: int = LEAST_WORDS, least_periods: int = LEAST_PERIODS) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs, by start and period. The last value must be different from all others."""
    found: dict[tuple[int, int], int] = {}
    for i, d in zip(*(x.tolist() for x in branching_squares(values, least_periods)), strict=True):
        stop = i + 2 * d
        start, step = i - (least_periods - 2) * d, 4 * d
        while start:  # rotate to the left, in growing steps
            reach = min(step, start)
            differ = np.flatnonzero(values[start - reach : start] != values[start - reach + d : start + d])
            if len(differ):
                start += int(differ[-1]) + 1 - reach
                break
            start, step = start - reach, 2 * step
        if stop - start >= max(least_words, least_periods * d):
            found[start, stop] = min(found.get((start, stop), d), d)
    return sorted((a, b - a, d) for (a, b), d in found.items())


def runs_of_texts(texts: list[list], least_words: int = LEAST_WORDS, least_periods: int = LEAST_PERIODS) -> list[list[tuple[int, int, int]]]:
    """The runs of each list of words, all lists in one suffix array."""
    parts, where = [], []  # stretches of word numbers, each with a number of its own behind it
    used = 0
    for t, words in enumerate(texts):
        counts = Counter(words)
        often = {w: used + k for k, w in enumerate(w for w, c in counts.items() if c >= least_periods)}
        if not often:
            continue
        used += len(often)
        numbers = np.array([often.get(w, -1) for w in words], np.int64)
        held = np.flatnonzero(np.diff(np.concatenate(([False], numbers >= 0, [False])).astype(np.int8)))
        for a, b in held.reshape(-1, 2).tolist():
            if b - a >= least_words:
                parts.append(numbers[a:b])
                where.append((t, a, b - a))
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    if not parts:
        return out
    ends = np.cumsum([len(p) + 1 for p in parts])
    values = np.empty(int(ends[-1]), np.int64)
    values[ends - 1] = used + np.arange(len(parts))
    keep = np.ones(len(values), bool)
    keep[ends - 1] = False
    values[keep] = np.concatenate(parts)
    for start, length, period in runs_of(values, least_words, least_periods):
        k = int(np.searchsorted(ends, start, "right"))
        t, first, size = where[k]
        out[t].append((first + start - int(ends[k] - size - 1), length, period))
    return out


def collapse(words: list, runs: list[tuple[int, int, int]]) -> list:
    """The words without those that any run holds after its first period."""
    if not runs:
        return words
    stay = np.ones(len(words), bool)
    for start, length, period in runs:
        stay[start + period : start + length] = False
    return [words[i] for i in np.flatnonzero(stay).tolist()]


def planted(key: int | None, words: list) -> list:
    """The words of a test text: every tenth key, by its crc32, repeats a stretch of its words up to the end."""
    h = zlib.crc32(b"" if key is None else str(key).encode())
    n = len(words)
    if h % 10 or not n:
        return words
    a = h // 10 % n
    p = 1 + (n - a) // (3 + h // 10 % 8)
    head = words[a : a + p]
    return words[:a] + (head * ((n - a) // p + 1))[: n - a]


def find_runs(
    docs: DataFrame, key: str = "doc_id", text: str = "text", least_words: int = LEAST_WORDS, least_periods: int = LEAST_PERIODS,
    change: Callable[[object, list], list] | None = None,
) -> DataFrame:
    """One row per row of docs: the key, `runs` (start, length, period by start, period) and `collapsed`.

    Words are stretches without ASCII white space, numbered from 0 and compared as they are. A run is a stretch with smallest
    period q and at least max(least_words, least_periods * q) words, that no neighbouring word extends. `collapsed` has the
    words outside of repetitions, joined by a space. A null or empty text has no words. `change` may give each text
    other words. Other columns are left out. No rows are shuffled; memory grows with a slice and the longest text.
    """
    if least_periods < 2 or least_words < 1:
        raise ValueError("a run has at least two periods and one word")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            keys = part.column(0).to_pylist()
            texts = [t.encode().split() for t in part.column(1).to_pylist()]
            if change is not None:
                texts = [change(k, words) for k, words in zip(keys, texts, strict=True)]
            found = runs_of_texts(texts, least_words, least_periods)
            rows = [[{"start": a, "length": b, "period": q} for a, b, q in runs] for runs in found]
            short = [b" ".join(collapse(words, runs)).decode() for words, runs in zip(texts, found, strict=True)]
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(rows, pa.list_(_RUN)), pa.array(short, pa.string())], ["key", "runs", "collapsed"])

    rows = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text"))
    kind = rows.schema["key"].dataType.simpleString()
    out = rows.mapInArrow(task, f"key {kind}, runs array<struct<start: bigint, length: bigint, period: bigint>>, collapsed string")
    return out.select(F.col("key").alias(key), "runs", "collapsed")


_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def digests(found: DataFrame, key: str = "doc_id") -> DataFrame:
    """Number of runs, the longest one (ties: smallest start, then period), and digests of the runs and of the collapsed text."""
    best = F.array_min(F.transform("runs", lambda r: F.struct((-r["length"]).alias("minus"), r["start"].alias("start"), r["period"].alias("period"))))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    rows = found.select(key, F.size("runs").cast("long").alias("n_runs"), best.alias("best"), F.array_join(lines, "").alias("listed"), "collapsed")
    length, period = -F.col("best.minus"), F.col("best.period")
    return rows.select(
        key, "n_runs", F.col("best.start").alias("start"), length.alias("length"), period.alias("period"),
        F.floor(F.lit(1000) * length / period).cast("long").alias("exponent_milli"),
        F.sha2("listed", 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
