"""Language identification by words first, with back-off to ever shorter character n-grams.

A word seen in training scores by its relative log frequency in each language. A word not seen scores by the mean of its
n-grams (with a blank at both ends) of the longest length of which any is known. A language that lacks the word or n-gram
gets a fixed penalty. A text's value in a language is the mean over its words.

The model is fitted to about `most_docs` labelled texts at most, shared evenly among the languages, and keeps every word and
n-gram of them; so its size has a bound that does not depend on the corpus, and a word it has seen is never scored as unseen.
Items are held as 64-bit hashes in order, with the languages that know them.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StructType

from watchspan.llm.common import counted, slices, stored, unused

UNKNOWN = "und"
SLICE = 1 << 20  # bytes of text whose words a task holds at a time
_RUN = re.compile(r"[^\W\d_]+")


@dataclass(frozen=True)
class LanguageModel:
    langs: list[str]
    lengths: int
    penalty: float
    items: np.ndarray  # hashes of words and n-grams, in order
    first: np.ndarray  # where the entries of each item begin, and the last end
    lang: np.ndarray  # by entry: the language
    value: np.ndarray  # by entry: negative log10 frequency

    def rows(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Values by language of items, and which of them are known."""
        out = np.full((len(hashes), len(self.langs)), self.penalty)
        if not len(self.items) or not len(hashes):
            return out, np.zeros(len(hashes), bool)
        at = np.minimum(np.searchsorted(self.items, hashes), len(self.items) - 1)
        known = self.items[at] == hashes
        row = np.flatnonzero(known)
        begin, size = self.first[at[row]], np.diff(self.first)[at[row]]
        entry = np.repeat(begin - np.cumsum(size) + size, size) + np.arange(int(size.sum()))
        out[np.repeat(row, size), self.lang[entry]] = self.value[entry]
        return out, known


def _hashes(items: list[str]) -> np.ndarray:
    return np.fromiter((xxhash.xxh3_64_intdigest(x) for x in items), np.uint64, len(items))


def letter_runs(text: str) -> list[str]:
    """Lower-case runs of letters. Only letters count: no digits, marks or number signs."""
    runs = _RUN.findall(text.lower())
    if all(map(str.isalpha, runs)):
        return runs
    return [w for r in runs for w in "".join(c if c.isalpha() else " " for c in r).split()]


def grams_of(word: str, n: int) -> list[str]:
    padded = f" {word} "
    return [padded[i : i + n] for i in range(len(padded) - n + 1)] if n > 1 else list(word)


def _emit(held) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [
            pa.array([g for g, c in held.items() for _ in c], pa.string()),
            pa.array([w for c in held.values() for w in c], pa.string()),
            pa.array([n for c in held.values() for n in c.values()], pa.int64()),
        ],
        ["lang", "item", "n"],
    )


def _drawn(texts: DataFrame, most_docs: int) -> DataFrame:
    """About `most_docs` texts at most, drawn by a hash of the row: each language an even share, or all it has."""
    sizes = {r["lang"]: r["count"] for r in texts.groupBy("lang").count().orderBy("count").limit(most_docs).collect()}
    left, share = most_docs, {}
    for i, (lang, n) in enumerate(sizes.items()):
        part = min(n, left // (len(sizes) - i))
        left -= part
        share[lang] = part / n
    if all(x == 1 for x in share.values()):
        return texts
    limit = F.element_at(F.create_map(*(F.lit(x) for pair in share.items() for x in pair)), F.col("lang"))
    draw = F.xxhash64(*texts.columns).bitwiseAND(F.lit((1 << 30) - 1)) / F.lit(float(1 << 30))
    return texts.filter(F.coalesce(draw < limit, F.lit(False)))


def train(docs: DataFrame, lengths: int = 4, most_docs: int = 40_000, key: str = "doc_id") -> LanguageModel:
    """Learn from docs (text, lang). Rows without language or text are left out. A column `key`, if there is one, lets equal texts
    be drawn apart."""

    def count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def items():
            for batch in slices(batches, most=SLICE):
                for text, lang in zip(batch.column("text").to_pylist(), batch.column("lang").to_pylist(), strict=True):
                    yield lang, letter_runs(text)

        yield from counted(items(), _emit, 150_000)

    def count_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def items():
            for batch in batches:
                for lang, word, n in zip(*(batch.column(c).to_pylist() for c in ("lang", "item", "n")), strict=True):
                    found = Counter(f"\t{g}" for k in range(1, lengths + 1) for g in grams_of(word, k))
                    yield lang, {g: c * n for g, c in found.items()}

        yield from counted(items(), _emit, 100_000)

    schema = "lang string, item string, n long"
    columns = [c for c in ("text", "lang", key) if c in docs.columns]
    texts = _drawn(docs.select(*columns).filter("lang is not null and text is not null"), most_docs).select("text", "lang")
    by_word = stored(texts.mapInArrow(count_words, schema).groupBy("lang", "item").agg(F.sum("n").alias("n")), "words")
    by_gram = by_word.mapInArrow(count_grams, schema).groupBy("lang", "item").agg(F.sum("n").alias("n"))
    counts = by_word.unionByName(by_gram)
    found = counts.toArrow()  # as large as the drawn texts at most
    langs = sorted(pc.unique(found.column("lang")).to_pylist())
    if not langs:
        none = np.zeros(0)
        return LanguageModel([], lengths, 1.0, none.astype(np.uint64), np.zeros(1, np.int64), none.astype(np.int32), none)
    lang = np.array(pc.index_in(found.column("lang"), pa.array(langs)), np.int32)
    n = np.array(found.column("n"), np.float64)
    is_gram = np.array(pc.starts_with(found.column("item"), "\t"))
    size = np.where(is_gram, np.array(pc.utf8_length(found.column("item"))) - 1, 0)
    totals = np.zeros((len(langs), lengths + 1))
    np.add.at(totals, (lang, size), n)
    hashes = _hashes(found.column("item").to_pylist())
    order = np.lexsort((lang, hashes))
    items, first = np.unique(hashes[order], return_index=True)
    value = np.log10(totals[lang, size]) - np.log10(n)
    return LanguageModel(langs, lengths, 1 + math.log10(totals.max()), items, np.append(first, len(order)), lang[order], value[order])


def word_rows(model: LanguageModel, words: list[str]) -> np.ndarray:
    """Values by language of distinct words; unseen ones back off to the longest n-grams of which any is known."""
    out, known = model.rows(_hashes(words))
    unseen = np.flatnonzero(~known)
    for size in range(model.lengths, 0, -1):
        if not len(unseen):
            break
        grams = [[f"\t{g}" for g in grams_of(words[i], size)] for i in unseen.tolist()]
        owner = np.repeat(np.arange(len(unseen)), [len(g) for g in grams])
        values, met = model.rows(_hashes([g for row in grams for g in row]))
        hits = np.bincount(owner[met], minlength=len(unseen))
        sums = np.zeros((len(unseen), len(model.langs)))
        np.add.at(sums, owner[met], values[met])
        done = hits > 0
        out[unseen[done]] = sums[done] / hits[done, None]
        unseen = unseen[~done]
    return out


def identify(docs: DataFrame, model: LanguageModel, text: str = "text") -> DataFrame:
    """docs with lang_pred and lang_score. lang_score is the share of the chosen language when the values of all languages
    are weighed as likelihoods of as many independent words as the square root of the text's. Equal values go to the
    language first in order. Null texts, and texts without a letter, get `und` and 0; so does every text if the model knows no
    language. Columns of these names are replaced; all others pass unchanged.
    """
    held = docs.sparkSession.sparkContext.broadcast(vars(model))
    names = [c for c in docs.columns if c not in ("lang_pred", "lang_score")]
    of = unused("_text", names)
    base = docs.select(*(docs[f"`{c}`"] for c in names), docs[f"`{text}`"].alias(of))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = LanguageModel(**held.value)
        bytes_ = max(1 << 16, 4 * SLICE // max(4, len(m.langs)))
        for batch in slices(batches, of, bytes_):
            runs = [letter_runs(t) for t in batch.column(of).to_pylist()]
            sizes = np.array([len(r) for r in runs], np.int64)
            best, share = np.full(len(runs), -1), np.zeros(len(runs))
            full = np.flatnonzero(sizes)
            if len(full) and m.langs:
                place: dict[str, int] = {}
                at = np.fromiter((place.setdefault(w, len(place)) for r in runs for w in r), np.int64, int(sizes.sum()))
                rows = word_rows(m, list(place))[at]
                starts = np.concatenate([[0], np.cumsum(sizes[full])[:-1]])
                mean = np.add.reduceat(rows, starts, axis=0) / sizes[full, None]
                likely = np.exp((mean.min(axis=1, keepdims=True) - mean) * math.log(10) * np.sqrt(sizes[full, None]))
                best[full] = mean.argmin(axis=1)
                share[full] = 1 / likely.sum(axis=1)
            langs = [m.langs[b] if b >= 0 else UNKNOWN for b in best.tolist()]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(langs, pa.string()), pa.array(share)], [*names, "lang_pred", "lang_score"])

    fields = base.schema.fields[:-1]
    return base.mapInArrow(run, StructType([*fields, *StructType.fromDDL("lang_pred string, lang_score double").fields]))
