"""SentencePiece encoding and decoding through a table of distinct marked words.

The model writes a space as a marker at the head of the next word. If none of its pieces holds a marker behind another
character, no merge can cross from one marked word to the next, so the ids of a text are those of its marked words, end
to end. Each task keeps a table of the distinct marked words it has met: a word is segmented by the library once, and
its ids are joined back at every position where it occurs. The table starts anew when it holds `most` words, which
bounds memory. Words of a text are numbers, and their ids are laid end to end as arrays, not one by one. Texts never leave their task, so there is no shuffle; one table for the whole corpus would mean to shuffle
every position of every word, several times the input. A model that does not meet the condition encodes whole texts.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from watchspan.llm.common import slices, unused

MARK = "▁"
PIECE_BYTES = 1 << 20  # of text at a time: each of its words becomes a Python string
_CHUNK = re.compile(" +[^ ]*")


def separable(sp: sentencepiece.SentencePieceProcessor) -> bool:
    """Whether marked words can be segmented apart: no piece crosses a marker and spaces are kept as they are."""
    pieces = [sp.id_to_piece(i) for i in range(sp.get_piece_size())]
    crossing = any(MARK in p.lstrip(MARK) for p in pieces)
    kept = all(sp.encode(t, out_type=str) and "".join(sp.encode(t, out_type=str)) == MARK + t.replace(" ", MARK) for t in ("a", " a", "a  a ", "a a"))
    return not crossing and kept and sp.piece_to_id(MARK) != sp.unk_id() and sp.encode("") == []


def marked_words(text: str) -> list[str]:
    """The text as words that each begin with their markers, written as spaces; one marker is put before the text."""
    if not text:
        return []
    text = text.replace(MARK, " ")
    if "  " not in text and text[0] != " " and text[-1] != " ":
        return text.split(" ")
    return [c[1:] if len(c) > 1 else MARK for c in _CHUNK.findall(" " + text)]


class WordTable:
    """Ids by marked word (without its first marker; a lone marker stands for itself): words are numbered, and the ids of a
    number lie in `flat` from `firsts`, `sizes` of them."""

    def __init__(self, sp: sentencepiece.SentencePieceProcessor, most: int):
        self.sp, self.most = sp, most
        self._clear()

    def _clear(self) -> None:
        self.held, self.flat, self.firsts, self.sizes = {}, np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def _add(self, fresh: list[str]) -> None:
        found = [[self.sp.piece_to_id(MARK)] if w == MARK else ids for w, ids in zip(fresh, self.sp.encode(fresh, num_threads=1), strict=True)]
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        self.held.update(zip(fresh, range(len(self.held), len(self.held) + len(fresh))))
        self.firsts = np.concatenate([self.firsts, len(self.flat) + np.cumsum(sizes) - sizes])
        self.flat = np.concatenate([self.flat, np.fromiter(chain.from_iterable(found), np.int32, int(sizes.sum()))])
        self.sizes = np.concatenate([self.sizes, sizes])

    def ids(self, texts: list[str]) -> pa.ListArray:
        words = [marked_words(t) for t in texts]
        met = set().union(*words)
        fresh = [w for w in met if w not in self.held]
        if len(self.held) + len(fresh) > self.most:
            self._clear()
            fresh = list(met)
        if fresh:
            self._add(fresh)
        ends = np.cumsum([0, *map(len, words)])
        numbers = np.fromiter(map(self.held.__getitem__, chain.from_iterable(words)), np.int64, int(ends[-1]))
        sizes = self.sizes[numbers]
        behind = np.concatenate([[0], np.cumsum(sizes)])
        at = np.repeat(self.firsts[numbers] - behind[:-1], sizes) + np.arange(behind[-1])
        return pa.ListArray.from_arrays(pa.array(behind[ends].astype(np.int32)), pa.array(self.flat[at]))


def _lists(rows: list[list[int]]) -> pa.Array:
    ends = np.cumsum([0, *map(len, rows)], dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.fromiter(chain.from_iterable(rows), np.int32, int(ends[-1]))))


def _rows(lists: pa.ListArray) -> list[list[int]]:
    """The lists as Python has them, a null one as an empty one: all numbers at once, which is faster than one at a time."""
    flat = lists.flatten().to_numpy(zero_copy_only=False).tolist()
    ends = np.cumsum([0, *pc.fill_null(pc.list_value_length(lists), 0).to_pylist()]).tolist()
    return [flat[a:b] for a, b in zip(ends, ends[1:])]


def encode(docs: DataFrame, model: bytes, text: str = "text", into: str = "ids", most: int = 300_000) -> DataFrame:
    """docs with the column `into` (array of int): the ids of each whole text, as the library encodes it without begin or
    end ids. A null text is encoded as the empty one, without ids; its column stays null. A column of that name is replaced.
    """
    held = docs.sparkSession.sparkContext.broadcast(model)
    names = [c for c in docs.columns if c != into]
    docs = docs.select(*(docs[f"`{c}`"] for c in names))
    extra = unused("_filled", names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sp = sentencepiece.SentencePieceProcessor(model_proto=held.value)
        table = WordTable(sp, most) if separable(sp) else None
        for whole in batches:
            filled = whole.append_column(extra, whole.column(text))
            for batch in slices(iter([filled]), extra, PIECE_BYTES):
                texts = batch.column(extra).to_pylist()
                ids = table.ids(texts) if table is not None else _lists(sp.encode(texts, num_threads=1))
                yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), ids], [*names, into])

    return docs.mapInArrow(run, StructType([*docs.schema.fields, StructField(into, ArrayType(IntegerType()))]))


def decode(docs: DataFrame, model: bytes, ids: str = "ids", into: str = "decoded") -> DataFrame:
    """docs with the column `into` (string): the library's text for each list of ids; null lists give the empty text."""
    held = docs.sparkSession.sparkContext.broadcast(model)
    names = [c for c in docs.columns if c != into]
    docs = docs.select(*(docs[f"`{c}`"] for c in names))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sp = sentencepiece.SentencePieceProcessor(model_proto=held.value)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                texts = [sp.decode(x) if x else "" for x in _rows(part.column(ids))]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.string())], [*names, into])
            pa.default_memory_pool().release_unused()

    return docs.mapInArrow(run, StructType([*docs.schema.fields, StructField(into, StringType())]))


def read_model(path: str) -> bytes:
    """The model file as bytes, which travel to the executors; the path is on the driver."""
    with open(path, "rb") as f:
        return f.read()
