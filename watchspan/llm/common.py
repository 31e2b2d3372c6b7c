"""Helpers the operators share: stored tables, bounded Arrow batches, and hashing of words and shingles.

Tasks see texts as Arrow batches. The byte buffers of a batch are hashed with numpy as one array, in slices of
bounded size, so a task's memory depends on the slice and the longest text, not on the partition.
"""

from __future__ import annotations

import uuid
from collections import Counter
from collections.abc import Callable, Iterator
from functools import wraps

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from watchspan.session import ensure_checkpoint_dir

SLICE_BYTES = 4 << 20
_M64 = (1 << 64) - 1


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def fold(key: Column | str, mod: int) -> Column:
    """crc32 of the key as text, modulo: the fold a row is held out by. A null key counts as the empty text."""
    key = F.col(key) if isinstance(key, str) else key
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % mod


def small_batches(spark: SparkSession, most: str = "4m") -> None:
    """Let Arrow batches of the session hold `most` bytes, unless it has its own setting: Spark's 64 MB are held by the JVM's
    buffers and by Python several times each, in every task."""
    name, default = "spark.sql.execution.arrow.maxBytesPerBatch", "67108864b"
    if spark.conf.get(name) == default:
        spark.conf.set(name, most)


_made: list[str] = []


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write to the shared checkpoint folder as Parquet and read back: cuts the lineage and outlives lost executors."""
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    path = f"{spark.sparkContext.getCheckpointDir()}/{label}-{uuid.uuid4().hex}"
    _made.append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def laid(df: DataFrame, label: str, key: str, parts: int) -> DataFrame:
    """Like `stored`, dealt by a hash of `key` into `parts`: grouping by the key reads it without a shuffle. The catalog knows the
    table only while it is written."""
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    name = f"{label}_{uuid.uuid4().hex}"
    path = f"{spark.sparkContext.getCheckpointDir()}/{name}"
    _made.append(path)
    df.repartition(parts, key).write.bucketBy(parts, key).option("path", path).saveAsTable(name, format="parquet")
    try:
        return spark.table(name)
    finally:
        spark.sql(f"DROP TABLE {name}")


def tidied(make: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """`make`, which afterwards removes the tables that it stored on its way and that its result does not read."""

    @wraps(make)
    def tidy(*args, **kwargs) -> DataFrame:
        first = len(_made)
        out = make(*args, **kwargs)
        read = {f.rpartition("/")[0].rpartition("/")[2] for f in out.inputFiles()}
        for path in _made[first:]:
            if path.rpartition("/")[2] not in read:
                _remove(out.sparkSession, path)
        del _made[first:]
        return out

    return tidy


def _remove(spark: SparkSession, folder: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def discard(df: DataFrame) -> None:
    """Remove the files of a stored table that nothing reads any more."""
    for folder in {x.rpartition("/")[0] for x in df.inputFiles()}:
        _remove(df.sparkSession, folder)


def unused(name: str, taken: list[str]) -> str:
    """`name`, lengthened until no column has it, whatever the case."""
    low = {c.lower() for c in taken}
    while name.lower() in low:
        name = f"_{name}"
    return name


def slices(batches: Iterator[pa.RecordBatch], text: str = "text", most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows of Arrow batches in slices of about `most` bytes of text, one row at least; null texts become empty. What Arrow keeps
    of freed memory goes back after each batch: workers live on beside those of the next stage."""
    for batch in batches:
        at = batch.schema.get_field_index(text)
        batch = batch.set_column(at, text, pc.fill_null(batch.column(at), "").cast(pa.large_string()))
        if not batch.num_rows:
            continue
        _, ends = flat(batch.column(at))
        first = 0
        while first < batch.num_rows:
            last = int(np.searchsorted(ends, ends[first] + most, "right")) - 1
            last = min(max(last, first + 1), batch.num_rows)
            yield batch.slice(first, last - first)
            first = last
        del batch
        pa.default_memory_pool().release_unused()


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a large_string column without nulls, end to end, and where each text begins (and the last ends)."""
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every bit over all others."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_BASE = 0x5851F42D4C957F2D


def powers(n: int, base: int = _BASE) -> np.ndarray:
    p = np.full(max(n, 1), base, np.uint64)
    p[0] = 1
    return np.multiply.accumulate(p)


def run_hashes(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each run of 64-bit values; runs lie end to end and none is empty."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    lengths = np.diff(np.append(starts, len(values)))
    place = np.arange(len(values)) - np.repeat(starts, lengths)
    sums = np.add.reduceat(values * powers(int(lengths.max()))[place], starts)
    return mix(sums + lengths.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of texts (A-Z lower-cased, cut at white space), and where each text's words begin (and the last end)."""
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    word = ~_SPACE[data]
    start = word.copy()
    start[1:] &= ~word[:-1]
    begins = offsets[:-1][np.diff(offsets) > 0]
    start[begins] = word[begins]
    held = np.flatnonzero(word)
    starts = np.flatnonzero(start[held])
    hashes = run_hashes(_BYTE[_LOWER[data[held]]], starts)
    return hashes, np.searchsorted(np.flatnonzero(start), offsets)


def shingle_hashes(words: np.ndarray, firsts: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct k-word shingles of each text as sorted hashes, and where each text's begin (and the last end).

    A text of fewer words has its whole sequence as the only one; a text without words has none.
    """
    n = len(words)
    if n >= k:
        rolled = np.zeros(n - k + 1, np.uint64)
        for i, p in enumerate(powers(k, 0x9FB21C651E98DF25)):
            rolled += words[i : n - k + 1 + i] * p
        rolled = mix(rolled)
    sets, ends = [], np.zeros(len(firsts), np.int64)
    for i, (a, b) in enumerate(zip(firsts[:-1].tolist(), firsts[1:].tolist(), strict=True)):
        if b - a >= k:
            sets.append(np.unique(rolled[a : b - k + 1]))
        elif b > a:
            sets.append(run_hashes(words[a:b], np.zeros(1, np.int64)))
        else:
            ends[i + 1] = ends[i]
            continue
        ends[i + 1] = ends[i] + len(sets[-1])
    return (np.concatenate(sets) if sets else np.zeros(0, np.uint64)), ends


def counted(
    items: Iterator[tuple[object, list]], emit, most: int = 400_000
) -> Iterator[pa.RecordBatch]:
    """Counts of (group, item) over a task's items, handed on whenever `most` distinct items are held.

    The counts of all tasks are summed by a later groupBy; this is only its map-side part.
    """
    held: dict[object, Counter] = {}
    for group, found in items:
        held.setdefault(group, Counter()).update(found)
        if sum(map(len, held.values())) >= most:
            yield emit(held)
            held = {}
    if held:
        yield emit(held)


def as_columns(df: DataFrame, *columns: str) -> DataFrame:
    """Only the named columns, so that others of any name neither travel nor clash."""
    return df.select(*(F.col(f"`{c}`") for c in columns))
