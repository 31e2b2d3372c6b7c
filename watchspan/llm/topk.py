"""Exact top-k by inner product, a block of rows at a time.

Each vector component is a term that occurs in every row, so a block's term maxima are the largest and the smallest value of
each component. For a query q, sum over components of max(q * largest, q * smallest) bounds every score in the block.

1. Components become integers. Rows are ordered by the nearest of a few pivots (a bounded sample, which only serves to put
   like rows side by side), then by id, and cut into ranges of `BLOCK` rows. A block's forward index holds its rows' ids and
   components; `SEGMENT` blocks are one row of a stored table. Range partitioning splits a pivot or a group of copies of
   any size.
2. Queries are packed into chunks. Every chunk meets every segment once, in blocks; a chunk's key is spread over `SALTS`
   tasks.
3. For each query of a chunk, a segment's blocks are taken in the order of their bounds and scored through the forward index
   until the next bound is below the kth score so far. Rows with a score equal to the kth can still win by a smaller id, so
   equal bounds are scored too.
4. The best k of all segments are ranked per query.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F

from watchspan.llm.common import stored

BLOCK, SEGMENT, CHUNK, SALTS, PIVOTS = 256, 32, 512, 16, 64
_NONE = np.iinfo(np.int64).min


def integers(vectors: DataFrame, scale: int, key: str, vector: str) -> DataFrame:
    """(id, v): floor(scale * x) of each component as long, of rows whose id and vector are there and hold only finite numbers.

    A component that a long cannot hold stops the job: no score could be told.
    """
    v = F.col(f"`{vector}`")
    limit = float(1 << 63)
    too_large = F.raise_error(F.lit("a vector's component times the scale does not fit into 64 bits")).cast("long")
    named = vectors.select(F.col(f"`{key}`").cast("long").alias("id"), v.alias("_v")).filter("id is not null and _v is not null")
    finite = F.forall("_v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")))

    def whole(x: Column) -> Column:
        wide = x.cast("double") * scale
        return F.when(F.abs(wide) < limit, F.floor(wide).cast("long")).otherwise(too_large)

    return named.filter(finite).select("id", F.transform("_v", whole).alias("v"))


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    """Rows of a list column as one matrix; shorter ones end in zeros."""
    sizes = np.diff(np.asarray(column.offsets))
    out = np.zeros((len(column), dims), np.int64)
    out[np.arange(dims)[None, :] < sizes[:, None]] = column.flatten().to_numpy(zero_copy_only=False)
    return out


def _near(dims: int, pivots: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        towards = pivots.astype(np.float64)
        for batch in batches:
            if batch.num_rows:
                near = (_matrix(batch.column("v"), dims) @ towards.T).argmax(axis=1).astype(np.int32)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(near)], ["id", "v", "near"])

    return run


def _packed(dims: int, rows: int):
    """Each partition's rows, in their order, as records of at most `rows` rows: number, ids and components as bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, made = TaskContext.get().partitionId() << 32, 0
        ids, held, n = [], [], 0

        def emit(a: np.ndarray, m: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([part + made]), pa.array([a.tobytes()], pa.binary()), pa.array([m.tobytes()], pa.binary())], ["number", "ids", "rows"]
            )

        for batch in batches:
            ids.append(np.array(batch.column("id"), np.int64))
            held.append(_matrix(batch.column("v"), dims))
            n += batch.num_rows
            if n >= rows:
                a, m = np.concatenate(ids), np.concatenate(held)
                while len(a) >= rows:
                    yield emit(a[:rows], m[:rows])
                    made += 1
                    a, m = a[rows:], m[rows:]
                ids, held, n = [a], [m], len(a)
        if n:
            yield emit(np.concatenate(ids), np.concatenate(held))

    return run


def product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact a @ b.T of integers: as doubles while every partial sum fits their 53 bits, as long numbers beyond 63 bits.

    A product that 64 bits cannot hold is an error.
    """
    most = _largest(a) * _largest(b) * a.shape[1]
    if most < 1 << 53:
        return np.rint(a.astype(np.float64) @ b.T.astype(np.float64)).astype(np.int64)
    if most < 1 << 63:
        return a @ b.T
    exact = a.astype(object) @ b.T.astype(object)
    if exact.size and not (-(1 << 63) < exact.min() and exact.max() < 1 << 63):
        raise OverflowError("a score does not fit into 64 bits")
    return exact.astype(np.int64)


def _largest(x: np.ndarray) -> int:
    return max(int(x.max(initial=0)), -int(x.min(initial=0)))


def search(q_ids: np.ndarray, q: np.ndarray, ids: np.ndarray, rows: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Ids and scores (queries by k, best first, `_NONE` where there is none) of a segment, and how many pairs were scored."""
    cuts = list(range(0, len(ids), BLOCK))
    blocks = []
    for at in cuts:
        order = np.argsort(ids[at : at + BLOCK], kind="stable")
        blocks.append((ids[at : at + BLOCK][order], rows[at : at + BLOCK][order]))
    up, down = np.maximum(q, 0), np.minimum(q, 0)
    if _largest(q) * _largest(rows) * q.shape[1] < 1 << 62:
        bounds = product(up, np.stack([r.max(axis=0) for _, r in blocks])) + product(down, np.stack([r.min(axis=0) for _, r in blocks]))
    else:  # sums of such numbers may leave 64 bits where no score does: no block is left out
        bounds = np.full((len(q), len(blocks)), np.iinfo(np.int64).max)
    order = np.argsort(-bounds, axis=1, kind="stable")
    best_id = np.full((len(q), k), np.iinfo(np.int64).max)
    best = np.full((len(q), k), _NONE)
    active, scored = np.arange(len(q)), 0
    for turn in range(len(blocks)):
        mine = order[active, turn]
        active = active[bounds[active, mine] >= best[active, -1]]
        if not len(active):
            break
        mine = order[active, turn]
        for b in np.unique(mine).tolist():
            who = active[mine == b]
            b_ids, b_rows = blocks[b]
            score = product(q[who], b_rows)
            scored += score.size
            score[q_ids[who][:, None] == b_ids[None, :]] = _NONE
            top = np.argsort(-score, axis=1, kind="stable")[:, :k] if k < score.shape[1] else np.broadcast_to(np.arange(score.shape[1]), score.shape)
            s = np.concatenate([best[who], np.take_along_axis(score, top, axis=1)], axis=1)
            i = np.concatenate([best_id[who], b_ids[top]], axis=1)
            i[s == _NONE] = np.iinfo(np.int64).max
            keep = np.lexsort((i, ~s), axis=1)[:, :k]  # ~s falls as s rises and has no overflow
            best[who], best_id[who] = np.take_along_axis(s, keep, axis=1), np.take_along_axis(i, keep, axis=1)
    return best_id, best, scored


def _searched(dims: int, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                q_ids, ids = (np.frombuffer(batch.column(c)[r].as_buffer(), np.int64) for c in ("q_ids", "ids"))
                q, rows = (np.frombuffer(batch.column(c)[r].as_buffer(), np.int64).reshape(-1, dims) for c in ("q_rows", "rows"))
                found, score, _ = search(q_ids, q, ids, rows, k)
                real = score != _NONE
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.broadcast_to(q_ids[:, None], real.shape)[real]), pa.array(found[real]), pa.array(score[real])], ["query_id", "vec_id", "score"]
                )

    return run


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 10, scale: int = 1024, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the k best rows of vectors for each row of queries, by the inner product of
    floor(scale * component), ties to the smaller id; a query's own id is no candidate.

    Rows whose id or vector is null, or whose vector holds null or non-finite components, take no part. Components and scores
    that a long cannot hold are an error. Shorter vectors end in zeros. Queries that repeat an id count once, with the first vector in order; candidates
    that repeat an id stay one row each. No queries or no candidates give no rows. Other columns are ignored.
    """
    rows = integers(vectors, scale, key, vector)
    asked = integers(queries, scale, key, vector).groupBy("id").agg(F.min("v").alias("v"))
    dims = max(rows.agg(F.max(F.size("v"))).first()[0] or 0, 1)
    draw = F.xxhash64("id")
    pivots = rows.orderBy(draw, "id").limit(PIVOTS).select("v").collect()
    towards = np.zeros((max(len(pivots), 1), dims), np.int64)
    for i, p in enumerate(pivots):
        towards[i, : len(p.v)] = p.v
    near = rows.mapInArrow(_near(dims, towards), "id long, v array<long>, near int")
    packed = "number long, ids binary, rows binary"
    segments = stored(near.repartitionByRange("near", "id", draw).sortWithinPartitions("near", "id").mapInArrow(_packed(dims, BLOCK * SEGMENT), packed), "segments")
    chunks = stored(asked.mapInArrow(_packed(dims, CHUNK), packed), "chunks")
    salt = F.pmod(F.xxhash64("number"), F.lit(SALTS))
    held = chunks.select(F.col("number").alias("chunk"), F.col("ids").alias("q_ids"), F.col("rows").alias("q_rows"), F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    pairs = segments.withColumn("salt", salt.cast("int")).join(held, "salt").select("ids", "rows", "q_ids", "q_rows")
    found = pairs.mapInArrow(_searched(dims, k), "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
