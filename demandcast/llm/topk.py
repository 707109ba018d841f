"""Exact top-k inner-product search by a three-phase uniform threshold.

The dimensions are cut into ``blocks``; a vector's score for a query is the
sum of its block scores. Vectors are packed into chunks and queries into
blocks, and every (chunk, query block) tile is one small matrix product.

1. Every tile gathers, per query and dimension block, its ``k`` best vectors
   by block score, resolves their full scores, and reports the k best. The
   k-th best score over all tiles of a query is a lower bound of its true
   k-th score.
2. Cut off at ``floor`` of that bound divided by the number of blocks: a
   vector with every block score below the cutoff scores below the bound, so
   it can't be among the k best. The cutoffs travel with the query blocks;
   every tile collects the vectors that reach it in some block. Of these, a
   vector stays only if its block scores that reach the cutoff, plus the
   cutoff for each other block, can still reach the bound.
3. The full scores of the vectors that stay are resolved exactly, and the k
   best per tile are merged into the k best per query.

Components are floor(scale * x) as integers, of any size. Products run in
float64 while every sum is below 2^53, where it is exact, and in Python
integers beyond; only a score that does not fit 64 bits fails.

Every vector is compared with every query, in tiles, as the search is exact
over a stated query set; a tile returns k rows a query at most. Chunks hold
``chunk_rows`` vectors and a query block the queries of one chunk, so a task's
memory does not grow with the input.

Cases: vectors that are null, empty or hold null or non-finite components
take no part; vectors meet queries of their own length only; a query's own
are all rows with its id; repeated rows count as rows; ties go to the smaller
id; rows with a null id take no part; fewer than k candidates give fewer
rows; an empty table gives no rows; a score beyond 64 bits raises.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from demandcast.llm.common import map_arrow, pick, rows_in, Scratch

CHUNK_ROWS = 8192
DIMENSION_BLOCKS = 4
SCALE = 256
EXACT = float(1 << 53)

_CHUNK = "chunk long, dim int, n int, ids binary, vals binary"
_HITS = pa.schema([("block", pa.int64()), ("row", pa.int32()), ("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])
HITS = "block long, row int, query_id long, vec_id long, score long"


_whole = np.frompyfunc(int, 1, 1)


def _matrix(blob: bytes, dim: int, scale: int) -> np.ndarray:
    """floor(scale * x) of packed components: whole float64 numbers, or Python
    integers where they go beyond the range of doubles."""
    x = np.frombuffer(blob, "<f8").reshape(-1, dim)
    with np.errstate(over="ignore"):
        scaled = np.floor(x * scale)
    return scaled if np.isfinite(scaled).all() else np.where(np.isfinite(scaled), 0, _whole(x) * scale) + _whole(np.where(np.isfinite(scaled), scaled, 0))


def _packed(vectors: DataFrame, rows: int) -> DataFrame:
    """(dim, n, ids, vals): up to ``rows`` valid vectors of one length a row."""
    schema = pa.schema([("dim", pa.int32()), ("n", pa.int32()), ("ids", pa.binary()), ("vals", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}

        def flush(dim):
            ids, vals = (np.concatenate(x) for x in zip(*held.pop(dim)))
            for at in range(0, len(ids), rows):
                part = slice(at, at + rows)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([dim], pa.int32()), pa.array([len(ids[part])], pa.int32()),
                     pa.array([ids[part].astype("<i8").tobytes()], pa.binary()), pa.array([vals[part].astype("<f8").tobytes()], pa.binary())],
                    schema=schema)

        for batch in rows_in(batches, rows):
            lists = batch.column(1)
            ids = np.asarray(batch.column(0).to_numpy(zero_copy_only=False), np.int64)
            flat = lists.flatten().cast(pa.float64())
            values = flat.to_numpy(zero_copy_only=False)  # null as NaN
            lengths = np.array([0 if n is None else n for n in pa.compute.list_value_length(lists).to_pylist()], np.int64)
            ends = np.cumsum(lengths)
            finite = np.concatenate([[0], np.cumsum(np.isfinite(values))])
            good = (lengths > 0) & (finite[ends] - finite[ends - lengths] == lengths)
            for dim in np.unique(lengths[good]):
                where = np.flatnonzero(good & (lengths == dim))
                held.setdefault(int(dim), []).append((ids[where], values[(ends[where] - dim)[:, None] + np.arange(dim)]))
                if sum(len(i) for i, _ in held[int(dim)]) >= rows:
                    yield from flush(int(dim))
        for dim in list(held):
            yield from flush(dim)

    return map_arrow(vectors, run, "dim int, n int, ids binary, vals binary")


def _product(q: np.ndarray, v: np.ndarray) -> np.ndarray:
    """q @ v.T of integers, exact."""
    if not q.size or not v.size:
        return np.zeros((len(q), len(v)))
    if q.dtype != object and v.dtype != object and float(np.abs(q).max()) * float(np.abs(v).max()) * q.shape[1] < EXACT:
        return q @ v.T
    return _whole(q) @ _whole(v).T


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k highest scores, ties to the smaller id."""
    if len(scores) > k:
        line = np.partition(scores, len(scores) - k)[len(scores) - k]
        some = np.flatnonzero(scores >= line)
    else:
        some = np.arange(len(scores))
    return some[np.lexsort((ids[some], -scores[some]))][:k]


def _tile(q_ids, q, v_ids, v, k, blocks, bounds) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(row of the query, candidate positions, their exact scores): phase 1
    without bounds, phases 2 and 3 with each query's bound."""
    cuts = np.array_split(np.arange(q.shape[1]), min(blocks, q.shape[1]))
    parts = [_product(q[:, c], v[:, c]) for c in cuts]
    for i in range(len(q)):
        other = np.flatnonzero(v_ids != q_ids[i])
        if not len(other):
            continue
        own = [p[i, other] for p in parts]
        if bounds is None:
            some = np.unique(np.concatenate([_best(s, v_ids[other], k) for s in own]))
        elif bounds[i] is None:  # fewer than k candidates anywhere: all of them count
            some = np.arange(len(other))
        else:
            cutoff = bounds[i] // len(own)
            reach = sum(np.maximum(s, cutoff) for s in own)
            some = np.flatnonzero(np.any([s >= cutoff for s in own], axis=0) & (reach >= bounds[i]))
        if not len(some):
            continue
        scores = sum(s[some] for s in own)
        best = _best(scores, v_ids[other[some]], k)
        yield i, other[some[best]], scores[best]


def _search(tiles: DataFrame, k: int, blocks: int, scale: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows_in(batches, 1):
            row = batch.to_pylist()[0]
            q_ids, v_ids = np.frombuffer(row["q_ids"], "<i8"), np.frombuffer(row["ids"], "<i8")
            out: list[tuple] = []
            found = _tile(q_ids, _matrix(row["q_vals"], row["dim"], scale), v_ids, _matrix(row["vals"], row["dim"], scale), k, blocks, row["bounds"])
            for i, at, scores in found:
                out += [(row["block"], i, int(q_ids[i]), int(v_ids[a]), int(s)) for a, s in zip(at, scores)]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), _HITS)], schema=_HITS)

    return map_arrow(tiles.select("block", "q_ids", "q_vals", "bounds", "dim", "ids", "vals"), run, HITS)


def _merge(hits: DataFrame, k: int) -> DataFrame:
    """The k best hits of each query; the aggregate keeps k a task and query."""
    order = F.struct((-F.col("score")).alias("neg"), F.col("vec_id").alias("vec_id"))
    best = F.slice(F.array_sort(F.flatten(F.collect_list("some"))), 1, k)
    # first within spread-out groups of a query's tiles, then over those
    salted = hits.withColumn("order", order).withColumn("salt", F.pmod(F.xxhash64("vec_id"), F.lit(16)))
    some = salted.groupBy("block", "row", "query_id", "salt").agg(F.slice(F.array_sort(F.collect_list("order")), 1, k).alias("some"))
    return some.groupBy("block", "row", "query_id").agg(best.alias("best"))


def top_k(vectors: DataFrame, queries: DataFrame, scratch: Scratch, k: int = 5, id_col: str = "vec_id", vec_col: str = "embedding",
          scale: int = SCALE, blocks: int = DIMENSION_BLOCKS, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """(query_id, rank, vec_id, score) of every query's k best other vectors."""

    def source(df):
        return pick(df, id_col, vec_col).toDF("_id", "_vec").filter("_id is not null").select(
            F.col("_id").cast("long").alias("_id"), F.col("_vec").cast("array<double>").alias("_vec"))

    number = F.monotonically_increasing_id()
    chunks = scratch.write(_packed(source(vectors), chunk_rows).withColumn("chunk", number), "chunks")
    asked = scratch.write(
        _packed(source(queries), max(1, chunk_rows // 8)).select(
            number.alias("block"), F.col("dim").alias("q_dim"), F.col("ids").alias("q_ids"), F.col("vals").alias("q_vals")), "queries")

    # a tile per chunk and query block of one length: the query blocks, a
    # fraction of the vectors, go to the chunks
    places = chunks.groupBy("dim").agg(F.collect_list("chunk").alias("places"))  # 8 bytes a chunk
    no_bounds = F.lit(None).cast("array<long>").alias("bounds")

    def tiles(blocks_of_queries):
        sent = blocks_of_queries.join(places, F.col("q_dim") == F.col("dim")).drop("dim").withColumn("to", F.explode("places")).drop("places")
        return sent.join(chunks, F.col("to") == F.col("chunk"))

    first = scratch.write(_merge(_search(tiles(asked.select("*", no_bounds)), k, blocks, scale), k), "lists")
    kth = F.when(F.size("best") >= k, -F.element_at("best", k)["neg"])
    bounds = first.select("block", F.struct("row", kth.alias("kth")).alias("b")).groupBy("block").agg(F.collect_list("b").alias("known"))

    def spread(known, ids):  # bounds by row of the block, null where none
        rows = F.sequence(F.lit(0), (F.octet_length(ids) / 8).cast("int") - 1)
        by_row = F.map_from_entries(known)
        return F.when(known.isNull(), F.transform(rows, lambda r: F.lit(None).cast("long"))).otherwise(
            F.transform(rows, lambda r: F.try_element_at(by_row, r)))

    bounded = asked.join(bounds, "block", "left").withColumn("bounds", spread(F.col("known"), F.col("q_ids"))).drop("known")
    final = _merge(_search(tiles(bounded), k, blocks, scale), k)
    return final.select("query_id", F.posexplode("best").alias("at", "hit")).select(
        "query_id", (F.col("at") + 1).cast(T.IntegerType()).alias("rank"), F.col("hit.vec_id").alias("vec_id"), (-F.col("hit.neg")).alias("score"))
