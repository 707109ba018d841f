"""Approximate nearest neighbours by collision counting with virtual rehashing.

Nearness is the inner product. Vectors are scaled by the longest norm of their
length and lifted onto the unit sphere by one more component, and queries are
scaled to norm 1, so a larger product is a smaller distance. Each of
``projections`` fixed random directions is a hash function by itself: the
projections of a chunk of vectors form one sorted array per direction.

Query-centred windows are opened in every sorted array; a vector whose rank
lies in a window collides with the query in that direction. The windows of all
directions grow or shrink together by levels (virtual rehashing: a larger radius
is a wider window over the same array), and a vector that collides in at least
``share`` of the directions is a candidate. A query's level in a chunk is the
first at which the chunk has its part of ``wanted`` = ``factor`` * sqrt(number
of vectors) candidates, ``least`` at least. Candidates are verified by their
exact inner product, and the k nearest of each chunk are merged.

The last level has no bound, so a chunk with fewer vectors than its part
verifies all of them. All vectors are indexed; nothing is fitted on a sample,
directions come from a seed. Vectors are dealt into chunks by a hash of their
id, so near ones spread over chunks. Every chunk meets every block of queries
in a tile of bounded size, as the search is over a stated query set; a task
merges its tiles and returns k rows a query.

Cases: vectors that are null, empty, zero or hold null or non-finite components
take no part; a query meets vectors of its own length only; a query's own are
all rows with its id; repeated rows count as rows, and a repeated query is
answered each time; ties go to the smaller id; rows with a null id take no
part; fewer than k candidates give fewer rows; an empty table gives no rows;
other columns are ignored. A product beyond the range of doubles is infinite.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from demandcast.llm.common import map_arrow, pick, rows_in, Scratch

PROJECTIONS = 64
SHARE = 0.75  # of the directions, to be a candidate
FACTOR, LEAST = 20, 64  # candidates wanted: FACTOR * sqrt(vectors), LEAST in a chunk
FIRST_WIDTH, GROWTH, LEVELS = 0.01, 1.06, 200  # half-widths of the windows; the last is unbounded
FIRST_GUESS = 84  # level to begin with: about the width for unrelated vectors
CHUNK_ROWS, QUERY_ROWS = 4096, 256
SEED = 13

_INDEX = "dim int, n int, ids binary, vals binary, keys binary, ranks binary"
_ASKED = "dim int, n int, q_ids binary, q_vals binary, q_keys binary"


@lru_cache(8)
def directions(dim: int, count: int, seed: int = SEED) -> np.ndarray:
    """``count`` random directions of length sqrt(dim), in orthogonal groups."""
    made, rng = [], np.random.default_rng([seed, dim])
    while sum(m.shape[1] for m in made) < count:
        made.append(np.linalg.qr(rng.normal(size=(dim, min(dim, count))))[0])
    return np.concatenate(made, axis=1)[:, :count] * np.sqrt(dim)


def valid_vectors(df: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(_id, _vec, dim, norm) of the rows that take part."""
    vec = F.col("_vec")
    finite = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    peak = F.array_max(F.transform(vec, F.abs))
    scaled = F.sqrt(F.aggregate(vec, F.lit(0.0), lambda s, x: s + (x / F.col("peak")) * (x / F.col("peak"))))
    rows = pick(df, id_col, vec_col).toDF("_id", "_vec").select(F.col("_id").cast("long").alias("_id"), vec.cast("array<double>").alias("_vec"))
    good = rows.filter(F.col("_id").isNotNull() & vec.isNotNull() & (F.size(vec) > 0)).filter(finite).withColumn("peak", peak).filter("peak > 0")
    return good.select("_id", "_vec", F.size(vec).alias("dim"), F.least(F.col("peak") * scaled, F.lit(1.7e308)).alias("norm"))


def _packed(vectors: DataFrame, size: int, groups: int, projections: int, index: bool) -> DataFrame:
    """About ``size`` vectors (_id, _vec, dim, scale) of one length a row, with
    their projections: sorted, with the rank of each vector, for an index; plain
    for queries."""
    names = [("dim", pa.int32()), ("n", pa.int32()), ("ids", pa.binary()), ("vals", pa.binary()), ("keys", pa.binary())]
    schema = pa.schema(names + ([("ranks", pa.binary())] if index else []))

    def record(dim, ids, vals, scale):
        unit = vals / scale[:, None]
        lift = np.sqrt(np.maximum(0.0, 1.0 - (unit * unit).sum(axis=1))) if index else np.zeros(len(ids))
        keys = (np.column_stack([unit, lift]) @ directions(dim + 1, projections)).T.astype("<f4")
        blobs = [ids.astype("<i8"), vals.astype("<f8")]
        if index:
            blobs += sorted_arrays(keys)
        else:
            blobs.append(np.ascontiguousarray(keys.T))
        return pa.RecordBatch.from_arrays(
            [pa.array([dim], pa.int32()), pa.array([len(ids)], pa.int32())] + [pa.array([b.tobytes()], pa.binary()) for b in blobs], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, held = None, []

        def flush():
            ids, vals, scale = (np.concatenate(x) for x in zip(*held))
            held.clear()
            for at in range(0, len(ids), 2 * size):  # one id may stand in any number of rows
                yield record(place[0], ids[at:at + 2 * size], vals[at:at + 2 * size], scale[at:at + 2 * size])

        for batch in rows_in(batches, size):
            ids, dims, scale, part = (np.asarray(batch.column(i).to_numpy(zero_copy_only=False)) for i in (0, 2, 3, 4))
            flat = batch.column(1).flatten().to_numpy(zero_copy_only=False)
            ends = np.cumsum(dims)
            edges = np.flatnonzero((np.diff(dims) != 0) | (np.diff(part) != 0)) + 1
            for a, b in zip([0, *edges], [*edges, len(ids)]):
                if place != (dims[a], part[a]) or sum(len(h[0]) for h in held) >= 2 * size:
                    if held:
                        yield from flush()
                    place = int(dims[a]), int(part[a])
                held.append((ids[a:b], flat[ends[a] - dims[a]:ends[b - 1]].reshape(b - a, -1), scale[a:b]))
        if held:
            yield from flush()

    # dealt by a hash of the id: groups of about ``size``, whatever the number of partitions
    dealt = vectors.withColumn("part", F.pmod(F.xxhash64("_id"), F.lit(groups))).repartition("dim", "part").sortWithinPartitions("dim", "part")
    return map_arrow(dealt.select("_id", "_vec", "dim", "scale", "part"), run, _INDEX if index else _ASKED)


def sorted_arrays(keys: np.ndarray) -> list[np.ndarray]:
    """Each row of ``keys`` sorted, and the rank of each of its entries."""
    order = np.argsort(keys, axis=1, kind="stable")
    ranks = np.empty(order.shape, "<u2")
    np.put_along_axis(ranks, order, np.arange(order.shape[1], dtype="<u2")[None], axis=1)
    return [np.take_along_axis(keys, order, axis=1), ranks]


class Chunk:
    """The sorted arrays of a chunk, and windows over them."""

    def __init__(self, n: int, keys: bytes, ranks: bytes, threshold: int):
        self.n, self.threshold = n, threshold
        self.keys = np.frombuffer(keys, "<f4").reshape(-1, n)
        self.ranks = np.frombuffer(ranks, "<u2").reshape(-1, n)
        self.offset, self.inside = np.empty(self.ranks.shape, np.uint16), np.empty(self.ranks.shape, bool)

    def windows(self, centres: np.ndarray, width: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Begin and end of each query's window in each sorted array, from
        (queries x directions) centres and a half-width per query."""
        low, high = (centres - width[:, None]).T, (centres + width[:, None]).T
        begin = np.stack([np.searchsorted(k, x, "left") for k, x in zip(self.keys, low)], axis=1)
        end = np.stack([np.searchsorted(k, x, "right") for k, x in zip(self.keys, high)], axis=1)
        return begin, end

    def candidates(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Places of the vectors that lie in enough of the windows."""
        wide = end - begin
        np.subtract(self.ranks, begin.astype(np.uint16)[:, None], out=self.offset)  # wraps below the window's begin
        np.less(self.offset, np.minimum(wide, 0xFFFF).astype(np.uint16)[:, None], out=self.inside)
        return np.flatnonzero(np.add.reduce(self.inside, axis=0, dtype=np.uint16) >= self.threshold)

    def search(self, centres: np.ndarray, wanted: int, guess: int) -> tuple[list[np.ndarray], np.ndarray]:
        """Per query the candidates of its level, and the levels: the first
        with ``wanted`` candidates. Levels are tried from ``guess`` on in
        growing steps, then halved; all queries take a step together."""
        n = len(centres)
        short, enough = np.full(n, -1), np.full(n, LEVELS - 1)  # levels known to have too few, and enough
        found: list[np.ndarray] = [np.arange(self.n)] * n  # at the unbounded level
        level, step, open_ = np.full(n, min(guess, LEVELS - 2)), 1, np.arange(n)
        if wanted >= self.n:
            return found, enough
        while len(open_):
            begin, end = self.windows(centres[open_], WIDTHS[level[open_]])
            for row, q in enumerate(open_):
                some = self.candidates(begin[row], end[row])
                if len(some) >= wanted:
                    enough[q], found[q] = level[q], some
                else:
                    short[q] = level[q]
            open_ = open_[enough[open_] - short[open_] > 1]
            lo, hi = short[open_], enough[open_]
            half = (lo + hi) // 2
            level[open_] = np.where(hi == LEVELS - 1, np.minimum(lo + step, np.maximum(half, lo + 1)), np.where(lo < 0, np.maximum(hi - step, half), half))
            step *= 2
        return found, enough


WIDTHS = np.array([FIRST_WIDTH * GROWTH**i for i in range(LEVELS - 1)] + [np.inf], np.float32)
_HITS = pa.schema([("block", pa.int64()), ("row", pa.int32()), ("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])


def _threshold(projections: int) -> int:
    return max(1, int(np.ceil(SHARE * projections)))


class _Best:
    """The k best (vec_id, score) per query of the blocks a task meets."""

    def __init__(self, k: int):
        self.k = k
        self.held: dict[tuple[int, int], tuple[int, np.ndarray, np.ndarray]] = {}

    def add(self, block: int, row: int, query: int, ids: np.ndarray, score: np.ndarray) -> None:
        if (block, row) in self.held:
            _, old_ids, old_score = self.held[block, row]
            ids, score = np.concatenate([old_ids, ids]), np.concatenate([old_score, score])
        if len(ids) > self.k:
            line = np.partition(score, len(score) - self.k)[len(score) - self.k]
            ids, score = ids[score >= line], score[score >= line]
        best = np.lexsort((ids, -score))[:self.k]
        self.held[block, row] = query, ids[best], score[best]

    def take(self) -> Iterator[pa.RecordBatch]:
        rows = [(block, row, query, int(i), float(x)) for (block, row), (query, ids, score) in self.held.items() for i, x in zip(ids, score)]
        self.held.clear()
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _HITS)], schema=_HITS)


HELD_QUERIES = 50_000  # queries whose best a task holds before it passes them on


def _verified(tiles: DataFrame, projections: int, k: int) -> DataFrame:
    """(block, row, query_id, vec_id, score): the k nearest candidates of each
    query among the chunks a task meets."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        guess, best = FIRST_GUESS, _Best(k)
        for batch in rows_in(batches, 1):
            r = batch.to_pylist()[0]
            chunk = Chunk(r["n"], r["keys"], r["ranks"], _threshold(projections))
            ids, q_ids = np.frombuffer(r["ids"], "<i8"), np.frombuffer(r["q_ids"], "<i8")
            vals, q_vals = (np.frombuffer(r[c], "<f8").reshape(-1, r["dim"]) for c in ("vals", "q_vals"))
            found, levels = chunk.search(np.frombuffer(r["q_keys"], "<f4").reshape(-1, projections), max(r["least"], -(-r["wanted"] * r["n"] // r["total"])), guess)
            guess = int(np.median(levels))
            for q, some in enumerate(found):
                some = some[ids[some] != q_ids[q]]
                with np.errstate(over="ignore", invalid="ignore"):
                    score = np.nan_to_num((vals[some] * q_vals[q]).sum(axis=1), nan=-np.inf, posinf=np.inf, neginf=-np.inf)
                best.add(r["block"], q, int(q_ids[q]), ids[some], score)
            if len(best.held) > HELD_QUERIES:
                yield from best.take()
        yield from best.take()

    columns = ["block", "dim", "q_ids", "q_vals", "q_keys", "wanted", "least", "total", "n", "ids", "vals", "keys", "ranks"]
    return map_arrow(tiles.select(*columns), run, "block long, row int, query_id long, vec_id long, score double")


def nearest(vectors: DataFrame, queries: DataFrame, scratch: Scratch, k: int = 20, id_col: str = "vec_id", vec_col: str = "embedding",
            projections: int = PROJECTIONS, factor: float = FACTOR, least: int = LEAST, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """(query_id, rank, vec_id, score) of the k nearest other vectors found."""
    if not 0 < 2 * chunk_rows < 1 << 16:
        raise ValueError("a chunk holds 1 to 32767 vectors")
    base, wants = valid_vectors(vectors, id_col, vec_col), valid_vectors(queries, id_col, vec_col)
    # a row per vector length: D lengths take D * D / 2 components, so few
    sizes = scratch.write(base.groupBy("dim").agg(F.max("norm").alias("scale"), F.count(F.lit(1)).alias("total")), "sizes")
    chunks = max(1, -(-(sizes.agg(F.sum("total")).first()[0] or 0) // chunk_rows))
    blocks = max(1, -(-wants.count() // QUERY_ROWS))
    number = F.monotonically_increasing_id()
    scaled = base.join(F.broadcast(sizes.select("dim", "scale")), "dim")
    index = scratch.write(_packed(scaled, chunk_rows, chunks, projections, True).withColumn("chunk", number), "index")
    asked = _packed(wants.withColumnRenamed("norm", "scale"), QUERY_ROWS, blocks, projections, False)
    asked = scratch.write(asked.toDF("dim", "q_n", "q_ids", "q_vals", "q_keys").join(F.broadcast(sizes), "dim").select(
        number.alias("block"), "dim", "q_ids", "q_vals", "q_keys", "total", F.lit(max(k + 1, least)).cast("long").alias("least"),
        F.ceil(F.lit(float(factor)) * F.sqrt("total")).cast("long").alias("wanted")), "queries")

    # a tile for every chunk and query block of one length, on a grid: chunks
    # are dealt into columns and blocks into rows, a cell is a task's work. Rows
    # come first, as a query's best are merged over the cells of its row
    cells = 2 * vectors.sparkSession.sparkContext.defaultParallelism
    high = min(blocks, cells)
    wide = min(chunks, -(-cells // high))

    def dealt(df, number, own, own_n, other, other_n):
        every = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(other_n - 1).cast("long")))
        return df.withColumn(own, F.pmod(F.xxhash64(number), F.lit(own_n))).withColumn(other, every)

    tiles = dealt(asked, "block", "high", high, "wide", wide).join(dealt(index, "chunk", "wide", wide, "high", high).drop("chunk"), ["dim", "high", "wide"])
    order = Window.partitionBy("block", "row").orderBy(F.desc("score"), "vec_id")
    return _verified(tiles, projections, k).withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select(
        "query_id", F.col("rank").cast(T.IntegerType()).alias("rank"), "vec_id", "score")
