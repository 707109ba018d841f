"""SimHash near-duplicate groups by a byte-position inverted index.

A fingerprint is eight bytes at eight positions. Two fingerprints that differ
in at most d bits differ in at most d bytes, so they share at least 8 - d
positional bytes: the guaranteed minimum.

* Fingerprints are made distinct first, so copies of any number are one entry.
* Index. A posting list holds the fingerprints with the same bytes at a set of
  positions. Lists of one position hold 1/256 of all fingerprints each; a list
  of over ``paired`` members is heavy and is split by each further position.
  Sizes at which even lists would hold over ``LOAD`` members on average are
  passed over, since they would be split anyway.
* Count. A list that is not heavy gives its pairs, each with the positions of
  the list. Gathered per pair, they are the positions its two members share; at
  8 - d or more the pair is retained, below it goes. Splitting keeps the count
  whole: every shared position stands in a list that is not heavy, or in a
  heavy one of 8 - d positions, which both members are in.
* Verify by the bit distance.
* Heavy lists of 8 - d positions are not split further, as their members may
  differ in all other bytes. Their pairs have met the minimum by being there. A
  pair within d bits has a point within d // 2 bits of one and d - d // 2 of
  the other: members name these points, and all that name a point are linked to
  the smallest of those within d // 2 bits of it. These links are true links,
  connect every pair within the distance, and grow in proportion to the list
  (17 rows a member for two bits), so no list is capped.

Groups are the connected components over links (see ``components``).

Cases: a null or empty text has fingerprint 0, linked like any other; fewer
words than a shingle make one shingle of them all; a very long text is hashed
in pieces; rows that share an id are judged one by one and share the group's
smallest id; a group without any id has a null id; an empty table gives an
empty result. ``one_of_each`` keeps one row of a group: that of the smallest
id, of several such rows the one of smallest fingerprint, then text, then row.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandcast.llm.common import keep_row, map_arrow, pick, python_bytes, rows_in, Scratch, unpack_row
from demandcast.llm.components import components

SHINGLE = 3
DISTANCE = 2
HASH_SEED = 42
BYTES = 8
PAIRED = 32  # longer lists are heavy
LOAD = 1 / 8  # members of an even list; beyond it lists of one more position
PIECE = 1 << 16  # shingles hashed at a time


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """SimHash of the word shingles of a text, as an unsigned number."""
    words = text.lower().split()  # bytes: A-Z only, split at ASCII spaces
    if not words:
        return 0
    if len(words) < shingle:
        return xxhash.xxh64_intdigest(b" ".join(words), HASH_SEED)
    line = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = [0, *(ends[:-1] + 1).tolist()]
    ends = ends[shingle - 1:].tolist()
    set_bits = np.zeros(8 * BYTES, np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, len(ends), PIECE):
        hashes = np.array([digest(line[a:b], HASH_SEED) for a, b in zip(starts[at:at + PIECE], ends[at:at + PIECE])], "<u8")
        set_bits += np.unpackbits(hashes.view(np.uint8).reshape(-1, BYTES), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(set_bits * 2 > len(ends), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fp long) per row; fp is the fingerprint as a signed number."""
    source = pick(docs, id_col, text_col).select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows_in(batches, 1024):
            fps = np.array([fingerprint(t, shingle) for t in python_bytes(batch.column(1))], np.uint64).astype(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps)], names=["doc_id", "fp"])

    return map_arrow(source, run, "doc_id long, fp long")


def _signed(value: int) -> int:
    return value - (1 << 64) if value >= 1 << 63 else value


def _first_size(n: int, shared: int) -> int:
    """Positions of the lists that indexing begins with."""
    size = 1
    while size < shared and n > LOAD * 256**size:
        size += 1
    return size


def _bits(positions: tuple[int, ...]) -> int:
    return sum(1 << p for p in positions)


def _keyed(entries: DataFrame) -> DataFrame:
    """(set, key, fp) of (set, fp): the bytes at the positions of ``set``."""
    held = [F.when(F.col("set").bitwiseAND(F.lit(1 << p)) != 0, F.lit(_signed(0xFF << 8 * p)).cast("long")).otherwise(F.lit(0).cast("long"))
            for p in range(BYTES)]
    return entries.select("set", F.col("fp").bitwiseAND(reduce(lambda x, y: x.bitwiseOR(y), held)).alias("key"), "fp")


def meetings(distinct: DataFrame, scratch: Scratch, shared: int, paired: int = PAIRED) -> tuple[DataFrame, DataFrame]:
    """((a, b, set) per meeting of a pair in a list that is not heavy,
    (set, key, fp) of the heavy lists of ``shared`` positions)."""
    size = _first_size(distinct.count(), shared)
    sets = F.array(*[F.lit(_bits(s)) for s in combinations(range(BYTES), size)])
    entries = distinct.select(F.explode(sets).alias("set"), "fp")
    met = []
    while True:
        # dealt once: the lists are counted and their members taken from the same
        # exchange. Fingerprints are distinct, so a list of two has a < b; the
        # condition keeps both readers on the same columns
        index = _keyed(entries).repartition("set", "key")
        lists = index.groupBy("set", "key").agg(F.count(F.lit(1)).alias("n"), F.min("fp").alias("a"), F.max("fp").alias("b")).filter("a < b")
        members = scratch.write(index.join(lists.select("set", "key", "n"), ["set", "key"]), "members")
        short, heavy = members.filter(F.col("n") <= paired), members.filter(F.col("n") > paired)
        other = short.select("set", "key", F.col("fp").alias("b"))
        met.append(short.select("set", "key", F.col("fp").alias("a")).join(other, ["set", "key"]).filter("a < b").select("a", "b", "set"))
        if size == shared or heavy.isEmpty():
            return reduce(DataFrame.union, met), heavy.select("set", "key", "fp")
        wider = F.filter(F.array(*[F.col("set").bitwiseOR(F.lit(1 << p)) for p in range(BYTES)]), lambda s: s != F.col("set"))
        entries = scratch.write(heavy.select(F.explode(wider).alias("set"), "fp").distinct(), "split")
        size += 1


def tally(met: DataFrame) -> DataFrame:
    """(a, b, tally): positions at which the members of a pair share a byte."""
    return met.groupBy("a", "b").agg(F.bit_count(F.bit_or("set")).alias("tally"))


def links(distinct: DataFrame, scratch: Scratch, distance: int = DISTANCE, paired: int = PAIRED) -> DataFrame:
    """True links (a, b) between distinct fingerprints ``fp`` that connect all
    pairs within ``distance`` bits (0 to 7)."""
    if not 0 <= distance < BYTES:
        raise ValueError(f"distance must be 0 to {BYTES - 1} bits")
    shared = BYTES - distance
    met, heavy = meetings(distinct, scratch, shared, paired)
    retained = tally(met).filter(F.col("tally") >= shared)
    verified = retained.filter(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= distance).select("a", "b")
    return verified.union(_point_links(heavy, distance)).distinct()


def _point_links(members: DataFrame, distance: int) -> DataFrame:
    """Links of heavy lists: members to the smallest near member of each point
    they name. The table of flips depends on the distance alone (476 rows for
    two bits)."""
    near, far = distance // 2, distance - distance // 2
    flips = []
    for held in combinations(range(BYTES), BYTES - distance):
        free = [8 * p + b for p in range(BYTES) if p not in held for b in range(8)]
        flips += [(_bits(held), _signed(_bits(bits)), n <= near) for n in range(far + 1) for bits in combinations(free, n)]
    table = members.sparkSession.createDataFrame(flips, "set int, flip long, near boolean")
    named = members.select("set", "fp").join(F.broadcast(table), "set").select("fp", F.col("fp").bitwiseXOR(F.col("flip")).alias("point"), "near")
    least = named.groupBy("point").agg(F.min(F.when(F.col("near"), F.col("fp"))).alias("b"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    return named.join(least, "point").filter("fp <> b").select(F.col("fp").alias("a"), "b")


def groups(docs: DataFrame, scratch: Scratch, shingle: int = SHINGLE, distance: int = DISTANCE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fp, root, component_id) per row of ``docs``; root is the
    smallest fingerprint of the group, component_id its smallest id."""
    found = scratch.write(fingerprints(docs, shingle, id_col, text_col), "fingerprints")
    distinct = scratch.write(found.groupBy("fp").agg(F.min("doc_id").alias("first")), "distinct")
    roots = components(links(distinct.select("fp"), scratch, distance), scratch)
    rooted = scratch.write(distinct.join(roots, F.col("fp") == F.col("node"), "left").select("fp", "first", F.coalesce("root", "fp").alias("root")), "rooted")
    named = scratch.write(rooted.groupBy("root").agg(F.min("first").alias("component_id")), "named")
    labels = scratch.write(rooted.select("fp", "root").join(named, "root"), "labels")
    return found.join(labels, "fp").select("doc_id", "fp", "root", "component_id")


def hex_fingerprint(name: str = "fp"):
    return F.lpad(F.lower(F.hex(F.col(name))), 16, "0")


def one_of_each(docs: DataFrame, scratch: Scratch, shingle: int = SHINGLE, distance: int = DISTANCE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` with one row of each group."""
    found = scratch.write(groups(docs, scratch, shingle, distance, id_col, text_col), "groups")
    winners = found.filter(F.col("doc_id").eqNullSafe(F.col("component_id"))).groupBy("root").agg(F.min(F.struct("doc_id", "fp")).alias("w"))
    winners = scratch.write(winners.select("root", "w.doc_id", "w.fp"), "winners")
    # ids of several rows, or none: their rows are told apart by fingerprint
    shared = scratch.write(found.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1 or doc_id is null").select("doc_id"), "shared")
    packed = keep_row(docs, id_col, text_col).select("_row", F.col(id_col).cast("long").alias("_id"), F.col(text_col).alias("_text"))
    some = not shared.isEmpty()
    alone = winners.filter("doc_id is not null")
    if some:
        alone = alone.join(shared, "doc_id", "left_anti")
    kept = packed.join(alone.select("doc_id"), F.col("_id") == F.col("doc_id"), "left_semi").select("_row")
    if some:
        rows = packed.join(shared, F.col("_id").eqNullSafe(F.col("doc_id")), "left_semi")
        told = _with_fingerprint(rows, shingle)
        picked = told.join(winners.select("doc_id", F.col("fp").alias("_won"), "root"), F.col("_id").eqNullSafe(F.col("doc_id")) & (F.col("_fp") == F.col("_won")))
        first = F.min_by("_row", F.struct("_text", F.to_json("_row")))
        kept = kept.union(picked.groupBy("root").agg(first.alias("_row")).select("_row"))
    return unpack_row(kept, docs.columns)


def _with_fingerprint(rows: DataFrame, shingle: int) -> DataFrame:
    from pyspark.sql.functions import pandas_udf

    @pandas_udf("long")
    def fp(texts):
        import pandas as pd

        values = [fingerprint((t or "").encode(), shingle) for t in texts]
        return pd.Series(np.array(values, np.uint64).astype(np.int64))

    return rows.withColumn("_fp", fp(F.coalesce(F.col("_text").cast("string"), F.lit(""))))
