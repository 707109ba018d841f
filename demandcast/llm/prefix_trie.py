"""Prefix trie of conversations by whole-sequence collapse.

1. Identical conversations collapse into one weighted sequence: its smallest
   conversation represents it, its weight counts the members, and its end list
   (their ids, ascending) is digested as a stream.
2. A sequence that is no proper prefix of another (anti-join) is a leaf.
3. Every prefix of a sequence, weighted, meets the equal prefixes of the
   others in one aggregate; each group is a node of the trie. A node is owned
   by the sequence of its smallest member, so (smallest member, depth) names
   it, and parents, children and subtree sums follow from unique keys.

Equal prefixes are found by an additive hash: the sum, over the turns so far,
of 120 bits of SHA-256 of (position, role, text). A sum has no order, so the
prefixes of a long conversation are computed in chunks of its turns, side by
side; no step takes a whole conversation, or a whole node, in one task. The
one exception is the digest of an end list, which is a single stream by its
definition and holds one row at a time. Texts are hashed where they are read
and never shuffled.

Cases: turns are taken by turn (null first), ties by the digest of role and
text; repeated rows are turns of their own; null role or text is empty; rows
with a null conversation id take no part; a conversation without turns ends at
the root; an empty table has no node, not even a root; very long texts are
hashed whole; other columns, whatever their names, are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from demandcast.llm.common import map_arrow, pick, rows_in, Scratch

CHUNK = 4096  # turns of a conversation that are summed in one task
HOT_SHARE = 1000  # a node of more than 1/1000 of all rows is hot: there are fewer than 1000
EMPTY_SHA256 = hashlib.sha256(b"").hexdigest()
ROOT = hashlib.sha256(b"0:0:0").digest()[:16]  # the prefix without turns
_HASHES = ("h1", "h2")


def hashed_turns(df: DataFrame) -> DataFrame:
    """(conv_id, turn, key, bytes): role and text as a digest, and the UTF-8
    length of the text."""
    role, text = F.coalesce(F.col("role").cast("string"), F.lit("")), F.coalesce(F.col("text").cast("string"), F.lit(""))
    whole = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    return pick(df, "conv_id", "turn", "role", "text").filter("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.unhex(F.sha2(whole, 256)).alias("key"), F.octet_length(text).cast("long").alias("bytes"))


def positions(turns: DataFrame, scratch: Scratch) -> DataFrame:
    """``turns`` with ``pos``, from 1, by (turn, key) within a conversation.

    The rows are range-partitioned by conversation and turn, so a long
    conversation spreads over tasks; the turns of a conversation that stand in
    earlier partitions are counted per partition and added."""
    order = ["conv_id", "turn", "key"]
    placed = turns.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("part", F.spark_partition_id())
    placed = scratch.write(placed, "placed")
    counts = placed.groupBy("conv_id", "part").agg(F.count(F.lit(1)).alias("n"))
    ahead = counts.select("conv_id", "part", (F.sum("n").over(Window.partitionBy("conv_id").orderBy("part")) - F.col("n")).alias("ahead"))
    within = F.row_number().over(Window.partitionBy("conv_id", "part").orderBy("turn", "key"))
    return placed.join(ahead, ["conv_id", "part"]).select("conv_id", (F.col("ahead") + within).alias("pos"), "key", "bytes")


def _chunk(c: Column) -> Column:
    return F.floor(c / CHUNK).cast("long")


def per_chunk(df: DataFrame, length: str) -> DataFrame:
    """A row of ``df`` for every chunk of positions 0..length: a join on (id,
    chunk) then meets at most ``CHUNK`` rows of a conversation per key."""
    return df.withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), _chunk(F.col(length)))))


def running(rows: DataFrame, key: str, values: list[str]) -> DataFrame:
    """``rows`` with, per value v, ``through_v``, its sum up to and with the
    row's position, and ``all_v``, its sum over the whole key."""
    rows = rows.withColumn("chunk", _chunk(F.col("pos")))
    totals = rows.groupBy(key, "chunk").agg(*[F.sum(v).alias(f"_s_{v}") for v in values])
    so_far, whole = Window.partitionBy(key).orderBy("chunk"), Window.partitionBy(key)
    ahead = totals.select(key, "chunk", *[(F.sum(f"_s_{v}").over(so_far) - F.col(f"_s_{v}")).alias(f"_a_{v}") for v in values],
                          *[F.sum(f"_s_{v}").over(whole).alias(f"all_{v}") for v in values])
    inside = Window.partitionBy(key, "chunk").orderBy("pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    joined = rows.join(ahead, [key, "chunk"])
    return joined.select(*rows.columns, *[f"all_{v}" for v in values],
                         *[(F.col(f"_a_{v}") + F.sum(v).over(inside)).alias(f"through_{v}") for v in values])


def rebuild(turns: DataFrame, ids: DataFrame, group: int = 5, heads: int = 9) -> tuple[DataFrame, DataFrame]:
    """Conversations that share beginnings: conversation c gets the first
    h = crc32(decimal c) % heads turns of conversation c - c % group, then its
    own turns after its first h. ``turns`` as of :func:`positions`; ``ids``
    are all conversations with their numbers of turns (conv_id, n)."""
    c = F.col("conv_id")
    wants = ids.select("conv_id", "n", (c - c % group).alias("base"), F.pmod(F.crc32(c.cast("string").cast("binary")), F.lit(heads)).alias("h"))
    begin = turns.filter((c % group == 0) & (F.col("pos") < heads)).withColumnRenamed("conv_id", "base")
    known = begin.groupBy("base").agg(F.max("pos").alias("n_base"))
    wants = wants.join(known, "base", "left").withColumn("given", F.least("h", F.coalesce("n_base", F.lit(0))).cast("long")).drop("n_base")
    first = wants.join(begin, "base").filter("pos <= h").select("conv_id", "pos", "key", "bytes")
    spread = per_chunk(wants.select("conv_id", "n", "h", "given"), "n").drop("n")
    own = turns.withColumn("chunk", _chunk(F.col("pos"))).join(spread, ["conv_id", "chunk"]).filter("pos > h").select(
        "conv_id", (F.col("pos") - F.col("h") + F.col("given")).alias("pos"), "key", "bytes")
    return first.unionByName(own), ids.select("conv_id")


def _prefixes(turns: DataFrame) -> DataFrame:
    """(conv_id, pos, bytes, node): each turn with the hash of its prefix."""
    digest = F.sha2(F.concat(F.concat(F.col("pos").cast("string"), F.lit(":")).cast("binary"), F.col("key")), 256)
    part = [F.conv(F.substring(digest, 1 + 15 * i, 15), 16, 10).cast("decimal(28,0)").alias(h) for i, h in enumerate(_HASHES)]
    summed = running(turns.select("conv_id", "pos", "bytes", *part), "conv_id", list(_HASHES))
    return summed.select("conv_id", "pos", "bytes", _node("pos", *[f"through_{h}" for h in _HASHES]))


def _node(*parts: str) -> Column:
    text = F.concat_ws(":", *[F.col(p).cast("string") for p in parts])
    return F.unhex(F.substring(F.sha2(text, 256), 1, 32)).alias("node")


def _collapsed(ends: DataFrame) -> DataFrame:
    """(node, n, rep, weight, ends_sha256) of every distinct sequence, from
    (conv_id, n, node): its members stream by in ascending order."""
    schema = pa.schema([("node", pa.binary()), ("n", pa.int64()), ("rep", pa.int64()), ("weight", pa.int64()), ("ends_sha256", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_row, digest, rows = None, None, []

        def taken():
            batch = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
            rows.clear()
            return batch

        for batch in rows_in(batches, 4096):
            for conv, n, node in zip(*[c.to_pylist() for c in batch.columns]):
                if open_row is not None and open_row[0] == node:
                    digest.update(b",%d" % conv)
                    open_row[3] += 1
                    continue
                if open_row is not None:
                    rows.append((*open_row, digest.hexdigest()))
                open_row, digest = [node, n, conv, 1], hashlib.sha256(b"%d" % conv)
            if rows:
                yield taken()
        if open_row is not None:
            rows.append((*open_row, digest.hexdigest()))
            yield taken()

    dealt = ends.select("conv_id", "n", "node").repartition("node").sortWithinPartitions("node", "conv_id")
    return map_arrow(dealt, run, "node binary, n long, rep long, weight long, ends_sha256 string")


def _with_nodes(rows: DataFrame, nodes: DataFrame, columns: list[str]) -> DataFrame:
    """``rows`` with ``columns`` of their node. Nodes that hold more than a
    thousandth of all rows, of which there are fewer than a thousand, are
    broadcast; every other node is a small group of a shuffle join."""
    total = nodes.agg(F.sum("n_rows")).scalar()
    hot = F.broadcast(nodes.filter(F.col("n_rows") * HOT_SHARE > total).select("node", *columns))
    cold = nodes.filter(F.col("n_rows") * HOT_SHARE <= total).select("node", *columns)
    rest = rows.join(hot.select("node"), "node", "left_anti")
    return rows.join(hot, "node").unionByName(rest.join(cold, "node"))


def trie(turns: DataFrame, ids: DataFrame, scratch: Scratch) -> DataFrame:
    """Nodes (conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256) of the conversations ``ids`` (conv_id, once
    each) with ``turns`` (conv_id, pos from 1 without gaps, key, bytes)."""
    root = F.lit(ROOT)
    prefixes = scratch.write(_prefixes(turns), "prefixes")
    last = prefixes.groupBy("conv_id").agg(F.max_by("node", "pos").alias("node"), F.max("pos").alias("n"))
    ends = ids.join(last, "conv_id", "left").select("conv_id", F.coalesce("n", F.lit(0).cast("long")).alias("n"), F.coalesce("node", root).alias("node"))
    classes = scratch.write(_collapsed(ends), "classes")

    # the rows of the representatives, and a root row for each
    spread = per_chunk(classes.select("rep", "n", "weight"), "n")
    own = prefixes.withColumnRenamed("conv_id", "rep").withColumn("chunk", _chunk(F.col("pos"))).join(spread, ["rep", "chunk"])
    starts = classes.select("rep", F.lit(0).cast("long").alias("pos"), F.lit(0).cast("long").alias("bytes"), root.alias("node"), "n", "weight")
    rows = scratch.write(own.select(*starts.columns).unionByName(starts), "rows")

    inner = rows.filter("pos < n").select("node").distinct()
    leaves = classes.join(inner, "node", "left_anti").select("node", F.lit(1).alias("leaf"))
    counted = per_chunk(classes.join(leaves, "node", "left").select("rep", "n", F.coalesce("leaf", F.lit(0)).alias("leaf")), "n").drop("n")
    weighted = rows.withColumn("chunk", _chunk(F.col("pos"))).join(counted, ["rep", "chunk"])
    nodes = scratch.write(weighted.groupBy("node", F.col("pos").alias("depth"), "bytes").agg(
        F.min("rep").alias("owner"), F.sum("weight").alias("n_convs"), F.sum("leaf").cast("long").alias("n_leaves"), F.count(F.lit(1)).alias("n_rows")), "nodes")

    # each row with its node's owner; the owner's row carries what the node saves
    saving = (F.col("n_convs") - 1) * F.col("bytes")
    joined = _with_nodes(rows.select("rep", "pos", "node"), nodes.select("node", "n_rows", "owner", saving.alias("saves")), ["owner", "saves"])
    owned = scratch.write(joined.select("rep", "pos", "owner", F.when(F.col("rep") == F.col("owner"), F.col("saves")).otherwise(F.lit(0).cast("long")).alias("saves")), "owned")
    summed = running(owned, "rep", ["saves"])
    below = summed.select("owner", F.col("pos").alias("depth"), (F.col("all_saves") - F.col("through_saves") + F.col("saves")).alias("below"))
    saved = below.groupBy("owner", "depth").agg(F.sum("below").alias("saved_tokens"))

    above = owned.select(F.col("rep").alias("owner"), (F.col("pos") + 1).alias("depth"), F.col("owner").alias("parent"))
    named = nodes.join(above, ["owner", "depth"], "left")
    children = named.filter("parent is not null").groupBy(F.col("parent").alias("owner"), (F.col("depth") - 1).alias("depth")).agg(F.count(F.lit(1)).alias("n_children"))
    full = named.join(children, ["owner", "depth"], "left").join(saved, ["owner", "depth"]).join(classes.select("node", "ends_sha256"), "node", "left")
    return full.select(
        F.col("owner").alias("conv_id"), "depth", F.col("parent").alias("parent_conv_id"), "n_convs",
        F.coalesce("n_children", F.lit(0).cast("long")).alias("n_children"), "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(EMPTY_SHA256)).alias("ends_sha256"))


def conversations(df: DataFrame, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """(turns, ids) of a conversations table, as :func:`trie` takes them; ids
    carry the number of turns."""
    turns = scratch.write(positions(hashed_turns(df), scratch), "turns")
    return turns, scratch.write(turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n")), "ids")
