"""Mixing sources to target weights by Poisson replication.

A source of size n and target share w of a corpus of size T is repeated at
the mean rate r = w * T / n. Every document draws its number of copies from
Poisson(r) by inverting the distribution at a uniform number hashed from
(seed, document id), so the draw of a document depends on nothing but its id,
its source's rate and the seed. Documents are exploded by their counts and
dealt out globally by a hash of (seed, id, copy).

The distribution is tabulated once per source, by running sums over its steps,
to an array as long as the rate; a document scans it once and is written that
many times. The corpus joins the arrays by a broadcast when their counted
entries are within ``broadcast_max_rows``, else by a shuffle join that AQE
splits at a hot source.

Cases: a null source is a source of its own; a null id draws as the empty id;
rows with one id draw alike, so repeated rows are repeated alike; a source
with target weight 0 or without a target goes; an empty table stays empty;
an added column whose name the input has, in whatever case, gets underscores
until it is new; very long texts are moved and never read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from demandcast.llm.common import Scratch, keep_row, pick
from demandcast.session import broadcast_max_rows

UNIFORM_BITS = 52  # hex digits 1 to 13 of an MD5
TAIL = 12  # standard deviations of the table of probabilities
SEED = "mix-1"


def uniform(seed: str, *parts: Column) -> Column:
    """A number of [0, 1) hashed from the seed and the parts."""
    text = F.concat_ws(":", F.lit(seed), *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])
    return F.conv(F.substring(F.md5(text), 1, UNIFORM_BITS // 4), 16, 10).cast("long") / F.lit(float(1 << UNIFORM_BITS))


def poisson_tables(rates: DataFrame) -> DataFrame:
    """(_source, _cdf) of (_source, _rate): P(X <= k) for k = 0, 1, ... far into
    the tail, summed from logarithms."""
    last = F.ceil(F.col("_rate") + F.lit(TAIL) * F.sqrt("_rate") + F.lit(20)).cast("int")
    steps = rates.select("_source", "_rate", F.explode(F.sequence(F.lit(0), last)).alias("_k"))
    upto = Window.partitionBy("_source").orderBy("_k").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    factor = F.when(F.col("_k") == 0, -F.col("_rate")).otherwise(F.log("_rate") - F.log(F.col("_k").cast("double")))
    summed = steps.withColumn("_log_p", F.sum(factor).over(upto)).withColumn("_upto", F.sum(F.exp("_log_p")).over(upto))
    return summed.groupBy("_source").agg(F.sort_array(F.collect_list("_upto")).alias("_cdf"))


def _new_name(name: str | None, columns: list[str]) -> str | None:
    taken = {c.lower() for c in columns}
    while name and name.lower() in taken:
        name += "_"
    return name


def square_root_targets(sizes: DataFrame) -> DataFrame:
    """Default targets: weights in proportion to the square root of a source's
    size, which lifts small sources and holds the corpus size."""
    return sizes.select("_source", F.sqrt(F.col("_n").cast("double")).alias("_weight"))


def source_rates(docs: DataFrame, scratch: Scratch, targets: DataFrame | None = None, total: float | None = None,
                 source_col: str = "source") -> DataFrame:
    """(_source, _n, _rate) per source; ``targets`` is (source, weight), weights
    of any positive sum; ``total`` the wanted number of documents (as now)."""
    sizes = scratch.write(pick(docs, source_col).toDF("_source").groupBy("_source").agg(F.count(F.lit(1)).alias("_n")), "sizes")
    wanted = square_root_targets(sizes) if targets is None else targets.toDF("_source", "_weight")
    found = sizes.alias("s").join(wanted.alias("w"), F.col("s._source").eqNullSafe(F.col("w._source"))).select(
        "s._source", "s._n", F.col("w._weight").cast("double").alias("_weight"))
    sums = found.agg(F.sum("_weight").alias("w")).first()["w"] or 0.0
    size = total if total is not None else (sizes.agg(F.sum("_n").alias("n")).first()["n"] or 0)
    if sums <= 0:
        return scratch.write(found.filter(F.lit(False)).select("_source", "_n", F.lit(0.0).alias("_rate")), "rates")
    rate = F.col("_weight") / F.lit(float(sums)) * F.lit(float(size)) / F.col("_n")
    return scratch.write(found.withColumn("_rate", rate).filter("_rate > 0").select("_source", "_n", "_rate"), "rates")


def mix(docs: DataFrame, scratch: Scratch, targets: DataFrame | None = None, total: float | None = None, seed: str = SEED,
        id_col: str = "doc_id", source_col: str = "source", copy_col: str | None = "copy", key_col: str | None = "shuffle_key") -> DataFrame:
    """The documents, each repeated by its Poisson count, dealt out globally.

    Adds ``copy_col`` (1, 2, ...) and ``key_col`` (the hash that orders the
    result within its partitions) unless they are None.
    """
    copy_col = _new_name(copy_col, docs.columns)
    key_col = _new_name(key_col, [*docs.columns, copy_col or ""])
    rates = scratch.write(poisson_tables(source_rates(docs, scratch, targets, total, source_col)), "tables")
    if (rates.agg(F.sum(F.size("_cdf")).alias("n")).first()["n"] or 0) <= broadcast_max_rows(docs.sparkSession):
        rates = F.broadcast(rates)
    packed = keep_row(docs, id_col, source_col).toDF("_row", "_id", "_from")
    u = uniform(seed, F.col("_id"))
    copies = F.size(F.filter("_cdf", lambda c: c <= F.col("_u")))
    drawn = (
        packed.withColumn("_u", u)
        .join(rates, F.col("_from").eqNullSafe(F.col("_source")))
        .withColumn("_copies", copies).filter("_copies > 0")
        .select("_row", "_id", F.explode(F.sequence(F.lit(1), F.col("_copies"))).alias("_copy"))
        .withColumn("_key", F.md5(F.concat_ws(":", F.lit(seed), F.coalesce(F.col("_id").cast("string"), F.lit("")), F.col("_copy").cast("string"))))
    )
    dealt = drawn.repartition("_key").sortWithinPartitions("_key")
    extra = [F.col(c).alias(n) for c, n in (("_copy", copy_col), ("_key", key_col)) if n]
    columns = [F.col("_row")[f"_c{i}"] for i in range(len(docs.columns))]
    return dealt.select(*columns, *extra).toDF(*docs.columns, *[n for n in (copy_col, key_col) if n])

