"""Adapters from the TPC-H-style test tables to the pipeline's inputs.

The test environment has no credit/panel files, so they are derived from
the star schema with plain joins and projections (the same mapping is
written in SQL for the DuckDB oracle, see ``demandcast.plans.oracle``):

* credit: one row per lineitem. txn_id = order key (repeats across lines,
  so the distinct count is meaningful), customer 'C' || o_custkey,
  txn_date = order date, sku = part key, region = supplier's region,
  amount / price as exact cents, quantity as bigint.
* panel: one row per customer, without a customer id where the account
  balance is negative (so some transactions stay unlinked). age_group =
  market segment, region = customer's region, income_bin from the account balance, household_size
  = 1 + region key.
* marginals: order counts per customer region and per segment (consistent
  totals: both sum to the number of orders).

nation (25 rows) and region (5 rows) have a size fixed by the schema and
are broadcast explicitly. Every other dimension (orders, part, supplier,
customer) grows with the scale factor: it is broadcast only when its row
count, read from Parquet metadata, is under ``broadcast_max_rows(spark)``;
beyond that the join stays a shuffle (sort-merge) join, with AQE splitting
skewed partitions. Without the check Catalyst sizes a join by the product
of its inputs, so a dimension built by a join is never broadcast
statically and the large side is shuffled before AQE can switch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from demandcast.session import broadcast_max_rows

# The fact table drives per-row work (hashing, joins); the dimensions are
# broadcast or shuffled anyway and gain nothing from being spread. It is
# spread by hash of its join key: deterministic without the local sort a
# round-robin repartition needs, and measured faster.
SPREAD_TABLES = {"lineitem": "l_orderkey"}

_I, _L, _D, _S, _TS = T.IntegerType(), T.LongType(), T.DoubleType(), T.StringType(), T.TimestampNTZType()


def _schema(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in fields])


# The declared layout of the test tables (declaring it skips a
# schema-inference job per scan).
TABLE_SCHEMAS = {
    "region": _schema(("r_regionkey", _I), ("r_name", _S)),
    "nation": _schema(("n_nationkey", _I), ("n_name", _S), ("n_regionkey", _I)),
    "customer": _schema(("c_custkey", _L), ("c_name", _S), ("c_nationkey", _I), ("c_acctbal", _D),
                        ("c_mktsegment", _S)),
    "supplier": _schema(("s_suppkey", _L), ("s_name", _S), ("s_nationkey", _I), ("s_acctbal", _D)),
    "part": _schema(("p_partkey", _L), ("p_name", _S), ("p_brand", _S), ("p_type", _S), ("p_size", _I),
                    ("p_retailprice", _D)),
    "orders": _schema(("o_orderkey", _L), ("o_custkey", _L), ("o_orderstatus", _S), ("o_totalprice", _D),
                      ("o_orderdate", _TS), ("o_orderpriority", _S)),
    "lineitem": _schema(("l_orderkey", _L), ("l_partkey", _L), ("l_suppkey", _L), ("l_linenumber", _I),
                        ("l_quantity", _D), ("l_extendedprice", _D), ("l_discount", _D), ("l_tax", _D),
                        ("l_returnflag", _S), ("l_linestatus", _S), ("l_shipdate", _TS)),
}

def row_count(spark: SparkSession, sf_dir: str, name: str) -> int:
    """Rows of a test table, from Parquet footers (reads no column)."""
    return scan(spark, sf_dir, name).count()


ROWS_A_TASK = 250_000


def tasks_for(spark: SparkSession, rows: int) -> int:
    """Tasks for ``rows`` rows: a task's memory stays the same as they grow."""
    return max(spark.sparkContext.defaultParallelism, -(-rows // ROWS_A_TASK))


def broadcast_if_small(df: DataFrame, rows: int, max_rows: int | None = None) -> DataFrame:
    """Broadcast hint only behind a size check; otherwise leave the join to
    a shuffle join."""
    limit = broadcast_max_rows(df.sparkSession) if max_rows is None else max_rows
    return F.broadcast(df) if 0 <= rows <= limit else df


def scan(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    reader = spark.read
    if name in TABLE_SCHEMAS:
        reader = reader.schema(TABLE_SCHEMAS[name])
    return reader.parquet(f"{sf_dir}/{name}.parquet")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Scan one table. A fact-table scan that yields fewer input partitions
    than the session has task slots (a single-row-group file) is spread by
    hash of its key, so the joins and hashing after it use every core; a
    table stored as many files already has more splits than slots and is
    left alone."""
    df = scan(spark, sf_dir, name)
    if name not in SPREAD_TABLES:
        return df
    slots = spark.sparkContext.defaultParallelism
    return df.repartition(slots, SPREAD_TABLES[name]) if df.rdd.getNumPartitions() < slots else df


def _nation_region(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    return nation.join(F.broadcast(region), nation.n_regionkey == region.r_regionkey).select(
        "n_nationkey", "n_regionkey", "r_name"
    )


def credit_from_tpch(spark: SparkSession, sf_dir: str) -> DataFrame:
    lineitem = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"
    )
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_retailprice")
    supplier = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    supplier_region = supplier.join(
        F.broadcast(_nation_region(spark, sf_dir)), supplier.s_nationkey == F.col("n_nationkey")
    ).select("s_suppkey", "r_name")
    orders = broadcast_if_small(orders, row_count(spark, sf_dir, "orders"))
    part = broadcast_if_small(part, row_count(spark, sf_dir, "part"))
    supplier_region = broadcast_if_small(supplier_region, row_count(spark, sf_dir, "supplier"))
    return (
        lineitem.join(orders, lineitem.l_orderkey == orders.o_orderkey)
        .join(part, lineitem.l_partkey == part.p_partkey)
        .join(supplier_region, lineitem.l_suppkey == supplier_region.s_suppkey)
        .select(
            F.col("l_orderkey").alias("txn_id"),
            F.concat(F.lit("C"), F.col("o_custkey").cast("string")).alias("customer_id"),
            F.col("o_orderdate").cast("timestamp_ntz").alias("txn_date"),
            F.concat(F.lit("S"), F.col("p_partkey").cast("string")).alias("sku"),
            F.col("r_name").alias("region"),
            F.col("l_extendedprice").cast("decimal(18,2)").alias("amount"),
            F.col("p_retailprice").cast("decimal(18,2)").alias("price"),
            F.col("l_quantity").cast("bigint").alias("quantity"),
        )
    )


def _income_bin(balance):
    return (
        F.when(balance < 0, "negative")
        .when(balance < 2500, "0-2.5k")
        .when(balance < 5000, "2.5-5k")
        .when(balance < 7500, "5-7.5k")
        .when(balance >= 7500, "7.5k+")
    )


def panel_from_tpch(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment")
    geo = _nation_region(spark, sf_dir)
    return customer.join(F.broadcast(geo), customer.c_nationkey == geo.n_nationkey).select(
        F.concat(F.lit("P"), F.col("c_custkey").cast("string")).alias("panel_id"),
        F.when(F.col("c_acctbal") >= 0, F.concat(F.lit("C"), F.col("c_custkey").cast("string"))).alias("customer_id"),
        F.col("c_mktsegment").alias("age_group"),
        F.col("r_name").alias("region"),
        _income_bin(F.col("c_acctbal")).alias("income_bin"),
        (F.col("n_regionkey") + 1).cast("bigint").alias("household_size"),
    )


def order_marginals_from_tpch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long marginals ``(margin, category, target)``: orders per customer
    region and per segment. Orders are counted per customer first, so only
    customer-sized data meets the customer table."""
    per_customer = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"))
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    geo = _nation_region(spark, sf_dir)
    customer = broadcast_if_small(customer, row_count(spark, sf_dir, "customer"))
    joined = per_customer.join(customer, per_customer.o_custkey == customer.c_custkey).join(
        F.broadcast(geo), F.col("c_nationkey") == geo.n_nationkey
    )

    def margin(name: str, column: str) -> DataFrame:
        return joined.groupBy(column).agg(F.sum("n").cast("double").alias("target")).select(
            F.lit(name).alias("margin"), F.col(column).alias("category"), "target"
        )

    return margin("region", "r_name").unionByName(margin("age_group", "c_mktsegment"))


def requests_from_linked(linked: DataFrame, weeks_per_person: int = 3) -> DataFrame:
    """Forecast lookups derived from the data: every linked panel member asks
    for the SKU of their latest purchase in their home region, for
    ``household_size * weeks_per_person`` weeks."""
    latest = F.max(F.struct("txn_date", "sku")).getField("sku")
    return linked.groupBy("panel_id").agg(
        latest.alias("sku"),
        F.max("region_panel").alias("region"),
        (F.max("household_size") * weeks_per_person).cast("int").alias("horizon_weeks"),
    ).withColumnRenamed("panel_id", "request_id")
