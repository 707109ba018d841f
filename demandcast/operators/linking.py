"""Link panel members to transactions on the keyed customer hash."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandcast.functions.hashing import DEFAULT_SALT, digest_to_hex, hmac_sha256_digest, hmac_sha256_hex
from demandcast.operators.checks import check_required_columns
from demandcast.schemas import CREDIT_SUFFIX, LINK_REQUIRED, PANEL_SUFFIX


def _q(name: str):
    return F.col(f"`{name}`")


def with_customer_hash(df: DataFrame, salt: str | bytes = DEFAULT_SALT, source: str = "customer_id") -> DataFrame:
    """Append ``cust_hash`` = HMAC of the id's text. Null id -> null hash, so
    null ids never link (a null is not a customer)."""
    return df.withColumn("cust_hash", hmac_sha256_hex(_q(source), salt))


def canonical_region(linked: DataFrame) -> DataFrame:
    """Add ``region`` = coalesce(region_credit, region_panel) when absent.

    Either source column may be missing; with neither, or with ``region``
    already present, the frame is returned unchanged.
    """
    if "region" in linked.columns:
        return linked
    sources = [c for c in ("region" + CREDIT_SUFFIX, "region" + PANEL_SUFFIX) if c in linked.columns]
    if not sources:
        return linked
    return linked.withColumn("region", F.coalesce(*[_q(c) for c in sources]))


def hot_customers(credit: DataFrame, support: float, column: str = "customer_id", min_rows: int = 0) -> list:
    """Ids holding at least ``support`` of the rows, and ``min_rows`` rows.

    A frequency sketch names at most 1/support candidates in one pass over the
    id column, all frequent ids among them; they alone are then counted, so an
    id that is not frequent costs nothing."""
    ids = credit.select(F.col(f"`{column}`").cast("string").alias("id"))
    row = ids.stat.freqItems(["id"], support).first()
    candidates = [x for x in row[0] if x is not None] if row else []
    if not candidates:
        return []
    counts = ids.select(F.when(F.col("id").isin(candidates), F.col("id")).alias("id")).groupBy("id").agg(F.count(F.lit(1)).alias("n")).collect()
    total = sum(r["n"] for r in counts)
    return sorted(r["id"] for r in counts if r["id"] is not None and r["n"] >= max(support * total, min_rows))


def _salted_join(p: DataFrame, c: DataFrame, hot_ids: list, buckets: int) -> DataFrame:
    """Join on (cust_hash, salt): hot customers' transactions spread over
    ``buckets`` salts, their panel rows replicated per salt."""
    id_p, id_c = "customer_id" + PANEL_SUFFIX, "customer_id" + CREDIT_SUFFIX
    if not hot_ids:
        return p.join(c, on="_key", how="inner")
    hot_p = F.col(f"`{id_p}`").cast("string").isin(hot_ids)
    hot_c = F.col(f"`{id_c}`").cast("string").isin(hot_ids)
    spread = F.pmod(F.xxhash64(*[_q(x) for x in c.columns if x != "_key"]), F.lit(buckets))
    c = c.withColumn("_salt", F.when(hot_c, spread).otherwise(F.lit(0)).cast("int"))
    replicas = F.when(hot_p, F.sequence(F.lit(0), F.lit(buckets - 1))).otherwise(F.array(F.lit(0)))
    p = p.withColumn("_salt", F.explode(replicas))
    return p.join(c, on=["_key", "_salt"], how="inner").drop("_salt")


def link_panel_credit(
    panel: DataFrame,
    credit: DataFrame,
    salt: str | bytes = DEFAULT_SALT,
    drop_raw_ids: bool = False,
    broadcast_panel: bool = False,
    hot_key_support: float | None = None,
    salt_buckets: int = 32,
    hot_key_rows: int = 0,
) -> DataFrame:
    """Inner equi-join of panel and transactions on ``cust_hash``.

    Output layout: panel columns (clashing names suffixed ``_panel``),
    ``cust_hash``, transaction columns (clashes suffixed ``_credit``), then
    the canonical ``region``. Many-to-many: a customer listed twice in the
    panel duplicates its transactions.

    Plan: both sides get the keyed digest as a projection. ``broadcast_panel``
    (for a caller that has checked the panel's size) ships the panel to
    every task, so the transactions are joined where they are read, with no
    shuffle. Otherwise the join is left to Catalyst/AQE: a sort-merge join
    on the hash, with skewed (hot customer) partitions split at runtime and
    a switch to broadcast when the panel turns out small.

    ``hot_key_support`` (e.g. 0.01) makes the hot-customer split explicit
    instead: customers with at least that share of the transactions, and
    ``hot_key_rows`` of them, are found by :func:`hot_customers`, their
    transactions are spread over ``salt_buckets`` salts and their panel rows
    replicated once per salt; every other key joins on salt 0. The result is
    identical. The pipeline links this way.
    """
    check_required_columns(credit, LINK_REQUIRED, "credit_txn")
    check_required_columns(panel, LINK_REQUIRED, "panel")

    credit_cols = set(credit.columns)
    clash = [x for x in panel.columns if x in credit_cols]
    p = panel.withColumnsRenamed({x: x + PANEL_SUFFIX for x in clash})
    c = credit.withColumnsRenamed({x: x + CREDIT_SUFFIX for x in clash})
    # both sides carry customer_id, so it is always suffixed. The join key is
    # the raw 32-byte digest (half the shuffle bytes of the hex text); the
    # hex ``cust_hash`` is derived once, after the join.
    p = p.withColumn("_key", hmac_sha256_digest(_q("customer_id" + PANEL_SUFFIX), salt))
    c = c.withColumn("_key", hmac_sha256_digest(_q("customer_id" + CREDIT_SUFFIX), salt))

    if broadcast_panel:
        linked = F.broadcast(p).join(c, on="_key", how="inner")
    elif hot_key_support:
        linked = _salted_join(p, c, hot_customers(credit, hot_key_support, min_rows=hot_key_rows), salt_buckets)
    else:
        linked = p.join(c, on="_key", how="inner")
    panel_cols = [x for x in p.columns if x != "_key"]
    credit_cols_out = [x for x in c.columns if x != "_key"]
    linked = linked.select(
        *[_q(x) for x in panel_cols], digest_to_hex(F.col("_key")).alias("cust_hash"),
        *[_q(x) for x in credit_cols_out],
    )
    linked = canonical_region(linked)
    if drop_raw_ids:
        linked = linked.drop(*[x for x in linked.columns if x.startswith("customer_id")])
    return linked
