"""Equivalent ANSI SQL (DuckDB dialect) for the registered queries.

Views ``region nation customer supplier part orders lineitem`` are expected
to exist. The derivations mirror ``demandcast.plans.inputs`` and
``demandcast.sources.tpch`` one to one; every query is a WITH chain over
them. Types are cast explicitly where DuckDB differs from Spark (sums of
bigint are HUGEINT, calendar parts are BIGINT, decimals become DOUBLE).
"""

from __future__ import annotations

from collections.abc import Sequence

from demandcast.functions.hashing import DEFAULT_SALT, hmac_pads
from demandcast.functions.numeric import SCALE, decimal_places
from demandcast.operators.forecast import MIN_SERIES_CHANGES
from demandcast.plans.inputs import DEEPAR_SLOT, GAP_MARGINS, LGB_SLOT, RAKE_CHECK_ITERATIONS, RAKE_MARGINS, ROLLING_CUTOFFS
from demandcast.schemas import DEFAULT_HORIZON_WEEKS, QUANTILES, qname

DEC = 6


def hmac_sql(expr: str, salt: str = DEFAULT_SALT) -> str:
    inner, outer = hmac_pads(salt)
    message = f"encode(CAST({expr} AS VARCHAR))"
    return f"sha256(unhex('{outer.hex()}') || unhex(sha256(unhex('{inner.hex()}') || {message})))"


def _clip(expr: str) -> str:
    return f"CASE WHEN ({expr}) < 0 THEN 0.0 ELSE ({expr}) END"


def _dbl(x: float) -> str:
    return f"CAST({float(x)!r} AS DOUBLE)"


CTES: dict[str, tuple[tuple[str, ...], str]] = {}


def cte(name: str, deps: Sequence[str], body: str) -> None:
    CTES[name] = (tuple(deps), body)


cte("geo", [], """
SELECT n.n_nationkey, n.n_regionkey, r.r_name
FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey""")

cte("credit", ["geo"], """
SELECT l.l_orderkey AS txn_id,
       'C' || CAST(o.o_custkey AS VARCHAR) AS customer_id,
       CAST(o.o_orderdate AS TIMESTAMP) AS txn_date,
       'S' || CAST(p.p_partkey AS VARCHAR) AS sku,
       g.r_name AS region,
       CAST(l.l_extendedprice AS DECIMAL(18,2)) AS amount,
       CAST(p.p_retailprice AS DECIMAL(18,2)) AS price,
       CAST(l.l_quantity AS BIGINT) AS quantity
FROM lineitem l
JOIN orders o ON l.l_orderkey = o.o_orderkey
JOIN part p ON l.l_partkey = p.p_partkey
JOIN supplier s ON l.l_suppkey = s.s_suppkey
JOIN geo g ON s.s_nationkey = g.n_nationkey""")

cte("panel", ["geo"], """
SELECT 'P' || CAST(c.c_custkey AS VARCHAR) AS panel_id,
       CASE WHEN c.c_acctbal >= 0 THEN 'C' || CAST(c.c_custkey AS VARCHAR) END AS customer_id,
       c.c_mktsegment AS age_group,
       g.r_name AS region,
       CASE WHEN c.c_acctbal < 0 THEN 'negative'
            WHEN c.c_acctbal < 2500 THEN '0-2.5k'
            WHEN c.c_acctbal < 5000 THEN '2.5-5k'
            WHEN c.c_acctbal < 7500 THEN '5-7.5k'
            WHEN c.c_acctbal >= 7500 THEN '7.5k+' END AS income_bin,
       CAST(g.n_regionkey + 1 AS BIGINT) AS household_size
FROM customer c JOIN geo g ON c.c_nationkey = g.n_nationkey""")

cte("marginals", ["geo"], """
SELECT 'region' AS margin, g.r_name AS category, CAST(SUM(oc.n) AS DOUBLE) AS target
FROM (SELECT o_custkey, COUNT(*) AS n FROM orders GROUP BY o_custkey) oc
JOIN customer c ON oc.o_custkey = c.c_custkey JOIN geo g ON c.c_nationkey = g.n_nationkey
GROUP BY g.r_name
UNION ALL
SELECT 'age_group' AS margin, c.c_mktsegment AS category, CAST(SUM(oc.n) AS DOUBLE) AS target
FROM (SELECT o_custkey, COUNT(*) AS n FROM orders GROUP BY o_custkey) oc
JOIN customer c ON oc.o_custkey = c.c_custkey
GROUP BY c.c_mktsegment""")

cte("linked", ["panel", "credit"], f"""
SELECT p.panel_id, p.customer_id AS customer_id_panel, p.age_group, p.region AS region_panel,
       p.income_bin, p.household_size, p.cust_hash,
       c.txn_id, c.customer_id AS customer_id_credit, c.txn_date, c.sku, c.region AS region_credit,
       c.amount, c.price, c.quantity,
       COALESCE(c.region, p.region) AS region
FROM (SELECT *, {hmac_sql('customer_id')} AS cust_hash FROM panel) p
JOIN (SELECT *, {hmac_sql('customer_id')} AS cust_hash FROM credit) c ON p.cust_hash = c.cust_hash""")

cte("weekly", ["linked"], """
SELECT sku, region, CAST(date_trunc('week', txn_date) AS TIMESTAMP) AS week,
       CAST(COALESCE(SUM(quantity), 0) AS BIGINT) AS units_sold,
       COALESCE(CAST(SUM(amount) AS DOUBLE), 0.0) AS sales_dollars,
       COUNT(DISTINCT txn_id) AS n_transactions,
       CASE WHEN COUNT(price) > 0 THEN CAST(SUM(price) AS DOUBLE) / CAST(COUNT(price) AS DOUBLE) END AS avg_price
FROM linked
WHERE sku IS NOT NULL AND region IS NOT NULL
GROUP BY sku, region, date_trunc('week', txn_date)""")

cte("features", ["weekly"], """
SELECT sku, region, week, units_sold, sales_dollars, n_transactions, avg_price,
       CAST(lag(units_sold) OVER (PARTITION BY sku, region ORDER BY week) AS DOUBLE) AS lag_1_units,
       CAST(avg(units_sold) OVER (PARTITION BY sku, region ORDER BY week
                                  ROWS BETWEEN 3 PRECEDING AND CURRENT ROW) AS DOUBLE) AS rolling_4w_mean,
       CAST(weekofyear(week) AS BIGINT) AS weekofyear,
       CAST(month(week) AS BIGINT) AS month
FROM weekly""")


def naive_sql(src: str, horizon: int, level_col: str = "units_sold", suffix: str = "",
              clamp: bool = True, quantiles: Sequence[float] = QUANTILES,
              min_changes: int = MIN_SERIES_CHANGES, pooled: bool = True) -> str:
    own = ",\n         ".join(f"quantile_cont(chg, {_dbl(q)}) AS o{i}" for i, q in enumerate(quantiles))
    pool = ", ".join(f"quantile_cont(chg, {_dbl(q)}) AS p{i}" for i, q in enumerate(quantiles))
    pick = ", ".join(
        f"CASE WHEN s.n_chg < {int(min_changes)} THEN COALESCE(pl.p{i}, s.o{i}) ELSE s.o{i} END AS s{i}"
        for i in range(len(quantiles))
    )
    cols = []
    for i, q in enumerate(quantiles):
        v = f"round(level + COALESCE(s{i}, 0.0) * sqrt(CAST(k AS DOUBLE)), {DEC})"
        cols.append(f'{_clip(v) if clamp else v} AS "{qname(q, suffix)}"')
    quant_cols = ",\n       ".join(cols)
    changes = f"""(SELECT sku, region, week, CAST({level_col} AS DOUBLE) AS lvl,
               units_sold - lag(units_sold) OVER (PARTITION BY sku, region ORDER BY week) AS chg
        FROM {src})"""
    return f"""
SELECT sku, region, CAST(CAST(last_week AS DATE) + CAST(7 * k AS INTEGER) AS DATE) AS date,
       {quant_cols}
FROM (SELECT *, unnest(generate_series(1, {int(horizon)})) AS k FROM (
  SELECT s.sku, s.region, s.last_week, s.level, {pick}
  FROM (SELECT sku, region, max(week) AS last_week, arg_max(lvl, week) AS level, COUNT(chg) AS n_chg,
         {own}
        FROM {changes} x GROUP BY sku, region) s
  LEFT JOIN (SELECT sku, {pool} FROM {changes} y GROUP BY sku) pl ON s.sku = pl.sku
  {'' if pooled else f'WHERE s.n_chg >= {int(min_changes)}'}) z) t"""


cte("lgb", ["features"], naive_sql("features", **LGB_SLOT))
cte("deepar", ["features"], naive_sql("features", **DEEPAR_SLOT))


def _blend(c: str) -> str:
    return _clip(f'0.5 * COALESCE(l."{c}_lgb", 0.0) + 0.5 * COALESCE(d."{c}_deepar", 0.0)')


cte("ens", ["lgb", "deepar"], f"""
SELECT COALESCE(l.sku, d.sku) AS sku, COALESCE(l.region, d.region) AS region,
       COALESCE(l.date, d.date) AS date,
       {_blend('q0.1')} AS "q0.1", {_blend('q0.5')} AS "q0.5", {_blend('q0.9')} AS "q0.9"
FROM lgb l FULL OUTER JOIN deepar d
  ON l.sku IS NOT DISTINCT FROM d.sku AND l.region IS NOT DISTINCT FROM d.region
 AND l.date IS NOT DISTINCT FROM d.date""")

cte("requests", ["linked"], """
SELECT panel_id AS request_id, max({'txn_date': txn_date, 'sku': sku}).sku AS sku,
       max(region_panel) AS region, CAST(max(household_size) * 3 AS INTEGER) AS horizon_weeks
FROM linked GROUP BY panel_id""")

cte("top_sku", ["features"], """
SELECT sku FROM features GROUP BY sku ORDER BY SUM(units_sold) DESC, sku LIMIT 1""")

cte("top_region", ["features", "top_sku"], """
SELECT region FROM features WHERE sku = (SELECT sku FROM top_sku)
GROUP BY region ORDER BY SUM(units_sold) DESC, region LIMIT 1""")

cte("bt_cut", ["features"], f"""
SELECT CAST(max(week) AS DATE) - {7 * DEFAULT_HORIZON_WEEKS} AS cutoff FROM features""")
cte("bt_train", ["features", "bt_cut"], """
SELECT * FROM features WHERE CAST(week AS DATE) <= (SELECT cutoff FROM bt_cut)""")
cte("bt_fc", ["bt_train"], naive_sql("bt_train", DEFAULT_HORIZON_WEEKS))
cte("pairs", ["bt_fc", "features", "bt_cut"], """
SELECT f.sku, f.region, f.date, f."q0.1", f."q0.5", f."q0.9", CAST(a.units_sold AS DOUBLE) AS actual
FROM bt_fc f JOIN features a
  ON f.sku = a.sku AND f.region = a.region AND f.date = CAST(a.week AS DATE)
WHERE CAST(a.week AS DATE) > (SELECT cutoff FROM bt_cut)""")


def _rake_ctes(iterations: int, margins: Sequence[str], panel: str = "panel", marginals: str = "marginals",
               cells: str = "cells", raked: str = "raked") -> None:
    keys = ", ".join(margins)
    cte(f"{cells}0", [panel], f"""
SELECT {keys}, CAST(COUNT(*) AS DOUBLE) AS n, 1.0::DOUBLE AS w FROM {panel} GROUP BY {keys}""")
    prev = f"{cells}0"
    step = 0
    for _ in range(iterations):
        for m in margins:
            step += 1
            name = f"{cells}{step}"
            others = ", ".join(f"c.{x}" for x in margins)
            cte(name, [marginals, prev], f"""
SELECT {others}, c.n, c.w * f.factor AS w
FROM {prev} c JOIN (
  SELECT t.{m},
         CASE WHEN t.{m} IS NULL THEN 1.0
              WHEN t.cur = 0 THEN 1.0
              ELSE COALESCE(g.target, 0.0) / t.cur END AS factor
  FROM (SELECT {m}, SUM(w * n) AS cur FROM {prev} GROUP BY {m}) t
  LEFT JOIN (SELECT category, SUM(target) AS target FROM {marginals} WHERE margin = '{m}' GROUP BY category) g
    ON CAST(t.{m} AS VARCHAR) = g.category
) f ON c.{m} IS NOT DISTINCT FROM f.{m}""")
            prev = name
    on = " AND ".join(f"p.{m} IS NOT DISTINCT FROM c.{m}" for m in margins)
    cte(raked, [panel, prev], f"""
SELECT p.*, c.w AS weight FROM {panel} p JOIN {prev} c ON {on}""")


_rake_ctes(RAKE_CHECK_ITERATIONS, RAKE_MARGINS)

cte("gap_panel", ["panel"], """
SELECT * REPLACE (CASE WHEN income_bin <> 'negative' THEN income_bin END AS income_bin) FROM panel""")
cte("gap_marginals", ["marginals", "gap_panel"], """
SELECT * FROM marginals WHERE margin = 'region'
UNION ALL
SELECT 'income_bin' AS margin, income_bin AS category, CASE WHEN income_bin = '0-2.5k' THEN 0.0 ELSE COUNT(*) * 2.0 END::DOUBLE AS target
FROM gap_panel WHERE income_bin IS NOT NULL GROUP BY income_bin""")
_rake_ctes(RAKE_CHECK_ITERATIONS, GAP_MARGINS, "gap_panel", "gap_marginals", "gapcells", "gap_raked")

cte("origins", ["features"], """
SELECT sku, region, CAST(week AS DATE) AS origin, CAST(units_sold AS DOUBLE) AS u0,
       CAST(COALESCE(lag(units_sold, 1) OVER s, units_sold) AS DOUBLE) AS u1,
       CAST(COALESCE(lag(units_sold, 2) OVER s, lag(units_sold, 1) OVER s, units_sold) AS DOUBLE) AS u2,
       CAST(COALESCE(lag(units_sold, 3) OVER s, lag(units_sold, 2) OVER s, lag(units_sold, 1) OVER s, units_sold) AS DOUBLE) AS u3,
       rolling_4w_mean AS mean4
FROM features WINDOW s AS (PARTITION BY sku, region ORDER BY week)""")
cte("examples", ["origins", "features"], f"""
SELECT o.sku, o.region, o.target_date, o.origin, o.u0, o.u1, o.u2, o.u3, o.mean4, CAST(o.k AS DOUBLE) AS step,
       CAST(weekofyear(o.target_date) AS DOUBLE) AS target_woy, CAST(month(o.target_date) AS DOUBLE) AS target_month,
       CAST(f.units_sold AS DOUBLE) AS label
FROM (SELECT *, CAST(origin + CAST(7 * k AS INTEGER) AS DATE) AS target_date
      FROM origins, unnest(generate_series(1, {DEFAULT_HORIZON_WEEKS})) AS g(k)) o
JOIN features f ON f.sku = o.sku AND f.region = o.region AND CAST(f.week AS DATE) = o.target_date""")


def with_ctes(body: str, *needed: str) -> str:
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for dep in CTES[n][0]:
            visit(dep)
        order.append(n)

    for n in needed:
        visit(n)
    parts = [f"{n} AS ({CTES[n][1]}\n)" for n in order]
    return "WITH " + ",\n".join(parts) + "\n" + body.strip()


Q = '"q0.1", "q0.5", "q0.9"'

SQL: dict[str, str] = {
    "hash_customer_id": with_ctes(f"SELECT customer_id, {hmac_sql('customer_id')} AS cust_hash FROM panel", "panel"),
    "link_panel_credit": with_ctes("SELECT * FROM linked", "linked"),
    "canonical_region": with_ctes(
        "SELECT panel_id, txn_id, sku, region_panel, region_credit, COALESCE(region_credit, region_panel) AS region "
        "FROM linked", "linked"),
    "calendar_features": with_ctes("""
SELECT txn_date, CAST(date_trunc('week', txn_date) AS TIMESTAMP) AS week,
       CAST(weekofyear(date_trunc('week', txn_date)) AS BIGINT) AS weekofyear,
       CAST(month(date_trunc('week', txn_date)) AS BIGINT) AS month
FROM (SELECT DISTINCT txn_date FROM credit) d""", "credit"),
    "weekly_rollup": with_ctes("SELECT * FROM weekly", "weekly"),
    "lag_feature": with_ctes("SELECT sku, region, week, units_sold, lag_1_units FROM features", "features"),
    "rolling_mean_feature": with_ctes(
        "SELECT sku, region, week, units_sold, rolling_4w_mean FROM features", "features"),
    "weekly_features": with_ctes("SELECT * FROM features", "features"),
    "totals_close": with_ctes("""
SELECT panel_total, credit_total,
       CASE WHEN credit_total <> 0 THEN abs(panel_total - credit_total) / credit_total END AS ratio
FROM (SELECT COALESCE(CAST(SUM(quantity) AS DOUBLE), 0.0) AS panel_total,
             (SELECT COALESCE(CAST(SUM(quantity) AS DOUBLE), 0.0) FROM credit) AS credit_total
      FROM linked) t""", "linked", "credit"),
    "credit_overview": with_ctes("""
SELECT COUNT(*) AS n_records, min(txn_date) AS first_txn_date, max(txn_date) AS last_txn_date,
       COUNT(DISTINCT sku) AS n_skus, COUNT(DISTINCT customer_id) AS n_customers FROM credit""", "credit"),
    "daily_volume": with_ctes("""
SELECT txn_date, CAST(COALESCE(SUM(quantity), 0) AS BIGINT) AS quantity
FROM credit WHERE txn_date IS NOT NULL GROUP BY txn_date""", "credit"),
    "panel_overview": with_ctes(
        "SELECT COUNT(*) AS n_members, COUNT(DISTINCT customer_id) AS n_customers FROM panel", "panel"),
    "age_distribution": with_ctes("""
SELECT age_group, COUNT(*) AS n,
       CAST(COUNT(*) AS DOUBLE) / (SELECT COUNT(*) FROM panel WHERE age_group IS NOT NULL) AS share
FROM panel WHERE age_group IS NOT NULL GROUP BY age_group""", "panel"),
    "region_distribution": with_ctes("""
SELECT region, COUNT(*) AS n,
       CAST(COUNT(*) AS DOUBLE) / (SELECT COUNT(*) FROM panel WHERE region IS NOT NULL) AS share
FROM panel WHERE region IS NOT NULL GROUP BY region""", "panel"),
    "linkage_metrics": with_ctes("""
SELECT COUNT(*) AS linked_records, COUNT(DISTINCT cust_hash) AS unique_customers,
       CAST(COUNT(*) AS DOUBLE) / (SELECT COUNT(*) FROM credit) * 100.0 AS linkage_rate
FROM linked""", "linked", "credit"),
    "linked_by_sku": with_ctes(
        "SELECT sku, COUNT(*) AS linked_records FROM linked WHERE sku IS NOT NULL GROUP BY sku", "linked"),
    "linked_sample": with_ctes("""
SELECT sku, region, txn_date, quantity, amount, age_group, income_bin FROM linked
ORDER BY sku, region, txn_date, quantity, amount, age_group, income_bin LIMIT 10""", "linked"),
    "credit_preview": with_ctes("""
SELECT * FROM credit
ORDER BY txn_id, customer_id, txn_date, sku, region, amount, price, quantity LIMIT 5""", "credit"),
    "panel_preview": with_ctes("""
SELECT * FROM panel
ORDER BY panel_id, customer_id, age_group, region, income_bin, household_size LIMIT 5""", "panel"),
    "feature_summary": with_ctes("""
SELECT COUNT(*) AS n_rows, CAST(date_diff('day', min(week), max(week)) AS BIGINT) AS date_range_days,
       (SELECT COUNT(*) FROM (SELECT DISTINCT sku, region FROM features) s) AS n_series
FROM features""", "features"),
    "feature_slice": with_ctes("""
SELECT sku, region, week, units_sold, rolling_4w_mean FROM features
WHERE sku = (SELECT sku FROM top_sku)""", "features", "top_sku"),
}

def _with_extra(name: str, body_sql: str, tail: str, *needed: str) -> str:
    """WITH chain of ``needed`` plus one extra CTE ``name`` appended last."""
    base = with_ctes("SELECT 1", *needed)
    head = base[: base.rfind("\nSELECT 1")]
    return f"{head},\n{name} AS ({body_sql}\n)\n{tail}"


SQL["naive_forecast"] = _with_extra(
    "nf", naive_sql("features", 12), "SELECT * FROM nf", "features")
SQL["clip_nonnegative"] = _with_extra(
    "nf", naive_sql("features", 12, clamp=False),
    f"SELECT sku, region, date, {_clip('\"q0.1\"')} AS \"q0.1\", {_clip('\"q0.5\"')} AS \"q0.5\", "
    f"{_clip('\"q0.9\"')} AS \"q0.9\" FROM nf", "features")
SQL["normalize_quantiles"] = with_ctes(
    'SELECT sku, region, date, "q0.1_lgb" AS "q0.1", "q0.5_lgb" AS "q0.5", "q0.9_lgb" AS "q0.9" FROM lgb', "lgb")
SQL["ensemble_both"] = with_ctes("SELECT * FROM ens", "ens")
SQL["ensemble_lgb_only"] = with_ctes(
    f"SELECT sku, region, date, {_clip('\"q0.1_lgb\"')} AS \"q0.1\", {_clip('\"q0.5_lgb\"')} AS \"q0.5\", "
    f"{_clip('\"q0.9_lgb\"')} AS \"q0.9\" FROM lgb", "lgb")
SQL["ensemble_deepar_only"] = with_ctes(
    f"SELECT sku, region, date, {_clip('\"q0.1_deepar\"')} AS \"q0.1\", {_clip('\"q0.5_deepar\"')} AS \"q0.5\", "
    f"{_clip('\"q0.9_deepar\"')} AS \"q0.9\" FROM deepar", "deepar")
SQL["forecast_summary"] = with_ctes("""
SELECT CAST(floor(COUNT(*) / (SELECT COUNT(*) FROM (SELECT DISTINCT sku, region FROM ens) s)) AS BIGINT) AS horizon_weeks,
       (SELECT COUNT(*) FROM (SELECT DISTINCT sku, region FROM ens) s) AS n_series,
       CAST(SUM(CAST("q0.5" AS DECIMAL(28,12))) AS DOUBLE) / CAST(COUNT("q0.5") AS DOUBLE) AS mean_q50
FROM ens""", "ens")
SQL["series_index"] = with_ctes("SELECT DISTINCT sku, region FROM ens", "ens")
SQL["regions_by_sku"] = with_ctes("""
SELECT sku, array_to_string(list_sort(list(DISTINCT region)), ',') AS regions
FROM (SELECT DISTINCT sku, region FROM ens) s WHERE sku IS NOT NULL GROUP BY sku""", "ens")
SQL["forecast_slice"] = with_ctes(f"""
SELECT sku, region, CAST(date AS DATE) AS date, {Q} FROM ens
WHERE sku = (SELECT sku FROM top_sku) AND region = (SELECT region FROM top_region)""",
                                  "ens", "top_sku", "top_region")
SQL["forecast_table"] = with_ctes("""
SELECT strftime(CAST(date AS DATE), '%Y-%m-%d') AS date, "q0.1" AS "10th Percentile",
       "q0.5" AS "Median", "q0.9" AS "90th Percentile" FROM ens
WHERE sku = (SELECT sku FROM top_sku) AND region = (SELECT region FROM top_region)""",
                                  "ens", "top_sku", "top_region")
SQL["forecast_lookup"] = with_ctes(f"""
SELECT r.request_id, f.sku, f.region, strftime(f.date, '%Y-%m-%d') AS date, f."q0.1", f."q0.5", f."q0.9"
FROM requests r JOIN (
  SELECT *, row_number() OVER (PARTITION BY sku, region ORDER BY date, {Q}) AS rn FROM ens) f
  ON r.sku = f.sku AND r.region = f.region AND f.rn <= r.horizon_weeks""", "requests", "ens")
SQL["forecast_missing"] = with_ctes("""
SELECT * FROM requests r
WHERE NOT EXISTS (SELECT 1 FROM ens f WHERE f.sku = r.sku AND f.region = r.region)""", "requests", "ens")


SQL["rake_inconsistent"] = with_ctes("SELECT panel_id, round(weight, 6) AS weight FROM gap_raked", "gap_raked")
SQL["regression_examples"] = with_ctes("SELECT * FROM examples", "examples")
SQL["conformal_offsets"] = with_ctes("SELECT step, " + ", ".join(
    f"min(r) FILTER (pos >= {q!r} * total) AS _off{i}" for i, q in enumerate(QUANTILES)) + """
FROM (SELECT step, r, row_number() OVER (PARTITION BY step ORDER BY r) AS pos, count(*) OVER (PARTITION BY step) AS total
      FROM (SELECT step, label - mean4 AS r FROM examples) e) x GROUP BY step""", "examples")


def _fx(expr: str) -> str:
    return f"CAST({expr} AS DECIMAL(28,{SCALE}))"


def _frac(x: float) -> str:
    places = decimal_places(x)
    return f"CAST('{float(x)!r}' AS DECIMAL({places + 2},{places}))"


def _wape(a: str = "actual", f: str = '"q0.5"') -> str:
    return (f"COALESCE(CAST(SUM(abs({_fx(a)} - {_fx(f)})) AS DOUBLE), 0.0) / "
            f"greatest(COALESCE(CAST(SUM(abs({_fx(a)})) AS DOUBLE), 0.0), {_dbl(1e-9)})")


def _pinball(q: float, a: str = "actual") -> str:
    e = f'({_fx(a)} - {_fx(chr(34) + qname(q) + chr(34))})'
    below = _frac(round(float(q) - 1.0, decimal_places(q)))
    loss = f"greatest({_frac(q)} * {e}, {below} * {e})"
    return f"CAST(SUM({loss}) AS DOUBLE) / CAST(COUNT({loss}) AS DOUBLE)"


SQL["wape"] = with_ctes(f"SELECT {_wape()} AS wape FROM pairs", "pairs")
SQL["wape_by_series"] = with_ctes(f"SELECT sku, region, {_wape()} AS wape FROM pairs GROUP BY sku, region", "pairs")
SQL["pinball_loss"] = with_ctes(" UNION ALL ".join(
    f"SELECT {_dbl(q)} AS quantile, {_pinball(q)} AS pinball_loss FROM pairs" for q in QUANTILES), "pairs")
SQL["backtest_naive"] = with_ctes(
    "SELECT sku, region, COUNT(*) AS n_weeks, " + _wape() + " AS wape, "
    + ", ".join(f'{_pinball(q)} AS "pinball_{qname(q)}"' for q in QUANTILES)
    + " FROM pairs GROUP BY sku, region", "pairs")
SQL["rake_weights"] = with_ctes("SELECT panel_id, round(weight, 6) AS weight FROM raked", "raked")
SQL["rake_totals"] = with_ctes(" UNION ALL ".join(f"""
SELECT '{m}' AS margin, CAST(r.{m} AS VARCHAR) AS category, round(SUM(r.weight), 6) AS weighted_total,
       (SELECT SUM(target) FROM marginals g WHERE g.margin = '{m}' AND g.category = CAST(r.{m} AS VARCHAR)) AS target
FROM raked r WHERE r.{m} IS NOT NULL GROUP BY r.{m}""" for m in RAKE_MARGINS), "raked", "marginals")


# where raking stops by tolerance, every observed category has its target
SQL["rake_until_met"] = with_ctes(" UNION ALL ".join(f"""
SELECT '{m}' AS margin, CAST(p.{m} AS VARCHAR) AS category, round(g.target, 3) AS weighted_total, g.target AS target, TRUE AS converged, TRUE AS met
FROM (SELECT DISTINCT {m} FROM panel WHERE {m} IS NOT NULL) p
JOIN (SELECT category, SUM(target) AS target FROM marginals WHERE margin = '{m}' GROUP BY category) g ON g.category = CAST(p.{m} AS VARCHAR)"""
    for m in RAKE_MARGINS), "panel", "marginals")

for _k in range(1, ROLLING_CUTOFFS + 1):
    cte(f"roll{_k}", ["features"], f"""
SELECT *, CAST((SELECT max(week) FROM features) AS DATE) - {7 * DEFAULT_HORIZON_WEEKS * _k} AS cutoff FROM features
WHERE CAST(week AS DATE) <= (SELECT CAST(max(week) AS DATE) - {7 * DEFAULT_HORIZON_WEEKS * _k} FROM features)""")
    cte(f"roll_fc{_k}", [f"roll{_k}"], naive_sql(f"roll{_k}", DEFAULT_HORIZON_WEEKS))
cte("roll_pairs", [f"roll_fc{k}" for k in range(1, ROLLING_CUTOFFS + 1)] + ["features"], " UNION ALL ".join(f"""
SELECT c.cutoff, f."q0.1", f."q0.5", f."q0.9", CAST(a.units_sold AS DOUBLE) AS actual
FROM roll_fc{k} f JOIN features a ON f.sku = a.sku AND f.region = a.region AND f.date = CAST(a.week AS DATE)
JOIN (SELECT DISTINCT cutoff FROM roll{k}) c ON f.date > c.cutoff AND f.date <= c.cutoff + {7 * DEFAULT_HORIZON_WEEKS}"""
    for k in range(1, ROLLING_CUTOFFS + 1)))
SQL["rolling_origin_naive"] = with_ctes(
    "SELECT cutoff, COUNT(*) AS n_weeks, " + _wape() + " AS wape, "
    + ", ".join(f'{_pinball(q)} AS "pinball_{qname(q)}"' for q in QUANTILES) + ", "
    + ", ".join(f'avg((actual <= "{qname(q)}")::INT)::DOUBLE AS "below_{qname(q)}"' for q in QUANTILES)
    + ', avg(("q0.1" <= actual AND actual <= "q0.9")::INT)::DOUBLE AS coverage FROM roll_pairs GROUP BY cutoff', "roll_pairs")
SQL["pipeline_naive"] = _with_extra("nf", naive_sql("features", DEFAULT_HORIZON_WEEKS), "SELECT * FROM nf", "features")
SQL["valid_skus"] = with_ctes("SELECT DISTINCT sku FROM ens WHERE sku IS NOT NULL", "ens")
SQL["unknown_skus"] = with_ctes("SELECT * FROM requests r WHERE NOT EXISTS (SELECT 1 FROM ens f WHERE f.sku = r.sku)", "requests", "ens")

SQL["pipeline_status"] = """
SELECT 'Data Ingestion' AS step, EXISTS (SELECT 1 FROM lineitem) AND EXISTS (SELECT 1 FROM customer) AS ready
UNION ALL SELECT 'Data Linking' AS step, EXISTS (SELECT 1 FROM orders) AS ready
UNION ALL SELECT 'Feature Engineering' AS step, FALSE AS ready
UNION ALL SELECT 'Forecasting' AS step, FALSE AS ready"""

SQL["forecast_missing_suggestions"] = with_ctes("""
SELECT r.*, v.valid_regions FROM requests r
LEFT JOIN (SELECT sku, array_to_string(list_sort(list(DISTINCT region)), ',') AS valid_regions
           FROM (SELECT DISTINCT sku, region FROM ens) s WHERE sku IS NOT NULL GROUP BY sku) v
  ON r.sku = v.sku
WHERE NOT EXISTS (SELECT 1 FROM ens f WHERE f.sku = r.sku AND f.region = r.region)""", "requests", "ens")
