"""SQL counterparts of the registered queries, for an independent engine.

Written from the definitions rather than from the Spark plans: series are built densely,
means are weighted sums over every calendar day, and nested documents are replaced by the
joins they were made of.
"""

from __future__ import annotations

import re

AS_OF = "DATE '2001-07-01'"
COHORT = "DATE '2000-01-01'"

EMAIL = "concat(lower(replace(c_name, '#', '.')), '@', lower(c_mktsegment), '.example.com')"
STAMP = "strftime(o_orderdate, '%Y-%m-%d')"


def _cut(x: str) -> str:
    return f"CAST(trunc(round({x}, 9)) AS BIGINT)"


def _even(x: str) -> str:
    return f"CAST(round_even({x}, 0) AS BIGINT)"


def _cover(stock: str, rate: str) -> str:
    return f"CASE WHEN {rate} = 0 THEN 0.0 ELSE least({stock} / {rate}, 365.0) END"


def _metrics(rates: str, stock: str, on: str, as_of: str, extra: str = "") -> str:
    """Stock cover of ``rates`` against ``stock``, unrounded."""
    return f"""
    SELECT m.*, {as_of} + CAST({_cut('est_stock_days_on_hand')} AS INTEGER) AS estimated_stockout_date,
           {_cut('run_rate * 70 + run_rate * 7')} AS restock_point
    FROM (
      SELECT r.inventory_id, r.run_rate, {extra}
             coalesce(s.name, 'INVENTORY_ID_NOT_IN_INVENTORY_DETAILS') AS name,
             CAST(coalesce(s.total_fulfillable_quantity, 0) AS BIGINT) AS total_fulfillable_quantity,
             {_cover('coalesce(s.total_fulfillable_quantity, 0)', 'r.run_rate')} AS est_stock_days_on_hand
      FROM {rates} r LEFT JOIN {stock} s ON {on}
    ) m"""


VIEWS: dict[str, str] = {
    "order_details": f"""
    SELECT o_orderdate AS created_date, o_orderdate AS purchase_date, o_orderkey AS shipbob_order_id,
           CAST(o_orderkey AS VARCHAR) AS order_number, o_orderstatus AS order_status,
           o_orderpriority AS order_type, CAST(r_regionkey AS BIGINT) AS channel_id,
           r_name AS channel_name, l_suppkey * 1000000 + l_partkey AS product_id,
           concat(p_brand, '-', l_partkey) AS sku, l_returnflag AS shipping_method,
           c_name AS customer_name, {EMAIL} AS customer_email,
           concat('City ', c_nationkey) AS customer_address_city,
           n_name AS customer_address_state, r_name AS customer_address_country,
           p_name AS sku_name, l_partkey AS inventory_id, p_name AS inventory_name,
           CAST(l_quantity AS BIGINT) AS inventory_qty, CAST(o_orderdate AS DATE) AS order_date
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
    JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
    JOIN part ON l_partkey = p_partkey""",
    "order_places": f"""
    SELECT *, {EMAIL} AS email_address FROM orders JOIN customer ON o_custkey = c_custkey
    JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
    "historic_orders": "SELECT * FROM order_details WHERE order_date < DATE '2000-07-01'",
    "recurring_orders": f"SELECT * FROM order_details WHERE order_date >= {COHORT}",
    "all_orders": """
    SELECT * FROM historic_orders h
    WHERE NOT EXISTS (SELECT 1 FROM recurring_orders r WHERE r.order_number = h.order_number)
    UNION ALL SELECT * FROM recurring_orders""",
    "inventory_snapshots": """
    SELECT p_partkey AS id, p_name AS name, p_type = 'SMALL' AS is_digital,
           p_type = 'LARGE' AS is_case_pick, p_type = 'MEDIUM' AS is_lot,
           p_size * 10 + day(d) AS total_fulfillable_quantity,
           p_size * 11 + day(d) AS total_onhand_quantity,
           CAST(p_size AS BIGINT) AS total_committed_quantity,
           p_size * 10 + day(d) AS total_sellable_quantity,
           CAST(p_size * 2 AS BIGINT) AS total_awaiting_quantity,
           CAST(0 AS BIGINT) AS total_exception_quantity,
           CAST(0 AS BIGINT) AS total_internal_transfer_quantity,
           CAST(p_size - 1 AS BIGINT) AS total_backordered_quantity,
           p_size > 5 AS is_active, d AS partition_date
    FROM part, (VALUES (DATE '2001-01-31'), (DATE '2001-06-28'), (DATE '2001-06-30'),
                       (DATE '2001-07-02')) AS v(d)""",
    "stocked_snapshots": """
    SELECT * FROM inventory_snapshots WHERE id IN (SELECT p_partkey FROM part WHERE p_type <> 'PROMO')""",
    "active_skus": """
    SELECT concat(p_brand, '-', p_partkey) AS variant_sku FROM part
    WHERE p_size - 10 > 0 AND p_type <> 'ECONOMY'""",
    "formulas": """
    SELECT p_partkey, concat('RM-', k) AS material, concat('Material ', k) AS material_name,
           CAST(p_size % 5 + 1 AS DOUBLE) / 10 AS quantity_required
    FROM (SELECT p_partkey, p_size,
                 unnest([p_partkey % n, (p_partkey * 7 + 3) % n]) AS k
          FROM part, (SELECT count(*) AS n FROM supplier))""",
    "material_stock": """
    SELECT s_name AS name, concat('RM-', s_suppkey) AS material, 'kg' AS units_of_measure,
           s_acctbal AS in_stock, DATE '2001-07-01' AS as_of,
           CASE WHEN s_nationkey < 8 THEN 0.0 WHEN s_nationkey < 16 THEN 100.0 END AS safety_stock
    FROM supplier""",
    "open_mos": """
    SELECT *, max(quarter) OVER () AS newest FROM (
      SELECT concat('RM-', o_custkey % (SELECT count(*) FROM supplier)) AS material,
             CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'pcs'
                  WHEN o_orderpriority <> '5-LOW' THEN 'case' END AS uom,
             o_totalprice / 100 AS planned,
             CAST(date_trunc('quarter', o_orderdate) AS DATE) AS quarter
      FROM orders WHERE o_orderstatus = 'O')""",
    "sales": f"""
    SELECT inventory_id, order_date, CAST(sum(inventory_qty) AS BIGINT) AS qty_sold
    FROM order_details WHERE order_date BETWEEN {AS_OF} - 90 AND {AS_OF}
    GROUP BY inventory_id, order_date""",
    "calendar": """
    SELECT CAST(unnest(generate_series(min(order_date), max(order_date), INTERVAL 1 DAY)) AS DATE)
           AS order_date FROM sales""",
    "grid": """
    SELECT i.inventory_id, c.order_date, coalesce(s.qty_sold, 0) AS qty_sold,
           row_number() OVER (PARTITION BY i.inventory_id ORDER BY c.order_date) AS nth,
           row_number() OVER (PARTITION BY i.inventory_id ORDER BY c.order_date DESC) - 1 AS age
    FROM (SELECT DISTINCT inventory_id FROM sales) i CROSS JOIN calendar c
    LEFT JOIN sales s ON s.inventory_id = i.inventory_id AND s.order_date = c.order_date""",
    "rates": """
    SELECT inventory_id, sum(qty_sold * pow(0.5, age)) / sum(pow(0.5, age)) AS run_rate
    FROM grid GROUP BY inventory_id""",
    "stock_asof": "SELECT * FROM stocked_snapshots WHERE partition_date = DATE '2001-06-30'",
    "run_rates": _metrics("rates", "stock_asof", "s.id = r.inventory_id", AS_OF),
    "run_days": """
    SELECT CAST(unnest(generate_series(DATE '2001-06-29', DATE '2001-07-01', INTERVAL 1 DAY)) AS DATE)
           AS partition_date""",
    "ranged_rates": """
    WITH w AS (
      SELECT d.partition_date, o.inventory_id, o.order_date, o.inventory_qty AS q
      FROM run_days d JOIN order_details o
        ON o.order_date BETWEEN d.partition_date - 90 AND d.partition_date),
    b AS (SELECT partition_date, min(order_date) AS lo, max(order_date) AS hi FROM w GROUP BY 1)
    SELECT w.partition_date, w.inventory_id,
           sum(q * pow(0.5, hi - order_date)) / (2 * (1 - pow(0.5, hi - lo + 1))) AS run_rate
    FROM w JOIN b ON w.partition_date = b.partition_date
    GROUP BY w.partition_date, w.inventory_id, lo, hi""",
    "ranged_stock": """
    SELECT d.partition_date AS run_day, s.* FROM run_days d JOIN stocked_snapshots s
      ON s.partition_date = (SELECT max(x.partition_date) FROM stocked_snapshots x
                             WHERE x.partition_date <= d.partition_date - 1)""",
    "ranged_run_rates": _metrics(
        "ranged_rates",
        "ranged_stock",
        "s.id = r.inventory_id AND s.run_day = r.partition_date",
        "partition_date",
        "r.partition_date,",
    ),
    "rated": f"""
    SELECT *, {_even('est_stock_days_on_hand')} AS days FROM run_rates""",
    "item_sales": f"""
    SELECT CAST(created_date AS DATE) AS created_date, inventory_name, inventory_id,
           CAST(sum(inventory_qty) AS BIGINT) AS inventory_qty
    FROM order_details WHERE CAST(created_date AS DATE) BETWEEN {AS_OF} - 90 AND {AS_OF}
    GROUP BY ALL""",
    "trailing_units": "SELECT inventory_id, "
    + ", ".join(
        f"CAST(coalesce(sum(inventory_qty) FILTER (created_date >= {AS_OF} - {n}), 0) AS BIGINT)"
        f" AS actual_qty_sold_last_{n}_days"
        for n in (30, 60, 90)
    )
    + " FROM item_sales GROUP BY inventory_id",
    "levels": f"""
    SELECT name, {_even('arg_min(run_rate, inventory_id)')} AS daily_run_rate,
           arg_min(restock_point, inventory_id) AS restock_point,
           arg_min(estimated_stockout_date, inventory_id) AS estimated_stockout_date
    FROM run_rates GROUP BY name""",
    "order_days": """
    SELECT DISTINCT customer_email AS email, CAST(purchase_date AS DATE) AS day FROM all_orders
    WHERE purchase_date IS NOT NULL AND customer_email <> ''""",
    "firsts": f"""
    SELECT email, min(day) AS first_order_date FROM order_days WHERE day >= {COHORT} GROUP BY email""",
    "flags": "SELECT d.email, f.first_order_date, "
    + ", ".join(
        f"CAST(coalesce(bool_or(day - first_order_date BETWEEN 1 AND {n}), false) AS INTEGER)"
        f" AS retained_{n}d"
        for n in (30, 60, 90)
    )
    + " FROM order_days d LEFT JOIN firsts f ON f.email = d.email GROUP BY ALL",
    "report_days": """
    SELECT CAST(unnest(generate_series(DATE '2000-03-20', DATE '2000-04-20', INTERVAL 1 DAY)) AS DATE)
           AS report_date""",
    "known_days": """
    WITH rec AS (SELECT DISTINCT order_number, customer_email, CAST(purchase_date AS DATE) AS day, order_date
                 FROM recurring_orders),
    hist AS (SELECT DISTINCT order_number, customer_email, CAST(purchase_date AS DATE) AS day FROM historic_orders),
    filed AS (SELECT order_number, min(order_date) AS filed FROM rec GROUP BY 1)
    SELECT report_date, customer_email AS email, day FROM report_days JOIN rec ON order_date <= report_date
    WHERE day IS NOT NULL AND customer_email <> ''
    UNION
    SELECT report_date, customer_email, day FROM report_days JOIN hist ON day <= report_date
    LEFT JOIN filed ON filed.order_number = hist.order_number
    WHERE (filed IS NULL OR filed > report_date) AND customer_email <> ''""",
    "known_flags": "SELECT report_date, email, first_order_date, "
    + ", ".join(
        f"CAST(coalesce(bool_or(day - first_order_date BETWEEN 1 AND {n}), false) AS INTEGER) AS retained_{n}d"
        for n in (30, 60, 90)
    )
    + " FROM (SELECT *, min(CASE WHEN day >= "
    + COHORT
    + " THEN day END) OVER (PARTITION BY report_date, email) AS first_order_date FROM known_days) GROUP BY ALL",
    "planned": """
    SELECT material, uom, newest AS planned_as_of, sum(planned) AS qty FROM open_mos
    WHERE quarter = newest AND uom IS NOT NULL GROUP BY material, uom, newest HAVING sum(planned) > 0""",
    "planned_total": """
    SELECT material, newest AS planned_as_of, sum(planned) AS qty FROM open_mos
    WHERE quarter = newest GROUP BY material, newest HAVING sum(planned) > 0""",
}

RUN_RATE_COLUMNS = """inventory_id, round(run_rate, 6) AS run_rate, name, total_fulfillable_quantity,
    round(est_stock_days_on_hand, 6) AS est_stock_days_on_hand, estimated_stockout_date, restock_point"""


def _material_status(planned: str) -> str:
    return f"""
    SELECT s.name, units_of_measure, round(in_stock, 6) AS in_stock, as_of AS in_stock_as_of,
           round(qty, 6) AS planned_qty, planned_as_of AS planned_qty_as_of,
           round(in_stock - qty, 6) AS inventory_remaining,
           round(in_stock / qty, 6) AS in_stock_percentage, in_stock - qty < 0 AS needs_replenished
    FROM material_stock s JOIN {planned} p ON s.material = p.material"""


SNAPSHOT_COLUMNS = """id, name, is_digital, is_case_pick, is_lot, total_fulfillable_quantity,
    total_onhand_quantity, total_committed_quantity, total_sellable_quantity, total_awaiting_quantity,
    total_exception_quantity, total_internal_transfer_quantity, total_backordered_quantity, is_active"""

_TEXT_TIME = "strftime({c}, '%Y-%m-%d %H:%M:%S')"


def _channel_counts(condition: str) -> str:
    return f"""
    SELECT CAST(channel_id AS VARCHAR) AS channel_id, channel_name, order_date,
           count(DISTINCT order_number) AS order_cnt
    FROM order_details WHERE {condition} GROUP BY ALL"""


def _cohorts(flags: str, *by: str) -> str:
    measures = ", ".join(
        f"CAST(sum(retained_{n}d) AS BIGINT) AS retained_{n}d_count,"
        f" round(CAST(100 AS DOUBLE) * sum(retained_{n}d) / count(*), 2) AS retained_{n}d_pct"
        for n in (30, 60, 90)
    )
    month = "CAST(date_trunc('month', first_order_date) AS DATE) AS cohort_month"
    return f"SELECT {', '.join((*by, month))}, count(*) AS total_customers, {measures} FROM {flags} GROUP BY ALL"


STATEMENTS: dict[str, str] = {
    "run_rate": f"SELECT {RUN_RATE_COLUMNS} FROM run_rates",
    "run_rate_details": f"""
    SELECT {RUN_RATE_COLUMNS}, active_fl, round(skew, 6) AS skew, round(kurtosis, 6) AS kurtosis
    FROM run_rates
    JOIN (SELECT inventory_id, coalesce(skewness(qty_sold), 0) AS skew,
                 coalesce(kurtosis(qty_sold), 0) AS kurtosis FROM grid GROUP BY 1) USING (inventory_id)
    JOIN (SELECT inventory_id, max(CASE WHEN sku IN (SELECT variant_sku FROM active_skus)
                                        THEN 1 ELSE 0 END) AS active_fl
          FROM order_details GROUP BY 1) USING (inventory_id)""",
    "run_rate_range": f"SELECT {RUN_RATE_COLUMNS}, partition_date FROM ranged_run_rates",
    "run_rate_mart": f"""
    SELECT {RUN_RATE_COLUMNS.replace('AS run_rate', 'AS est_daily_run_rate')}
    FROM ranged_run_rates WHERE partition_date = {AS_OF}""",
    "run_rate_mart_range": f"""
    SELECT {RUN_RATE_COLUMNS.replace('AS run_rate', 'AS est_daily_run_rate')}, partition_date
    FROM ranged_run_rates""",
    "raw_material_run_rate_range": """
    SELECT d.material AS katana_ingredient_sku, material_name AS katana_ingredient_name,
           'kg' AS katana_unit_of_measure, round(need, 6) AS daily_run_rate, round(held, 6) AS inventory_on_hand,
           CASE WHEN d.partition_date < DATE '2001-07-01' THEN DATE '2001-06-24' ELSE DATE '2001-07-01' END
             AS inventory_as_of,
           round(held / nullif(need, 0), 6) AS days_on_hand,
           round(30 * need + CASE WHEN safety_stock = 0 THEN 30 * need ELSE safety_stock END, 6)
             AS reorder_point, d.partition_date
    FROM (SELECT partition_date, material, material_name,
                 sum(run_rate * quantity_required * CASE WHEN partition_date < DATE '2001-07-01' THEN 2 ELSE 1 END) AS need
          FROM ranged_run_rates JOIN formulas ON inventory_id = p_partkey GROUP BY 1, 2, 3) d
    JOIN (SELECT *, in_stock + CASE WHEN partition_date < DATE '2001-07-01' THEN 1 ELSE 0 END AS held
          FROM material_stock, run_days) s ON s.material = d.material AND s.partition_date = d.partition_date""",
    "raw_material_status_range": """
    WITH p AS (
      SELECT d.partition_date, material, uom, quarter, sum(planned) AS qty
      FROM run_days d JOIN open_mos o
        ON quarter = (SELECT max(x.quarter) FROM open_mos x WHERE x.quarter <= d.partition_date)
      WHERE uom IS NOT NULL GROUP BY 1, 2, 3, 4 HAVING sum(planned) > 0),
    s AS (
      SELECT name, material, units_of_measure, partition_date,
             in_stock + CASE WHEN partition_date < DATE '2001-07-01' THEN 1 ELSE 0 END AS held,
             CASE WHEN partition_date < DATE '2001-07-01' THEN DATE '2001-06-24' ELSE DATE '2001-07-01' END AS day
      FROM material_stock, run_days)
    SELECT s.name, units_of_measure, round(held, 6) AS in_stock, day AS in_stock_as_of,
           round(qty, 6) AS planned_qty, quarter AS planned_qty_as_of,
           round(held - qty, 6) AS inventory_remaining, round(held / qty, 6) AS in_stock_percentage,
           held - qty < 0 AS needs_replenished, s.partition_date
    FROM s JOIN p ON s.material = p.material AND s.partition_date = p.partition_date""",
    "current_inventory_range": f"""
    SELECT {SNAPSHOT_COLUMNS}, run_day AS partition_date
    FROM (SELECT s.*, d.partition_date AS run_day FROM run_days d JOIN inventory_snapshots s
          ON s.partition_date = (SELECT max(x.partition_date) FROM inventory_snapshots x
                                 WHERE x.partition_date <= d.partition_date))""",
    "active_sku_flag": f"""
    SELECT inventory_id, max(CASE WHEN sku IN (SELECT variant_sku FROM active_skus)
                                  THEN 1 ELSE 0 END) AS active_sku_fl
    FROM order_details WHERE order_date BETWEEN {AS_OF} - 90 AND {AS_OF} GROUP BY inventory_id""",
    "flag_conflicts": """
    SELECT o_custkey AS customer_id, min(f) AS lowest, max(f) AS highest, count(*) AS row_count
    FROM (SELECT o_custkey, CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS f FROM orders)
    GROUP BY o_custkey HAVING count(DISTINCT f) > 1""",
    "daily_qty_sold": """
    SELECT inventory_id, order_date, qty_sold,
           CASE WHEN concat(p_brand, '-', p_partkey) IN (SELECT variant_sku FROM active_skus)
                THEN 1 ELSE 0 END AS active_sku_fl
    FROM sales JOIN part ON p_partkey = inventory_id""",
    "zero_filled_daily_sales": "SELECT inventory_id, order_date, qty_sold FROM grid",
    "ewm_series": """
    SELECT a.inventory_id, a.order_date, any_value(a.qty_sold) AS qty_sold,
           round(sum(b.qty_sold * pow(0.5, a.nth - b.nth)) / sum(pow(0.5, a.nth - b.nth)), 6) AS ewm
    FROM grid a JOIN grid b ON a.inventory_id = b.inventory_id AND b.nth <= a.nth GROUP BY 1, 2""",
    "demand_shape": """
    SELECT inventory_id, CAST(count(*) AS INTEGER) AS days,
           round(coalesce(skewness(qty_sold), 0), 6) AS skew,
           round(coalesce(kurtosis(qty_sold), 0), 6) AS kurtosis
    FROM grid GROUP BY inventory_id""",
    "raw_material_run_rate": """
    SELECT d.material AS katana_ingredient_sku, material_name AS katana_ingredient_name,
           'kg' AS katana_unit_of_measure, round(need, 6) AS daily_run_rate,
           in_stock AS inventory_on_hand, as_of AS inventory_as_of,
           round(in_stock / nullif(need, 0), 6) AS days_on_hand,
           round(30 * need + CASE WHEN safety_stock = 0 THEN 30 * need ELSE safety_stock END, 6)
             AS reorder_point
    FROM (SELECT material, material_name, sum(run_rate * quantity_required) AS need
          FROM rates JOIN formulas ON inventory_id = p_partkey GROUP BY 1, 2) d
    JOIN material_stock s ON s.material = d.material""",
    "raw_material_status": _material_status("planned"),
    "raw_material_status_per_material": _material_status("planned_total"),
    "asof_snapshot": f"""
    SELECT {SNAPSHOT_COLUMNS}, partition_date FROM inventory_snapshots
    WHERE partition_date = DATE '2001-06-30'""",
    "latest_snapshot": f"""
    SELECT {SNAPSHOT_COLUMNS}, partition_date FROM inventory_snapshots
    WHERE partition_date = (SELECT max(partition_date) FROM inventory_snapshots)""",
    "inventory_projection": f"SELECT {SNAPSHOT_COLUMNS} FROM inventory_snapshots",
    "missing_dates": """
    SELECT CAST(d AS DATE) AS missing_date
    FROM generate_series(DATE '2024-01-28', DATE '2024-02-03', INTERVAL 1 DAY) AS g(d)
    WHERE CAST(d AS DATE) NOT IN (SELECT CAST(ts AS DATE) FROM events)""",
    "missing_dates_by_source": f"""
    SELECT order_type, missing_date
    FROM (SELECT DISTINCT o_orderpriority AS order_type FROM orders),
         (SELECT CAST(unnest(generate_series({AS_OF} - 89, {AS_OF}, INTERVAL 1 DAY)) AS DATE)
                 AS missing_date)
    WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_orderpriority = order_type
                      AND CAST(o_orderdate AS DATE) = missing_date)""",
    "rows_per_date": "SELECT order_date, count(*) AS row_count FROM order_details GROUP BY order_date",
    "date_range_slice": """
    SELECT shipbob_order_id, inventory_id, inventory_qty, order_date FROM order_details
    WHERE order_date >= DATE '2001-06-01' AND order_date < DATE '2001-07-01'""",
    "partition_split_counts": """
    SELECT strftime(purchase_date, '%Y') AS year, strftime(purchase_date, '%m') AS month,
           strftime(purchase_date, '%d') AS day, count(*) AS row_count,
           CAST(sum(inventory_qty) AS BIGINT) AS inventory_qty
    FROM order_details GROUP BY 1, 2, 3""",
    "history_union": f"""
    SELECT * REPLACE ({_TEXT_TIME.format(c='created_date')} AS created_date,
                      {_TEXT_TIME.format(c='purchase_date')} AS purchase_date) FROM all_orders""",
    "first_orders": "SELECT email, first_order_date FROM firsts",
    "retention_flags": "SELECT * FROM flags",
    "retention_by_cohort": _cohorts("flags"),
    "retention_by_cohort_on": _cohorts("known_flags WHERE report_date = DATE '2000-03-20'"),
    "retention_by_cohort_range": _cohorts("known_flags", "report_date"),
    "retention_state_flags": """
    SELECT email, first_order_date, retained_30d, retained_60d, retained_90d FROM known_flags
    WHERE report_date = DATE '2000-04-20'""",
    "daily_order_cnt_by_channel": _channel_counts(f"order_date = {AS_OF}"),
    "daily_order_cnt_by_channel_range": _channel_counts("true"),
    "obfuscated_line_items": f"""
    SELECT upper(sha256(lower(customer_email))) AS customer_hash,
           upper(sha256(CAST(shipbob_order_id AS VARCHAR))) AS shipbob_order_id_hash,
           concat('***@', split_part(customer_email, '@', 2)) AS customer_email_masked,
           concat(left(customer_name, 1), '***') AS customer_name_masked,
           customer_address_state, customer_address_country, order_status, order_type,
           CAST(channel_id AS VARCHAR) AS channel_id, channel_name,
           CAST(product_id AS VARCHAR) AS product_id, sku, shipping_method, sku_name,
           CAST(inventory_id AS VARCHAR) AS inventory_id, inventory_name,
           CAST(inventory_qty AS VARCHAR) AS inventory_qty,
           CAST(date_trunc('month', order_date) AS DATE) AS order_month,
           {AS_OF} AS snapshot_date, CAST(created_date AS DATE) AS created_date
    FROM all_orders""",
    "daily_item_sales": "SELECT * FROM item_sales",
    "trailing_sales_30_60_90": "SELECT * FROM trailing_units",
    "inventory_status": f"""
    SELECT inventory_id, name, {_even('run_rate')} AS run_rate, total_fulfillable_quantity,
           restock_point, days AS est_stock_days_on_hand, estimated_stockout_date,
           coalesce(actual_qty_sold_last_30_days, 0) AS actual_qty_sold_last_30_days,
           coalesce(actual_qty_sold_last_60_days, 0) AS actual_qty_sold_last_60_days,
           coalesce(actual_qty_sold_last_90_days, 0) AS actual_qty_sold_last_90_days
    FROM rated LEFT JOIN trailing_units USING (inventory_id)""",
    "product_cards": """
    SELECT inventory_id, name, days AS est_stock_days_on_hand,
           CASE WHEN days < 60 THEN 'darkred' WHEN days < 70 THEN 'red'
                WHEN days <= 100 THEN 'orange' ELSE 'green' END AS band
    FROM rated WHERE days BETWEEN 10 AND 365 AND name NOT IN ('red widget', 'small ring')""",
    "lowest_stock_top10": """
    SELECT days AS est_stock_days_on_hand, name, inventory_id FROM rated
    ORDER BY 1, 2, 3 LIMIT 10""",
    "metric_bounds": "SELECT min(days) AS min_days, max(days) AS max_days FROM rated",
    "product_options": "SELECT DISTINCT name FROM rated",
    "sales_vs_run_rate": """
    SELECT i.*, round(run_rate, 6) AS run_rate, estimated_stockout_date, restock_point, name
    FROM item_sales i LEFT JOIN run_rates r ON i.inventory_id = r.inventory_id""",
    "product_daily_series": """
    WITH s AS (SELECT r.name, i.created_date, sum(i.inventory_qty) AS q
               FROM item_sales i JOIN run_rates r ON i.inventory_id = r.inventory_id GROUP BY 1, 2),
    d AS (SELECT name, CAST(unnest(generate_series(min(created_date), max(created_date),
                                                   INTERVAL 1 DAY)) AS DATE) AS created_date
          FROM s GROUP BY name)
    SELECT d.name, d.created_date, CAST(coalesce(q, 0) AS BIGINT) AS inventory_qty, daily_run_rate
    FROM d LEFT JOIN s ON s.name = d.name AND s.created_date = d.created_date
    LEFT JOIN levels l ON l.name = d.name""",
    "stock_trend": f"""
    SELECT s.id AS inventory_id, s.partition_date, s.total_fulfillable_quantity, r.name, restock_point
    FROM inventory_snapshots s LEFT JOIN run_rates r ON r.inventory_id = s.id
    WHERE s.partition_date >= {AS_OF} - 90""",
    "stock_trend_bounds": f"""
    SELECT name, x_min, x_max + 14 AS x_max, round(lo * CAST(0.95 AS DOUBLE), 6) AS y_min,
           round(hi * CAST(1.05 AS DOUBLE), 6) AS y_max, restock_point, estimated_stockout_date
    FROM (SELECT r.name, min(s.partition_date) AS x_min, max(s.partition_date) AS x_max,
                 min(s.total_fulfillable_quantity) AS lo, max(s.total_fulfillable_quantity) AS hi
          FROM inventory_snapshots s JOIN run_rates r ON r.inventory_id = s.id
          WHERE s.partition_date >= {AS_OF} - 90 GROUP BY r.name)
    JOIN levels USING (name)""",
    "alert_raw_materials": f"""
    SELECT name, round(in_stock, 6) AS in_stock, units_of_measure, as_of AS in_stock_as_of,
           planned_as_of AS planned_qty_as_of, shortage,
           printf('• %s:' || chr(10) || '  - Current stock: %.2f %s' || chr(10)
                  || '  - Minimum Quantity Required to Meet Upcoming MO''s as of %s: %s %s' || chr(10),
                  name, in_stock, units_of_measure, CAST(as_of AS VARCHAR),
                  CAST(shortage AS VARCHAR), units_of_measure) AS message
    FROM (SELECT s.*, p.planned_as_of, -{_even('in_stock - qty')} AS shortage
          FROM material_stock s JOIN planned p ON s.material = p.material WHERE in_stock < qty)""",
    "alert_finished_goods": f"""
    SELECT *, concat('• ', name, ':', chr(10), '  - Current stock: ', total_fulfillable_quantity,
                     chr(10), '  - Estimated stockout date: ', estimated_stockout_date, chr(10),
                     '  - Quantity to restock: ', quantity_to_restock, chr(10)) AS message
    FROM (SELECT inventory_id, name, total_fulfillable_quantity, estimated_stockout_date,
                 {_cut(f"run_rate * {_cut('90.0 - est_stock_days_on_hand')}")} AS restock_amount,
                 {_cut('run_rate * (90.0 - est_stock_days_on_hand)')} AS quantity_to_restock
          FROM run_rates WHERE est_stock_days_on_hand < 70)
    WHERE restock_amount > 0""",
    "validate_split": f"""
    SELECT CAST(o_orderkey AS VARCHAR) AS order_key,
           CASE WHEN error = '' THEN 'valid' ELSE 'invalid' END AS outcome, error,
           CASE WHEN o_orderpriority IN ('4-NOT SPECIFIED', '5-LOW') THEN email_address
                WHEN o_orderpriority = '2-HIGH' AND o_orderkey % 5 = 1 THEN 'o''brien@x.com'
                WHEN o_orderpriority = '2-HIGH' AND o_orderkey % 5 = 3 THEN 'ann@bücher.de'
                WHEN o_orderpriority = '2-HIGH' AND o_orderkey % 5 = 4 THEN 'josé@example.com'
                ELSE 'unknown@unknown.com' END AS email,
           CASE WHEN NOT bad_time THEN concat({STAMP}, ' 23:30:00') END AS created_at,
           concat(o_custkey, '  Main St') AS shipping_address,
           CASE WHEN negative THEN -1.0 ELSE o_totalprice END AS total_line_items_price,
           CASE WHEN NOT bad_discount THEN CAST(0 AS DOUBLE) END AS total_discounts,
           CASE WHEN NOT no_fee THEN CAST(4.75 AS DOUBLE) END AS total_shipping_fee,
           concat({STAMP}, ' 00:00:00') AS order_date
    FROM (SELECT *, concat_ws('; ',
                   CASE WHEN bad_time THEN 'created_at: not a timestamp_ntz' END,
                   CASE WHEN negative THEN 'total_line_items_price: below 0' END,
                   CASE WHEN bad_discount THEN 'total_discounts: not a double' END,
                   CASE WHEN no_fee THEN 'total_shipping_fee: required' END) AS error
          FROM faults)""",
    "validation_summary": """
    SELECT count(*) AS total_rows,
           count(*) FILTER (NOT (bad_time OR negative OR bad_discount OR no_fee)) AS valid_rows,
           count(*) FILTER (bad_time OR negative OR bad_discount OR no_fee) AS invalid_rows
    FROM faults""",
    "cleanse_orders": """
    SELECT CAST(l_orderkey AS VARCHAR) AS order_id,
           CASE WHEN l_returnflag = 'N' AND l_orderkey % 3 = 1 THEN 'a!b@x.com'
                WHEN l_returnflag IN ('R', 'N') THEN 'unknown@unknown.com'
                ELSE concat('buyer', l_suppkey, '@example.com') END AS email,
           concat(strftime(l_shipdate, '%Y-%m-%d'), ' 23:30:00') AS created_at,
           l_linenumber AS line_number,
           CASE WHEN l_linestatus = 'O' THEN concat('SKU ', l_partkey) ELSE 'No SKU' END AS sku,
           concat('Say "hi" ', chr(10), l_partkey) AS title
    FROM lineitem""",
    "nan_to_null": """
    SELECT l_orderkey, l_linenumber,
           CASE WHEN l_returnflag <> 'R' THEN l_quantity END AS quantity, round(l_tax, 6) AS tax
    FROM lineitem""",
    "parse_dates": """
    SELECT o_orderkey, CASE WHEN o_orderstatus = 'O' THEN CAST(o_orderdate AS DATE) END AS parsed_date
    FROM orders""",
    "sanitize_delimiters": """
    SELECT CAST(l_orderkey AS VARCHAR) AS order_id, l_linenumber AS line_number,
           concat('Say ''hi''; ', l_partkey) AS title,
           CASE WHEN l_linestatus = 'O' THEN concat('SKU;', l_partkey)
                WHEN l_returnflag = 'A' THEN '' END AS sku
    FROM lineitem""",
    "flatten_orders": f"""
    SELECT concat({STAMP}, ' 23:30:00') AS created_date, concat({STAMP}, ' 23:30:00') AS purchase_date,
           o_orderkey AS shipbob_order_id, CAST(o_orderkey AS VARCHAR) AS order_number,
           o_orderstatus AS order_status, o_orderpriority AS order_type,
           CASE WHEN o_orderpriority <> '5-LOW' THEN CAST(r_regionkey AS BIGINT) END AS channel_id,
           CASE WHEN o_orderpriority <> '5-LOW' THEN r_name END AS channel_name,
           product AS product_id, concat('SKU-', product) AS sku, 'Standard' AS shipping_method,
           c_name AS customer_name, email_address AS customer_email,
           concat('City ', c_nationkey) AS customer_address_city,
           n_name AS customer_address_state, r_name AS customer_address_country,
           concat('Product ', product) AS sku_name, item AS inventory_id,
           concat('Item, ', item) AS inventory_name, CAST(quantity AS BIGINT) AS inventory_qty
    FROM (SELECT *, o_custkey AS product, o_custkey AS item, 2 AS quantity FROM order_places
          UNION ALL SELECT *, o_custkey, o_orderkey, 1 FROM order_places
          UNION ALL SELECT *, o_custkey + o_orderkey, o_custkey + o_orderkey, 3 FROM order_places)
    WHERE o_orderstatus <> 'P'""",
    "flatten_completeness": """
    SELECT count(*) AS document_count, count(*) FILTER (o_orderstatus <> 'P') AS flattened_ids,
           count(*) FILTER (o_orderstatus = 'P') = 0 AS complete, count(*) AS header_ids,
           count(*) FILTER (o_orderstatus <> 'P') AS line_ids
    FROM orders""",
    "lost_ids": """
    SELECT o_orderkey AS id, 'left' AS side, what FROM orders, (VALUES ('order'), ('header')) AS w(what)
    WHERE o_orderstatus = 'P'""",
    "flatten_products": """
    SELECT p_partkey AS product_id, concat(p_brand, '-', p_partkey) AS sku, p_name AS sku_name,
           CAST(p_size AS BIGINT) AS channel_id, p_type AS channel_name, p_partkey AS inventory_id,
           p_name AS inventory_name, CAST(1 AS BIGINT) AS inventory_qty FROM part
    UNION ALL
    SELECT p_partkey, concat(p_brand, '-', p_partkey), p_name, p_size, p_type, p_partkey + 1,
           'insert', p_size FROM part""",
    "active_variants": """
    SELECT p_partkey AS product_id, p_name AS product_title, p_partkey * 10 + nth AS variant_id,
           title AS variant_title, sku AS variant_sku, CAST(qty AS DOUBLE) AS inventory_quantity,
           '2001-03-04 05:06:07' AS published_at
    FROM (SELECT *, 0 AS nth, 'small' AS title, concat(p_brand, '-', p_partkey) AS sku,
                 p_size - 10 AS qty FROM part
          UNION ALL SELECT *, 1, 'large', concat('L-', p_partkey), 25 - p_size FROM part)
    WHERE qty > 0 AND p_type <> 'ECONOMY'""",
    "flatten_store_orders": f"""
    SELECT o_orderkey AS order_id, email_address AS email,
           concat({STAMP}, 'T21:00:00-04:00') AS created_at, {STAMP} AS order_date,
           round(o_totalprice, 6) AS subtotal_price, round(o_totalprice, 6) AS total_line_items_price,
           CAST(1.25 AS DOUBLE) AS total_tax, CAST(0 AS DOUBLE) AS total_discounts,
           CASE WHEN o_orderpriority <> '5-LOW' THEN CAST(4.75 AS DOUBLE) END AS total_shipping_fee,
           round(o_totalprice, 6) AS total_price,
           CASE WHEN o_orderpriority <> '1-URGENT' THEN concat(o_custkey, ' Main St') END
             AS shipping_address,
           CASE WHEN o_orderpriority <> '1-URGENT' THEN concat('City ', c_nationkey) END
             AS shipping_city,
           CASE WHEN o_orderpriority <> '1-URGENT' THEN n_name END AS shipping_province,
           CASE WHEN o_orderpriority <> '1-URGENT' THEN r_name END AS shipping_country
    FROM order_places""",
    "flatten_store_line_items": f"""
    SELECT o_orderkey AS order_id, email_address AS email,
           concat({STAMP}, 'T21:00:00-04:00') AS created_at, {STAMP} AS order_date,
           round(price, 6) AS price, CAST(quantity AS BIGINT) AS quantity,
           concat(kind, '-', o_custkey) AS sku, concat(kind, ' item') AS title,
           CASE WHEN o_orderstatus = 'F' THEN 'default' END AS variant_title,
           concat(kind, ' of order ', o_orderkey) AS line_item_name
    FROM (SELECT *, 'main' AS kind, 2 AS quantity, o_totalprice AS price FROM order_places
          UNION ALL SELECT *, 'gift', 1, CAST(0.5 AS DOUBLE) FROM order_places)
    WHERE o_orderstatus <> 'P'""",
    "flatten_campaigns": """
    SELECT CAST(c_custkey AS VARCHAR) AS campaign_id, c_name AS name,
           CASE WHEN c_acctbal < 0 THEN 'Draft' ELSE 'Sent' END AS status,
           c_acctbal > 5000 AS archived, concat(c_mktsegment, '|', lower(c_mktsegment))
             AS included_audience,
           CASE WHEN c_mktsegment <> 'BUILDING' THEN CAST(c_nationkey AS VARCHAR) ELSE '' END
             AS excluded_audience,
           '2001-01-01T00:00:00+00:00' AS created_at,
           CASE WHEN c_acctbal >= 0 THEN '2001-01-01T00:00:00+00:00' END AS scheduled_at,
           '2001-01-01T00:00:00+00:00' AS send_time, '2001-01-01T00:00:00+00:00' AS updated_at
    FROM customer""",
    "flatten_messages": """
    SELECT CAST(event_id AS VARCHAR) AS message_id, 'email' AS channel, event_type AS label,
           concat('Hello ', user_id) AS subject,
           CASE WHEN event_type = 'view' THEN 'preview' END AS preview_text,
           'shop@example.com' AS from_email, 'Shop' AS from_label,
           'reply@example.com' AS reply_to_email, CAST(NULL AS VARCHAR) AS cc_email,
           CAST(NULL AS VARCHAR) AS bcc_email,
           CASE WHEN first THEN strftime(ts, '%Y-%m-%d %H:%M:%S')
                ELSE strftime(ts, '%Y-%m-%d 12:00:00') END AS send_time,
           strftime(ts, '%Y-%m-%d') AS created_at, strftime(ts, '%Y-%m-%d') AS updated_at
    FROM events, (VALUES (true), (false)) AS v(first) WHERE event_type <> 'error'""",
    "json_path_default": """
    SELECT event_id, CAST(regexp_extract(props, '"k": ([0-9]+)', 1) AS BIGINT) AS k,
           CAST(0 AS BIGINT) AS absent, user_id AS recipients FROM events""",
    "dimension_upsert": """
    SELECT id AS inventory_id,
           CASE WHEN changed THEN concat(p_name, ' a') ELSE p_name END AS product_name,
           CASE WHEN NOT changed OR p_type <> 'LARGE' THEN CAST(p_size AS VARCHAR) END AS size_variant,
           CASE WHEN changed THEN lower(p_brand) ELSE p_brand END AS sku_variant,
           p_type AS product_type_variant,
           NOT changed AND p_size > 40 AS limited_edition_flag,
           changed OR p_size < 5 AS seasonal_flag,
           CASE WHEN known THEN '2001-01-01 00:00:00' ELSE '2001-07-01 12:00:00' END AS created_at,
           CASE WHEN changed THEN '2001-07-01 12:00:00' ELSE '2001-01-01 00:00:00' END AS updated_at
    FROM product_states""",
    "dimension_rejects": """
    SELECT p_partkey + CASE WHEN p_type = 'PROMO' THEN 10000000 ELSE 0 END AS inventory_id,
           concat(p_name, ' ', copy) AS product_name,
           CASE WHEN p_type <> 'LARGE' THEN CAST(p_size AS VARCHAR) END AS size_variant,
           lower(p_brand) AS sku_variant, p_type AS product_type_variant,
           false AS limited_edition_flag, true AS seasonal_flag
    FROM part, (VALUES ('a'), ('b')) AS v(copy) WHERE p_size > 45""",
    "dimension_listing": """
    SELECT id AS inventory_id,
           CASE WHEN known THEN p_name ELSE concat(p_name, ' a') END AS product_name,
           CASE WHEN known THEN '2001-01-01 00:00:00' ELSE '2001-07-01 12:00:00' END AS created_at,
           count(*) OVER () AS total_products
    FROM product_states""",
    "scalar_strings": f"""
    SELECT c_custkey, concat('in_stock_', replace(lower(c_name), '#', '_')) AS tidy,
           upper(sha256(coalesce(lower(e), ''))) AS hashed,
           CASE WHEN e IS NOT NULL THEN concat('***@', split_part(e, '@', 2)) END AS email_masked,
           '***' AS not_an_email_masked, concat(left(c_name, 1), '***') AS name_masked,
           concat('a;''', c_name) AS safe, concat('a ', c_name) AS blanked,
           concat('• ', c_mktsegment, ': ', c_custkey) AS message
    FROM (SELECT *, CASE WHEN c_acctbal >= 0 THEN {EMAIL} END AS e FROM customer)""",
    "scalar_dates": f"""
    SELECT o_orderkey, d AS day, CAST(date_trunc('month', d) AS DATE) AS month,
           CAST(date_diff('day', d, {AS_OF}) AS INTEGER) AS age_days, d - 90 AS minus_90,
           d + CAST(trunc(o_totalprice / 10000) AS INTEGER) AS plus_days,
           concat({STAMP}, ' 23:30:00') AS clock, concat({STAMP}, 'T23:30:00') AS clock_t,
           d AS clock_day, strftime(d, '%Y') AS year, strftime(d, '%m') AS month_part,
           strftime(d, '%d') AS day_part, d AS composed, CAST(NULL AS DATE) AS blank_day
    FROM (SELECT *, CAST(o_orderdate AS DATE) AS d FROM orders)""",
    "scalar_math": f"""
    SELECT p_partkey, round(CAST(100 AS DOUBLE) * p_size / 48, 2) AS pct,
           round(CASE WHEN p_size = 25 THEN 0.0 ELSE least(p_retailprice / (p_size - 25), 365.0) END, 6)
             AS cover,
           round(p_retailprice / nullif(p_size - 25, 0), 6) AS quotient,
           {_cut('p_retailprice * CAST(-0.5 AS DOUBLE)')} AS cut,
           {_even('CAST(p_size AS DOUBLE) / 2')} AS half_even,
           CAST(NULL AS DOUBLE) AS not_a_number, CAST(p_size AS DOUBLE) AS a_number,
           CASE WHEN p_size * 3 < 60 THEN 'darkred' WHEN p_size * 3 < 70 THEN 'red'
                WHEN p_size * 3 <= 100 THEN 'orange' ELSE 'green' END AS band
    FROM part""",
}

VIEWS["faults"] = """
    SELECT *, o_orderstatus = 'O' AND o_orderpriority = '5-LOW' AS bad_time,
           o_orderstatus = 'F' AND o_orderpriority = '5-LOW' AS negative,
           o_orderstatus = 'P' AND o_orderpriority = '1-URGENT' AS bad_discount,
           o_orderstatus = 'P' AND o_orderpriority IN ('1-URGENT', '2-HIGH') AS no_fee
    FROM order_places"""
VIEWS["product_states"] = """
    SELECT *, p_partkey AS id, true AS known, p_type <> 'PROMO' AND p_size <= 45 AS changed FROM part
    UNION ALL SELECT *, p_partkey + 10000000, false, true FROM part
    WHERE p_type = 'PROMO' AND p_size <= 45"""


def _used(sql: str, found: dict[str, None]) -> None:
    for name, body in VIEWS.items():
        if name not in found and re.search(rf"\b(FROM|JOIN|,)\s+{name}\b", sql):
            _used(body, found)
            found[name] = None


def statement(sql: str) -> str:
    """``sql`` preceded by the views it uses."""
    found: dict[str, None] = {}
    _used(sql, found)
    if not found:
        return sql.strip()
    views = ",\n".join(f"{name} AS ({VIEWS[name]})" for name in found)
    return f"WITH {views}\nSELECT * FROM ({sql}) AS result"


def statements() -> dict[str, str]:
    return {name: statement(sql) for name, sql in STATEMENTS.items()}
