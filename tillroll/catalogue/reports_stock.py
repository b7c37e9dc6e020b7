"""Stock, counts and order picking."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame

from tillroll.catalogue.registry import query
from tillroll.plans import picking, stock
from tillroll.sources.mart import Mart


@query("r06_destruction_by_reason", """
    SELECT article_id, article_name, unit_name, reason_no, sum(qty)::DOUBLE AS qty, sum(cost_amount)::DOUBLE AS cost_amount
    FROM stock_move JOIN article USING (article_idx) WHERE type_no = 2 AND reason_no IN (2, 3, 5) GROUP BY ALL""")
def _(m: Mart) -> DataFrame:
    return stock.destruction_by_reason(m.stock_moves, m.articles, reasons="2,3,5")


_SHRINKAGE = """
    WITH d AS (SELECT article_idx, adj_date, sum(CASE WHEN type_no = 51 THEN qty * sign ELSE 0 END) AS counted,
                      sum(CASE WHEN type_no = 52 THEN qty * sign ELSE 0 END) AS difference
               FROM stock_move WHERE type_no IN (51, 52) GROUP BY ALL),
    p AS (SELECT article_idx, max_by(counted, adj_date) AS counted_qty, min_by(counted - difference, adj_date) AS in_stock_qty,
                 sum(difference) AS difference_qty FROM d GROUP BY article_idx)
    SELECT article_id, article_name, coalesce(lev2_id, lev1_id) AS group_id, coalesce(lev2_name, lev1_name) AS group_name, unit_name,
           counted_qty::DOUBLE AS counted_qty, in_stock_qty::DOUBLE AS in_stock_qty, difference_qty::DOUBLE AS difference_qty
    FROM p JOIN article USING (article_idx) WHERE {cond}"""


@query("r07_shrinkage", _SHRINKAGE.format(cond="difference_qty < 0"))
def _(m: Mart) -> DataFrame:
    return stock.shrinkage(m.stock_moves, m.articles, report_type=1)


@query("r07_surplus", _SHRINKAGE.format(cond="difference_qty > 0"))
def _(m: Mart) -> DataFrame:
    return stock.shrinkage(m.stock_moves, m.articles, report_type=2)


@query("r16_pickup_by_flight", """
    SELECT store_idx, order_no, cashier_name, flight_no, collect_date::VARCHAR AS collect_date, strftime(collect_start, '%H:%M') AS collect_time
    FROM collected WHERE status BETWEEN 50 AND 59 AND flight_no IN ('BU001', 'HO003', 'MA012')""")
def _(m: Mart) -> DataFrame:
    return picking.pickup_by_flight(m.collected_orders, flights="BU001,HO003,MA012")


@query("r18_end_of_day_stock", """
    SELECT store_id, store_name, article_id, gtin, sum(qty * sign)::DOUBLE AS qty, adj_date::VARCHAR AS status_date
    FROM stock_move JOIN article USING (article_idx) JOIN store USING (store_idx) GROUP BY store_id, store_name, article_id, gtin, adj_date""")
def _(m: Mart) -> DataFrame:
    return stock.end_of_day_stock(m.stock_moves, m.stores, m.articles)


@query("r19_stock_movements", """
    WITH k AS (SELECT store_idx, article_idx, supplier_idx, adj_date, type_no, reason_no, sum(qty * sign) AS qty, sum(cost_amount * sign) AS cost
               FROM stock_move GROUP BY ALL)
    SELECT store_name, article_id, article_name, gtin, supplier_name, adj_date::VARCHAR AS adj_date, type_no, reason_no, qty::DOUBLE AS qty,
           cost::DOUBLE / coalesce(nullif(qty::DOUBLE, 0), 1) AS unit_cost
    FROM k LEFT JOIN store s ON s.store_idx = k.store_idx AND s.store_idx >= 0 LEFT JOIN article a ON a.article_idx = k.article_idx AND a.article_idx >= 0
    LEFT JOIN supp u ON u.supplier_idx = k.supplier_idx AND u.supplier_idx >= 0""")
def _(m: Mart) -> DataFrame:
    return stock.stock_movements(m.stock_moves, m.stores, m.articles, m.suppliers)


@query("r33_outside_assortment", """
    WITH q AS (SELECT article_idx, sum(qty * sign) AS stock_qty FROM stock_move GROUP BY article_idx HAVING sum(qty * sign) > 0)
    SELECT DISTINCT article_id, replace(article_name, ',', '|') AS article_name, stock_qty::DOUBLE AS stock_qty FROM q JOIN article USING (article_idx)
    WHERE article_idx NOT IN (SELECT article_idx FROM sales_row WHERE sale_date >= DATE '2001-08-01')""")
def _(m: Mart) -> DataFrame:
    return stock.outside_assortment(m.stock_moves, m.sales_rows, m.articles, since=dt.date(2001, 8, 1))


@query("r36_wastage_extract", """
    WITH f AS (SELECT * FROM stock_move WHERE reason_no IN (1, 4, 6)),
    d AS (SELECT adj_date, article_idx, sum(CASE WHEN type_no = 2 THEN cost_amount * sign ELSE 0 END) AS registered_loss_cost,
                 sum(CASE WHEN type_no = 52 THEN cost_amount * sign ELSE 0 END) AS unregistered_loss_cost,
                 sum(CASE WHEN type_no IN (2, 52) THEN qty * sign ELSE 0 END) AS loss_qty,
                 sum(CASE WHEN type_no IN (2, 52) THEN cost_amount * sign ELSE 0 END) AS loss_cost,
                 sum(CASE WHEN type_no = 1 THEN -qty * sign ELSE 0 END) AS sold_qty,
                 sum(CASE WHEN type_no = 1 THEN -sales_value * sign ELSE 0 END) AS sold_value,
                 sum(CASE WHEN type_no = 1 THEN -cost_amount * sign ELSE 0 END) AS sold_cost FROM f GROUP BY ALL)
    SELECT adj_date::VARCHAR AS adj_date, article_id, article_name, gtin, lev2_id, lev2_name, registered_loss_cost::DOUBLE AS registered_loss_cost,
           unregistered_loss_cost::DOUBLE AS unregistered_loss_cost, loss_qty::DOUBLE AS loss_qty, loss_cost::DOUBLE AS loss_cost,
           sold_qty::DOUBLE AS sold_qty, sold_value::DOUBLE AS sold_value, sold_cost::DOUBLE AS sold_cost,
           (sold_value - sold_cost)::DOUBLE AS gross_profit, (sold_value - sold_cost + loss_cost)::DOUBLE AS gross_realized
    FROM d JOIN article USING (article_idx) WHERE article_idx IN (SELECT article_idx FROM f WHERE type_no IN (2, 52) AND qty <> 0)""")
def _(m: Mart) -> DataFrame:
    return stock.wastage_extract(m.stock_moves, m.articles, loss_reasons=(1, 4, 6))


_COUNT = """
    WITH c AS (SELECT count_no, coalesce(linked_idx, article_idx) AS article_idx, sum(in_stock_qty * coalesce(link_qty, 1)) AS in_stock_qty,
                      sum(counted_qty * coalesce(link_qty, 1)) AS counted_qty
               FROM count_line LEFT JOIN article_link ON master_idx = article_idx WHERE line_status = 80 GROUP BY 1, 2)
    SELECT count_no, lev3_id, lev3_name, {names} sum(in_stock_qty)::DOUBLE AS in_stock_qty, sum(counted_qty)::DOUBLE AS counted_qty,
           sum(in_stock_qty * retail_price)::DOUBLE AS in_stock_value, sum(counted_qty * retail_price)::DOUBLE AS counted_value,
           max(retail_price)::DOUBLE AS unit_cost, (sum(counted_qty) - sum(in_stock_qty))::DOUBLE AS diff_qty,
           (sum(counted_qty * retail_price) - sum(in_stock_qty * retail_price))::DOUBLE AS diff_value
    FROM c JOIN article USING (article_idx) GROUP BY count_no, {names} lev3_id, lev3_name {having}"""


@query("r37_count_against_book", _COUNT.format(names="article_id, article_name,", having="HAVING sum(in_stock_qty) <> sum(counted_qty)"))
def _(m: Mart) -> DataFrame:
    return stock.count_against_book(m.count_lines, m.article_links, m.articles, only_changed=True)


@query("r37_count_by_group", _COUNT.format(names="", having=""))
def _(m: Mart) -> DataFrame:
    return stock.count_against_book(m.count_lines, m.article_links, m.articles, by_group=True)


@query("r41_still_to_pick", """
    SELECT store_idx, article_id, article_name, gtin, unit_name, sum(ordered_qty)::DOUBLE AS ordered_qty
    FROM order_line JOIN collected USING (order_no) JOIN article USING (article_idx) WHERE status IN (10, 20) AND line_status = 10 GROUP BY ALL""")
def _(m: Mart) -> DataFrame:
    return picking.still_to_pick(m.collected_orders, m.order_lines, m.articles)


@query("r41_orders_of_article", """
    SELECT order_no, l.line_no, article_idx, ordered_qty::DOUBLE AS ordered_qty, store_idx, cashier_name, collect_date::VARCHAR AS collect_date,
           (SELECT count(*) FROM order_line b WHERE b.order_no = l.order_no AND b.link_no = l.link_no AND b.is_substitute) AS substitutes
    FROM order_line l JOIN collected USING (order_no) WHERE line_status = 10""")
def _(m: Mart) -> DataFrame:
    return picking.orders_of_article(m.collected_orders, m.order_lines)


@query("r42_picking_differences", """
    WITH p AS (SELECT l.*, store_idx, cashier_name, collect_date FROM order_line l JOIN collected USING (order_no) WHERE line_status IN (60, 70, 80))
    SELECT order_no, line_no, (received_qty - ordered_qty)::DOUBLE AS qty_diff, 0::DOUBLE AS price_diff,
           ((received_qty - ordered_qty) * line_price)::DOUBLE AS result, store_idx, cashier_name, collect_date::VARCHAR AS collect_date
    FROM p WHERE received_qty <> ordered_qty
    UNION ALL SELECT p.order_no, p.line_no, 0, (b.line_price - p.line_price)::DOUBLE, (p.received_qty * (b.line_price - p.line_price))::DOUBLE,
           store_idx, cashier_name, collect_date::VARCHAR
    FROM p JOIN order_line b ON b.order_no = p.order_no AND b.link_no = p.link_no AND b.is_substitute AND NOT p.is_substitute WHERE b.line_price > p.line_price""")
def _(m: Mart) -> DataFrame:
    return picking.picking_differences(m.collected_orders, m.order_lines)


@query("r43_pick_list", """
    SELECT order_no, store_idx, lev2_name AS department,
           strftime(collect_start, '%H:%M') || '-' || strftime(collect_start + INTERVAL 1 HOUR, '%H:%M') AS slot,
           article_id, article_name, unit_name, ordered_qty::DOUBLE AS ordered_qty, count(*) AS line_count
    FROM order_line JOIN collected USING (order_no) LEFT JOIN article USING (article_idx)
    WHERE status IN (10, 20) AND line_status = 10 AND NOT is_substitute GROUP BY ALL""")
def _(m: Mart) -> DataFrame:
    return picking.pick_list(m.collected_orders, m.order_lines, m.articles)


@query("r44_not_picked", """
    SELECT store_idx, order_no, article_id, article_name, unit_name, sum(ordered_qty)::DOUBLE AS ordered_qty
    FROM order_line JOIN collected USING (order_no) JOIN article USING (article_idx) WHERE status = 50 AND line_status = 10 GROUP BY ALL""")
def _(m: Mart) -> DataFrame:
    return picking.not_picked(m.collected_orders, m.order_lines, m.articles, order_status=50)


_PICK_TIMES = """
    WITH s AS (SELECT order_no, picker, created_at, coalesce(
            (SELECT min_by(p.created_at, p.tracking_no) FROM order_event p WHERE p.order_no = e.order_no AND p.status = 50 AND p.tracking_no > e.tracking_no),
            (SELECT min_by(p.created_at, p.tracking_no) FROM order_event p WHERE p.order_no = e.order_no AND p.status = 60 AND p.tracking_no > e.tracking_no
                AND p.tracking_no < (SELECT max(x.tracking_no) FROM order_event x WHERE x.order_no = e.order_no AND x.status = 40))) AS stop
        FROM order_event e WHERE status = 40),
    t AS (SELECT order_no, CASE WHEN grouping(picker) = 1 THEN 'Total' ELSE picker END AS picker, min(created_at) AS started, max(stop) AS stopped,
                 coalesce(sum(date_diff('second', created_at, stop)), 0)::BIGINT AS seconds_used
          FROM s GROUP BY ROLLUP (order_no, picker) HAVING grouping(order_no) = 0),
    d AS (SELECT order_no, count(*) AS delivered_lines, sum(amount)::DOUBLE AS delivered_amount FROM order_event WHERE status = 60 GROUP BY order_no)
    SELECT order_no, picker, strftime(started, '%Y-%m-%d %H:%M:%S') AS started, strftime(coalesce(stopped, started), '%Y-%m-%d %H:%M:%S') AS stopped,
           seconds_used, lpad((seconds_used // 3600)::VARCHAR, 2, '0') || ':' || lpad((seconds_used % 3600 // 60)::VARCHAR, 2, '0') || ':'
           || lpad((seconds_used % 60)::VARCHAR, 2, '0') AS time_used, delivered_lines, delivered_amount
    FROM t JOIN d USING (order_no)"""


@query("r45_pick_times", _PICK_TIMES)
def _(m: Mart) -> DataFrame:
    return picking.pick_time_report(m.order_events)


@query("r46_order_overview", """
    SELECT order_no, store_idx, cashier_name, collect_date::VARCHAR AS collect_date, sum(ordered_qty)::DOUBLE AS ordered_qty, count(*) AS line_count
    FROM order_line JOIN collected USING (order_no) WHERE status = 20 GROUP BY ALL""")
def _(m: Mart) -> DataFrame:
    return picking.order_overview(m.collected_orders, m.order_lines, order_status=20)


_PREVIOUS = """
    WITH f AS (SELECT c.*, a.{level} AS level_id, unit_name, retail_price FROM count_line c JOIN article a USING (article_idx) WHERE counted_qty <> 0),
    now AS (SELECT level_id, unit_name, sum(counted_qty) AS q, sum(counted_qty * retail_price) AS v FROM f WHERE count_no = 200006 GROUP BY ALL),
    old AS (SELECT level_id, unit_name, sum(counted_qty) AS q, sum(counted_qty * retail_price) AS v FROM f
            WHERE count_no = (SELECT max(count_no) FROM count_line WHERE count_no < 200006) GROUP BY ALL)
    SELECT now.level_id, now.unit_name, now.q::DOUBLE AS counted_qty, now.v::DOUBLE AS counted_value,
           coalesce(now.q::DOUBLE / nullif(coalesce(old.q, 0)::DOUBLE, 0), 0) AS qty_ratio,
           coalesce(now.v::DOUBLE / nullif(coalesce(old.v, 0)::DOUBLE, 0), 0) AS value_ratio
    FROM now LEFT JOIN old ON old.level_id IS NOT DISTINCT FROM now.level_id AND old.unit_name = now.unit_name"""


@query("r47_against_previous_count", _PREVIOUS.format(level="article_id"))
def _(m: Mart) -> DataFrame:
    return stock.against_previous_count(m.count_lines, m.articles, count_no=200006)


@query("r47_against_previous_by_level", _PREVIOUS.format(level="lev2_id"))
def _(m: Mart) -> DataFrame:
    return stock.against_previous_count(m.count_lines, m.articles, count_no=200006, level="lev2_id")


@query("r48_sold_not_counted", """
    SELECT article_id, article_name, gtin, 0::BIGINT AS in_stock_qty, max(adj_date)::VARCHAR AS last_sold
    FROM stock_move JOIN article USING (article_idx) WHERE type_no = 1 AND adj_date BETWEEN DATE '2000-01-01' AND DATE '2000-06-30'
      AND article_idx NOT IN (SELECT article_idx FROM count_line WHERE count_no = 200006) GROUP BY ALL""")
def _(m: Mart) -> DataFrame:
    return stock.sold_not_counted(
        m.stock_moves, m.count_lines, m.articles, count_no=200006, bounds=(dt.date(2000, 1, 1), dt.date(2000, 6, 30))
    )
