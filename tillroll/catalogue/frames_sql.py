"""The retail mapping restated in SQL, for the independent check of every query."""

from __future__ import annotations

import re

FRAMES = {
    "article": """
        SELECT p_partkey AS article_idx, CAST(p_partkey AS VARCHAR) AS article_id, p_name AS article_name,
               CASE WHEN p_size <= 25 THEN CAST(p_partkey AS VARCHAR)
                    ELSE '70' || lpad(CAST(p_partkey AS VARCHAR), 11, '0') END AS gtin,
               p_type AS lev1_id, 'Type ' || p_type AS lev1_name,
               CASE WHEN p_size > 10 THEN p_brand END AS lev2_id,
               CASE WHEN p_size > 10 THEN 'Group ' || p_brand END AS lev2_name,
               CASE WHEN p_size > 30 THEN CAST(p_size AS VARCHAR) END AS lev3_id,
               CASE WHEN p_size > 30 THEN 'Size ' || CAST(p_size AS VARCHAR) END AS lev3_name,
               CASE WHEN p_size <= 10 THEN 1 WHEN p_size <= 30 THEN 2 ELSE 3 END AS num_levels,
               p_brand AS brand_id, p_type = 'PROMO' AS is_third_party,
               CASE WHEN p_type = 'SMALL' THEN 130 ELSE 1 END AS article_type_id,
               CASE WHEN p_type = 'LARGE' THEN 18 ELSE 0 END AS age_limit,
               CAST(p_size AS DECIMAL(10,2)) AS unit_amount,
               CASE WHEN p_type = 'MEDIUM' THEN 'L' ELSE 'PCS' END AS unit_name,
               CAST(p_retailprice AS DECIMAL(12,2)) AS retail_price
        FROM part""",
    "store": """
        SELECT n_nationkey AS store_idx, CAST(n_nationkey AS VARCHAR) AS store_id, n_name AS store_name,
               CAST(n_regionkey AS VARCHAR) AS lev1_region_no, r_name AS lev1_region_name,
               'R' || CAST(n_regionkey AS VARCHAR) || 'S' || CAST(n_nationkey AS VARCHAR) AS lev2_region_no,
               'L' || CAST(n_regionkey AS VARCHAR) AS lev1_legal_no,
               'C' || substr(r_name, 1, 1) AS lev1_chain_no,
               'D' || right(n_name, 1) AS lev1_district_no,
               'EN' || lpad(CAST(n_nationkey AS VARCHAR), 2, '0') AS airport
        FROM nation JOIN region ON n_regionkey = r_regionkey""",
    "supp": """
        SELECT s_suppkey AS supplier_idx, CAST(s_suppkey AS VARCHAR) AS supplier_id, s_name AS supplier_name,
               s_nationkey AS supplier_store_idx, s_acctbal >= 0 AS is_current,
               CAST(s_acctbal AS DECIMAL(12,2)) AS balance
        FROM supplier""",
    "line_cents": """
        SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax,
                   l_returnflag, l_linestatus, l_shipdate) AS line_pos,
               row_number() OVER (PARTITION BY l_orderkey, l_returnflag = 'R' ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount,
                   l_tax, l_returnflag, l_linestatus, l_shipdate) AS link_pos,
               CAST(round(l_extendedprice * 100) AS BIGINT) AS price_c, CAST(round(l_discount * 100) AS INTEGER) AS disc_no,
               CAST(round(l_tax * 100) AS INTEGER) AS tax_no FROM lineitem""",
    "line_raw": """
        SELECT *, CAST(l_extendedprice AS DECIMAL(12,2)) AS price, gross_c * CAST(0.01 AS DECIMAL(3,2)) AS gross,
               ((gross_c * tax_no + 50) // 100) * CAST(0.01 AS DECIMAL(3,2)) AS vat,
               ((price_c * 70 + 50) // 100) * CAST(0.01 AS DECIMAL(3,2)) AS cost,
               CAST(l_quantity AS DECIMAL(12,2)) AS qty, l_returnflag = 'R' AS is_return
        FROM (SELECT *, (price_c * (100 - disc_no) + 50) // 100 AS gross_c FROM line_cents)""",
    "sales_row": """
        SELECT l_orderkey AS receipt_id, line_pos AS line_no, l_orderkey * 1000 + line_pos AS receipt_idx,
               CAST(l_shipdate AS DATE) AS sale_date,
               CAST(strftime(l_shipdate, '%Y%m%d') AS INTEGER) AS date_key,
               l_partkey AS article_idx, l_suppkey AS supplier_idx, l_linestatus AS line_status,
               CASE WHEN is_return THEN 0 ELSE qty END AS qty_sold,
               CASE WHEN is_return THEN qty ELSE 0 END AS qty_return,
               CASE WHEN is_return THEN 0 ELSE price END AS list_amount,
               CASE WHEN is_return THEN 0 ELSE gross END AS sales_amount,
               CASE WHEN is_return THEN -gross ELSE 0 END AS return_amount,
               CASE WHEN is_return THEN 0 ELSE gross - vat END AS sales_excl_vat,
               CASE WHEN is_return THEN -(gross - vat) ELSE 0 END AS return_excl_vat,
               CASE WHEN is_return THEN 0 ELSE vat END AS sales_vat,
               CASE WHEN is_return THEN -vat ELSE 0 END AS return_vat,
               CASE WHEN is_return THEN 0 ELSE price - gross END AS discount_amount,
               cost * CASE WHEN is_return THEN -1 ELSE 1 END AS cost_amount,
               tax_no AS vat_group, disc_no AS price_type,
               CASE WHEN disc_no BETWEEN 1 AND 4 THEN disc_no END AS campaign_id,
               CASE WHEN disc_no BETWEEN 5 AND 7 THEN disc_no END AS combination_id,
               CASE WHEN disc_no >= 8 THEN disc_no END AS reduction_id
        FROM line_raw""",
    "receipt": """
        SELECT o_orderkey AS receipt_id, o_custkey AS cashier_idx, CAST(o_orderdate AS DATE) AS sale_date,
               CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) AS date_key, o_orderdate AS sold_at,
               o_orderstatus AS order_status,
               CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 5 ELSE 2 END AS receipt_status,
               CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 1 WHEN '2' THEN 3 WHEN '3' THEN 5 WHEN '4' THEN 6
                    WHEN '5' THEN 8 END AS tender_id,
               CAST(o_totalprice AS DECIMAL(12,2)) AS amount,
               CASE WHEN o_orderstatus = 'O' THEN 'D' WHEN o_orderstatus = 'F' THEN 'A'
                    WHEN o_orderpriority <> '1-URGENT' THEN '' END AS origin_code,
               'X' || substr(o_orderpriority, 1, 1) AS connected_airport,
               c_name AS cashier_name, c_nationkey AS store_idx, c_mktsegment AS till_id,
               CASE c_mktsegment WHEN 'BUILDING' THEN 1 WHEN 'HOUSEHOLD' THEN 2 WHEN 'FURNITURE' THEN 3
                    WHEN 'AUTOMOBILE' THEN 4 ELSE 9 END AS sub_tender_id,
               CASE WHEN o_orderpriority <> '5-LOW' THEN 'NOK' WHEN c_mktsegment = 'BUILDING' THEN 'EUR'
                    WHEN c_mktsegment = 'HOUSEHOLD' THEN 'USD' WHEN c_mktsegment = 'FURNITURE' THEN 'GBP'
                    WHEN c_mktsegment = 'AUTOMOBILE' THEN 'SEK' ELSE 'DKK' END AS currency,
               CAST(CASE WHEN o_orderpriority <> '5-LOW' THEN 1 WHEN c_mktsegment = 'BUILDING' THEN 11.50
                    WHEN c_mktsegment = 'HOUSEHOLD' THEN 10.50 WHEN c_mktsegment = 'FURNITURE' THEN 13.25
                    WHEN c_mktsegment = 'AUTOMOBILE' THEN 0.98 ELSE 0 END AS DECIMAL(6,2)) AS exchange_rate,
               substr(c_mktsegment, 1, 2) || lpad(CAST(c_nationkey AS VARCHAR), 3, '0') AS flight_no,
               'EN' || lpad(CAST(c_nationkey AS VARCHAR), 2, '0') AS local_airport
        FROM orders JOIN customer ON o_custkey = c_custkey""",
    "receipt_row": """
        SELECT s.* EXCLUDE (sale_date, date_key), r.* EXCLUDE (receipt_id)
        FROM sales_row s JOIN receipt r ON s.receipt_id = r.receipt_id""",
    "collected": """
        SELECT receipt_id AS order_no, store_idx, cashier_idx, cashier_name, sold_at AS collect_start,
               sale_date AS collect_date,
               CASE order_status WHEN 'F' THEN 60 WHEN 'O' THEN 50 ELSE 20 END AS status,
               flight_no, origin_code AS flight_direction, amount AS actual_amount
        FROM receipt WHERE tender_id = 3""",
    "order_line": """
        SELECT l_orderkey AS order_no, line_pos AS line_no, link_pos AS link_no, l_partkey AS article_idx, l_suppkey AS supplier_idx,
               qty AS ordered_qty,
               CASE WHEN l_linestatus = 'O' THEN qty - l_linenumber ELSE qty END AS received_qty,
               price AS line_price, gross AS delivered_amount,
               CASE l_returnflag WHEN 'R' THEN 60 WHEN 'A' THEN 10 ELSE 80 END AS line_status,
               is_return AS is_substitute
        FROM line_raw""",
    "till_event": """
        SELECT event_id AS event_no, ts AS logged_at, CAST(ts AS DATE) AS log_date, CAST(ts AS DATE) - 8218 AS business_date, user_id AS cashier_idx,
               event_type, CAST(value AS DECIMAL(12,2)) AS amount,
               CAST(regexp_extract(props, '([0-9]+)', 1) AS INTEGER) AS detail
        FROM events""",
    "payment": """
        SELECT event_no AS payment_no, logged_at, log_date, business_date, CAST(strftime(log_date, '%Y%m%d') AS INTEGER) AS date_key,
               hour(logged_at) * 100 + minute(logged_at) AS time_key, cashier_idx, c_name AS cashier_name,
               c_nationkey AS store_idx, c_mktsegment AS till_id, event_type, detail, amount,
               CASE event_type WHEN 'view' THEN 1 WHEN 'click' THEN 3 WHEN 'purchase' THEN 22 WHEN 'signup' THEN 2
                    WHEN 'error' THEN 5 END AS tender_id,
               CASE WHEN detail < 25 THEN 1 WHEN detail < 50 THEN 2 WHEN detail < 75 THEN 3 ELSE 9 END AS sub_tender_id,
               CASE WHEN detail < 80 THEN 1 WHEN detail < 90 THEN 5 ELSE 2 END AS receipt_status
        FROM till_event JOIN customer ON cashier_idx = c_custkey""",
    "age_check": """
        SELECT payment_no, logged_at, log_date, cashier_idx, cashier_name, store_idx, till_id, amount,
               event_type = 'signup' AS approved,
               CASE WHEN event_type = 'signup' THEN detail // 13 + 1 ELSE detail // 9 + 50 END AS reason_no
        FROM payment WHERE event_type IN ('signup', 'error')""",
    "accumulation": """
        SELECT store_idx, till_id, cashier_idx, cashier_name, log_date, business_date, amount,
               CASE event_type WHEN 'purchase' THEN 1 WHEN 'error' THEN 5
                    WHEN 'click' THEN CASE WHEN detail < 50 THEN 7 ELSE 6 END
                    WHEN 'signup' THEN CASE WHEN detail < 50 THEN 11 ELSE 19 END
                    ELSE CASE WHEN detail < 50 THEN 10 ELSE 13 END END AS accumulation_id
        FROM payment""",
    "order_event": """
        SELECT CAST(cashier_idx AS VARCHAR) || '-' || strftime(log_date, '%Y%m%d') AS order_no, event_no AS tracking_no,
               logged_at AS created_at, log_date,
               CASE event_type WHEN 'view' THEN 40 WHEN 'purchase' THEN 50 WHEN 'click' THEN 60 ELSE 20 END AS status,
               'P' || CAST(detail // 25 AS VARCHAR) AS picker, amount
        FROM till_event""",
    "bottle": """
        SELECT cashier_idx * 100 + detail AS voucher_no, cashier_idx, log_date,
               CASE event_type WHEN 'view' THEN 90305 WHEN 'click' THEN 90306 ELSE 90307 END AS trans_type, amount
        FROM till_event WHERE event_type IN ('view', 'click', 'purchase')""",
    "stock_move": """
        SELECT l_suppkey AS supplier_idx, CAST(l_shipdate AS DATE) AS adj_date, l_partkey AS article_idx,
               CASE l_returnflag WHEN 'N' THEN 1 WHEN 'R' THEN 51
                    ELSE CASE WHEN l_linestatus = 'F' THEN 2 ELSE 52 END END AS type_no,
               l_linenumber AS reason_no, CASE WHEN l_linenumber <= 4 THEN -1 ELSE 1 END AS sign, qty,
               cost AS cost_amount, price AS sales_value, s_nationkey AS store_idx
        FROM line_raw JOIN supplier ON l_suppkey = s_suppkey""",
    "count_line": """
        SELECT CAST(strftime(l_shipdate, '%Y%m') AS INTEGER) AS count_no, l_partkey AS article_idx,
               qty AS in_stock_qty, qty - (l_linenumber - 4) AS counted_qty,
               CASE WHEN l_linestatus = 'F' THEN 80 ELSE 70 END AS line_status, s_nationkey AS store_idx
        FROM line_raw JOIN supplier ON l_suppkey = s_suppkey""",
    "article_link": """
        SELECT p_partkey AS master_idx, p_partkey - 1 AS linked_idx, 6 AS link_qty
        FROM part WHERE p_size > 45 AND p_partkey > 0""",
    "system_total": """
        SELECT store_idx, CAST(strftime(sale_date, '%Y%m') AS INTEGER) AS znr, till_id, cashier_idx, cashier_name,
               tender_id, exchange_rate, sum(amount) AS amount, count(*) AS transactions,
               min(sale_date) AS first_date, max(sale_date) AS last_date
        FROM receipt GROUP BY ALL""",
    "counting": """
        SELECT *, 'B-' || CAST(store_idx AS VARCHAR) || '-' || CAST(count_no AS VARCHAR) AS bag_id FROM (
            SELECT store_idx, CAST(strftime(sale_date, '%Y%m') AS INTEGER) AS znr, till_id, tender_id,
                   l_linenumber AS count_no, sum(price) AS amount, max(cashier_idx) AS counted_by
            FROM line_raw JOIN receipt ON l_orderkey = receipt_id GROUP BY ALL)""",
    "bank": """
        SELECT store_idx, till_id, tender_id, sub_tender_id, sale_date, count(*) AS transactions, sum(amount) AS amount
        FROM receipt WHERE tender_id IN (3, 5) AND order_status IN ('F', 'P') GROUP BY ALL""",
}


def _needed(text: str) -> list[str]:
    """Frames a statement mentions, each after the frames it is built on."""
    found: list[str] = []
    for name in FRAMES:
        if re.search(rf"\b{name}\b", text):
            for inner in _needed(FRAMES[name]) if name not in found else []:
                if inner not in found:
                    found.append(inner)
            if name not in found:
                found.append(name)
    return found


def with_frames(body: str) -> str:
    """Prefix a statement with the definitions of the frames it uses."""
    body = body.strip()
    names = _needed(body)
    if not names:
        return body
    definitions = ",\n".join(f"{n} AS ({FRAMES[n].strip()})" for n in names)
    if body[:5].upper() == "WITH ":
        return f"WITH {definitions},\n{body[5:]}"
    return f"WITH {definitions}\n{body}"
