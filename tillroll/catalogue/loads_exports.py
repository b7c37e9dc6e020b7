"""Loads, exports, calendar and function queries.

Export queries write files and read them back, so what is compared is what a receiver would get.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, functions as F

from tillroll.catalogue.registry import query
from tillroll.functions.money import dec, net_qty_sum, sum_if
from tillroll.functions.text import format_date, format_decimal, hhmmss
from tillroll.functions.weeks import calendar_week, iso_week, week_end, week_stamp, week_start, weekday_no
from tillroll.plans import exports, flights, sales
from tillroll.plans.calendar import Period, bounds_from_calendar, same_length, with_offsets, within
from tillroll.sources import loads, sinks
from tillroll.sources.mart import AS_OF, EVENTS_AS_OF, Mart
from tillroll.sources.scratch import scratch_path


@query("s01_scan", """
    SELECT l_returnflag AS return_flag, l_linestatus AS line_status, count(*) AS row_count, sum(CAST(l_quantity AS DECIMAL(12,2)))::DOUBLE AS quantity
    FROM lineitem GROUP BY l_returnflag, l_linestatus""")
def _(m: Mart) -> DataFrame:
    return m.table("lineitem").groupBy(F.col("l_returnflag").alias("return_flag"), F.col("l_linestatus").alias("line_status")).agg(
        F.count("*").alias("row_count"), F.sum(dec("l_quantity")).alias("quantity")
    )


@query("s02_several_sources", """
    SELECT cashier_idx, receipts, log_lines FROM (SELECT cashier_idx, count(*) AS receipts FROM receipt GROUP BY 1)
    JOIN (SELECT cashier_idx, count(*) AS log_lines FROM till_event GROUP BY 1) USING (cashier_idx)""")
def _(m: Mart) -> DataFrame:
    sold = m.receipts.groupBy("cashier_idx").agg(F.count("*").alias("receipts"))
    logged = m.till_events.groupBy("cashier_idx").agg(F.count("*").alias("log_lines"))
    return sold.join(logged, "cashier_idx")


@query("s03_incremental_append", """
    WITH paid AS (SELECT order_no, min(created_at) AS paid_at FROM order_event WHERE status = 60 GROUP BY order_no),
    head AS (SELECT order_no, max(CASE status WHEN 50 THEN 55 WHEN 60 THEN 58 ELSE status END) AS status, max(log_date) AS log_date FROM order_event
             WHERE status <> 60 OR picker = 'P0' GROUP BY order_no),
    info AS (SELECT order_no, 'F' || max(picker) AS flight_no, CASE WHEN min(amount) < 10 THEN 'D' ELSE 'A' END AS flight_direction FROM order_event
             GROUP BY order_no HAVING min(amount) < 20)
    SELECT order_no, status, flight_no, flight_direction, strftime(paid_at, '%Y-%m-%d %H:%M:%S') AS paid_at
    FROM head JOIN info USING (order_no) JOIN paid USING (order_no)
    WHERE status >= 55 AND status <> 58 AND order_no NOT IN (SELECT order_no FROM order_event WHERE log_date < DATE '2024-01-10')""")
def _(m: Mart) -> DataFrame:
    events = m.order_events
    status = F.when(F.col("status") == 50, 55).when(F.col("status") == 60, 58).otherwise(F.col("status"))
    heads = events.filter((F.col("status") != 60) | (F.col("picker") == "P0")).groupBy("order_no").agg(F.max(status).alias("status"))
    loaded = events.filter(F.col("log_date") < F.lit(dt.date(2024, 1, 10))).select("order_no").distinct()
    per_order = events.groupBy("order_no").agg(
        F.concat(F.lit("F"), F.max("picker")).alias("FlightNumber"),
        F.when(F.min("amount") < 10, F.lit("D")).when(F.min("amount") < 20, F.lit("A")).alias("FlightDirection"),
    )
    infos = per_order.unpivot("order_no", ["FlightNumber", "FlightDirection"], "key", "value")
    fresh = loads.incremental_append(heads, loaded, ["order_no"])
    return loads.enrich_orders(fresh, infos, events, paid_status=60, open_from=55, skip=58)


@query("s04_rollup_choice", """
    SELECT 'monthly' AS rollup, sum(qty_sold - qty_return)::DOUBLE AS quantity, sum(sales_amount + return_amount)::DOUBLE AS revenue FROM sales_row
    WHERE sale_date BETWEEN DATE '1997-02-01' AND DATE '2000-02-29'
    UNION ALL SELECT 'daily', sum(qty_sold - qty_return)::DOUBLE, sum(sales_amount + return_amount)::DOUBLE FROM sales_row
    WHERE sale_date BETWEEN DATE '1997-02-01' AND DATE '2000-02-28'""")
def _(m: Mart) -> DataFrame:
    parts = []
    for name, last in (("monthly", dt.date(2000, 2, 29)), ("daily", dt.date(2000, 2, 28))):
        chosen = m.sales_rollup.between(dt.date(1997, 2, 1), last)
        parts.append(chosen.agg(F.sum("quantity").alias("quantity"), F.sum("revenue_incl_vat").alias("revenue")).select(F.lit(name).alias("rollup"), "*"))
    return parts[0].unionByName(parts[1])


@query("s05_delimited_export", """
    SELECT store_idx, sale_date::VARCHAR AS sale_date, flight_no, count(*) AS receipts, sum(amount)::DOUBLE AS amount FROM receipt GROUP BY ALL""")
def _(m: Mart) -> DataFrame:
    out = m.receipts.groupBy("store_idx", "sale_date", "flight_no").agg(F.count("*").alias("receipts"), F.sum("amount").alias("amount"))
    path = f"{scratch_path(m.spark)}/{sinks.export_name('all', AS_OF)}"
    sinks.export_csv(out, path)
    return m.spark.read.schema(out.schema).options(sep=";", header=True).csv(path)


@query("s06_locale_formats", """
    SELECT receipt_id, strftime(sale_date, '%d.%m.%Y') AS sale_date, replace(CAST(amount AS VARCHAR), '.', ',') AS amount FROM receipt""")
def _(m: Mart) -> DataFrame:
    return m.receipts.select("receipt_id", format_date("sale_date").alias("sale_date"), format_decimal("amount").alias("amount"))


_WEEK_STAMP = "strftime(date_trunc('week', {d})::DATE + 6, '%Y%m%d') || lpad(CAST(weekofyear(date_trunc('week', {d})::DATE + 6) AS VARCHAR), 2, '0')".format
_WEEK_LINES = f"""l AS (SELECT CASE WHEN list_amount <> sales_amount THEN 'OVUT' ELSE 'OVUN' END AS report_code, store_idx, {_WEEK_STAMP(d='sale_date')} AS week,
        CASE WHEN length(gtin) > 6 THEN 'E' ELSE 'P' END AS id_kind, gtin, sum(sales_excl_vat + return_excl_vat) AS net, sum(cost_amount) AS cost,
        sum(CASE WHEN unit_name = 'L' THEN (qty_sold - qty_return) * unit_amount ELSE qty_sold - qty_return END) AS qty,
        count(CASE WHEN line_no = 1 THEN 1 END) AS customers, sum(sales_vat + return_vat) AS vat, supplier_idx, lev1_id AS group_id, article_name, article_idx
    FROM receipt_row JOIN article USING (article_idx) GROUP BY report_code, store_idx, week, id_kind, gtin, supplier_idx, lev1_id, article_name, article_idx)"""
_D2 = "CAST({0} AS DECIMAL(28,2))".format
_REPORT_LINES = f"""
    WITH {_WEEK_LINES}, t AS (SELECT store_idx, week, sum(net) AS net, sum(cost) AS cost, sum(qty) AS qty, sum(customers) AS customers, sum(vat) AS vat FROM l GROUP BY ALL)
    SELECT store_idx, week, 1::BIGINT AS part, 'RIGAL95,6.0' AS line FROM t
    UNION ALL SELECT store_idx, week, 2, concat_ws(',', report_code, store_idx, week, id_kind, gtin, {_D2('net')}, {_D2('cost')}, {_D2('qty')}, customers, {_D2('vat')},
        supplier_idx, group_id, article_name) FROM l
    UNION ALL SELECT store_idx, week, 3, concat_ws(',', 'OTU', store_idx, week, 'SUM', {_D2('net')}, {_D2('cost')}, {_D2('qty')}, customers, {_D2('vat')}) FROM t"""


@query("s07_report_lines", _REPORT_LINES)
def _(m: Mart) -> DataFrame:
    lines = exports.week_sales_lines(m.receipt_rows, m.articles)
    return exports.report_lines(lines)


@query("s08_export_per_store", """
    SELECT CAST(store_idx AS VARCHAR) AS store_id, article_id, sum(qty_sold - qty_return)::DOUBLE AS qty
    FROM receipt_row JOIN article USING (article_idx) GROUP BY 1, 2""")
def _(m: Mart) -> DataFrame:
    out = m.receipt_rows.groupBy("store_idx", "article_idx").agg(net_qty_sum().alias("qty")).join(m.articles, "article_idx").select(
        F.col("store_idx").cast("string").alias("store_id"), "article_id", "qty"
    )
    path = f"{scratch_path(m.spark)}/per_store"
    sinks.export_per_store(out, path, pieces=2)
    return m.spark.read.schema("article_id string, qty decimal(23,2), store_id string").options(sep=";", header=True).csv(path)


_SETTLED = """
    l AS (SELECT store_idx, CAST(strftime(sale_date, '%Y%m') AS INTEGER) AS znr, CASE tender_id WHEN 1 THEN '1900' WHEN 3 THEN '1920' WHEN 5 THEN '1925' WHEN 6 THEN '1500' WHEN 8 THEN '1905' END AS debit_account,
        '' AS credit_account, sum(amount) AS debit, 0 AS credit FROM receipt GROUP BY ALL
      UNION ALL SELECT store_idx, CAST(strftime(sale_date, '%Y%m') AS INTEGER), '', '3000', 0, sum(amount) FROM receipt GROUP BY ALL)"""


@query("s09_revision_write", f"""
    WITH {_SETTLED}
    SELECT 'current' AS part, store_idx, znr, debit_account, credit_account, debit::DOUBLE AS debit_amount, credit::DOUBLE AS credit_amount,
        CASE WHEN znr >= 200101 THEN 2::BIGINT ELSE 1 END AS revision FROM l
    UNION ALL SELECT 'archive', store_idx, znr, debit_account, credit_account, 2 * debit::DOUBLE, credit::DOUBLE, 1 FROM l WHERE znr >= 200101""")
def _(m: Mart) -> DataFrame:
    from tillroll.plans.settlements import SettlementStore, settlement_lines

    new = settlement_lines(m.receipts)
    doubled = F.when(F.col("znr") >= 200101, F.col("debit_amount") * 2).otherwise(F.col("debit_amount")).cast("decimal(22,2)")
    store = SettlementStore(m.spark, f"{scratch_path(m.spark)}-settlements")
    store.commit(new.withColumn("debit_amount", doubled))
    store.commit(new)
    parts = [df.select(F.lit(n).alias("part"), *LINES_SHOWN) for n, df in (("current", store.current()), ("archive", store.archive()))]
    return parts[0].unionByName(parts[1])


LINES_SHOWN = ("store_idx", "znr", "debit_account", "credit_account", "debit_amount", "credit_amount", "revision")


@query("s10_empty_with_schema", """
    SELECT store_idx, article_id, sum(sales_amount)::DOUBLE AS sales_amount FROM receipt_row JOIN article USING (article_idx) WHERE store_idx = 7 GROUP BY ALL""")
def _(m: Mart) -> DataFrame:
    """The report of one store: with its parameter the rows of that store, without it none, but the same columns."""
    def report(store_idx: int | None) -> DataFrame:
        per_article = m.receipt_rows.filter(F.col("store_idx") == store_idx).groupBy("store_idx", "article_idx").agg(F.sum("sales_amount").alias("sales_amount"))
        return per_article.join(m.articles.select("article_idx", "article_id"), "article_idx").drop("article_idx")

    return loads.with_parameter(report, 7).unionByName(loads.with_parameter(report, None))


@query("s11_guarded", """
    SELECT store_idx, sale_date::VARCHAR AS sale_date, count(*) AS receipts FROM receipt
    WHERE (store_idx, sale_date) IN (SELECT store_idx, sale_date FROM receipt WHERE receipt_status = 1 AND tender_id = 1) GROUP BY store_idx, sale_date""")
def _(m: Mart) -> DataFrame:
    approved = m.receipts.filter((F.col("receipt_status") == 1) & (F.col("tender_id") == 1))
    return loads.guard_exists(m.receipts, approved, ["store_idx", "sale_date"]).groupBy("store_idx", "sale_date").agg(F.count("*").alias("receipts"))


# -- C and X ----------------------------------------------------------------------------------

_CALENDAR = """
    SELECT full_date::VARCHAR AS full_date, CAST(strftime(full_date, '%Y%m%d') AS INTEGER) AS date_key, year(full_date) AS year, quarter(full_date) AS quarter,
           month(full_date) AS month, weekofyear(full_date) AS iso_week,
           ((dayofyear(full_date) - 1 + isodow(date_trunc('year', full_date)) - 1) // 7 + 1)::BIGINT AS calendar_week, isodow(full_date) AS weekday_no,
           full_date - DATE '2001-08-01' AS relative_day,
           ((date_trunc('week', full_date)::DATE - date_trunc('week', DATE '2001-08-01')::DATE) // 7)::BIGINT AS relative_week,
           (year(full_date) - 2001) * 12 + month(full_date) - 8 AS relative_month, (year(full_date) - 2001) * 4 + quarter(full_date) - 3 AS relative_quarter,
           year(full_date) - 2001 AS relative_year, CASE WHEN month(full_date) * 100 + day(full_date) <= 801 THEN year(full_date) - 2001 END AS relative_ytd
    FROM (SELECT DISTINCT sale_date AS full_date FROM sales_row)"""


@query("c01_calendar", _CALENDAR)
def _(m: Mart) -> DataFrame:
    days = m.sales_rows.select(F.col("sale_date").alias("full_date")).distinct()
    return with_offsets(days, "full_date", AS_OF)


@query("c02_second_period", """
    SELECT article_idx, sum(CASE WHEN sale_date BETWEEN DATE '2000-02-01' AND DATE '2000-02-29' THEN sales_amount ELSE 0 END)::DOUBLE AS first_period,
           sum(CASE WHEN sale_date BETWEEN DATE '1999-02-01' AND DATE '1999-03-01' THEN sales_amount ELSE 0 END)::DOUBLE AS second_period
    FROM sales_row GROUP BY article_idx""")
def _(m: Mart) -> DataFrame:
    first = (dt.date(2000, 2, 1), dt.date(2000, 2, 29))
    second = same_length(dt.date(1999, 2, 1), *first)
    return m.sales_rows.groupBy("article_idx").agg(
        sum_if(within("sale_date", first), F.col("sales_amount")).alias("first_period"),
        sum_if(within("sale_date", second), F.col("sales_amount")).alias("second_period"),
    )


@query("c03_four_windows", """
    SELECT supplier_idx, sum(CASE WHEN sale_date BETWEEN DATE '2000-02-01' AND DATE '2000-02-29' THEN sales_amount ELSE 0 END)::DOUBLE AS period,
           sum(CASE WHEN sale_date BETWEEN DATE '2000-01-01' AND DATE '2000-02-29' THEN sales_amount ELSE 0 END)::DOUBLE AS ytd,
           sum(CASE WHEN sale_date BETWEEN DATE '1999-02-01' AND DATE '1999-02-28' THEN sales_amount ELSE 0 END)::DOUBLE AS last_year,
           sum(CASE WHEN sale_date BETWEEN DATE '1999-01-01' AND DATE '1999-02-28' THEN sales_amount ELSE 0 END)::DOUBLE AS last_ytd
    FROM sales_row WHERE sale_date BETWEEN DATE '2000-01-01' AND DATE '2000-02-29' OR sale_date BETWEEN DATE '1999-01-01' AND DATE '1999-02-28'
    GROUP BY supplier_idx""")
def _(m: Mart) -> DataFrame:
    from tillroll.plans.calendar import YearWindows

    windows = YearWindows.of(dt.date(2000, 2, 1), dt.date(2000, 2, 29))
    return m.sales_rows.filter(windows.any_of("sale_date")).groupBy("supplier_idx").agg(
        *[sum_if(within("sale_date", b), F.col("sales_amount")).alias(n) for n, b in windows.named().items()]
    )


@query("c04_standing_periods", """
    SELECT '13 weeks' AS period, count(*) AS row_count FROM sales_row WHERE sale_date BETWEEN DATE '2001-04-30' AND DATE '2001-07-29'
    UNION ALL SELECT 'previous month', count(*) FROM sales_row WHERE sale_date BETWEEN DATE '2001-07-01' AND DATE '2001-07-31'
    UNION ALL SELECT 'last 10 days', count(*) FROM sales_row WHERE sale_date BETWEEN DATE '2001-07-22' AND DATE '2001-08-01'""")
def _(m: Mart) -> DataFrame:
    from tillroll.operators.filters import in_period

    named = {
        "13 weeks": Period("R", unit="W", start=-13, duration=13), "previous month": Period("R", unit="M", start=-1, duration=1),
        "last 10 days": Period("R", unit="D", start=-10, duration=11),
    }
    parts = [
        in_period(m.sales_rows, "sale_date", p, AS_OF).agg(F.count("*").alias("row_count")).select(F.lit(n).alias("period"), "*")
        for n, p in named.items()
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("c05_week_bounds", """
    SELECT date_trunc('week', sale_date)::DATE::VARCHAR AS monday, (date_trunc('week', sale_date)::DATE + 6)::VARCHAR AS sunday, count(*) AS row_count
    FROM sales_row GROUP BY 1, 2""")
def _(m: Mart) -> DataFrame:
    return m.sales_rows.groupBy(week_start("sale_date").alias("monday"), week_end("sale_date").alias("sunday")).agg(F.count("*").alias("row_count"))


@query("x01_week_stamp", f"SELECT {_WEEK_STAMP(d='sale_date')} AS week, count(*) AS row_count FROM sales_row GROUP BY 1")
def _(m: Mart) -> DataFrame:
    return m.sales_rows.groupBy(week_stamp("sale_date").alias("week")).agg(F.count("*").alias("row_count"))


@query("x02_list_split", """
    SELECT article_idx, unnest(string_split(article_name, ' ')) AS word FROM article""")
def _(m: Mart) -> DataFrame:
    return m.articles.select("article_idx", F.explode(F.split("article_name", " ")).alias("word"))


@query("x03_report_period", """
    SELECT min(full_date)::VARCHAR AS date_from, max(full_date)::VARCHAR AS date_to FROM (SELECT DISTINCT log_date AS full_date FROM till_event)
    WHERE date_trunc('week', full_date) BETWEEN date_trunc('week', DATE '2024-01-31') - INTERVAL 2 WEEK AND date_trunc('week', DATE '2024-01-31') - INTERVAL 1 WEEK""")
def _(m: Mart) -> DataFrame:
    days = with_offsets(m.till_events.select(F.col("log_date").alias("full_date")).distinct(), "full_date", EVENTS_AS_OF)
    return bounds_from_calendar(days, F.col("relative_week").between(-2, -1))


@query("x04_line_format", """
    SELECT 'R' || ',' || receipt_id || ',' || store_idx || ',' || amount AS line FROM receipt""")
def _(m: Mart) -> DataFrame:
    return m.receipts.select(
        F.concat_ws(",", F.lit("R"), F.col("receipt_id").cast("string"), F.col("store_idx").cast("string"), F.col("amount").cast("string")).alias("line")
    )


@query("h01_scalar_functions", """
    SELECT event_no, isodow(log_date) AS weekday, weekofyear(log_date) AS iso_week,
           ((dayofyear(log_date) - 1 + isodow(date_trunc('year', log_date)) - 1) // 7 + 1)::BIGINT AS calendar_week,
           lpad(CAST(event_no * 37 // 3600 AS VARCHAR), CAST(greatest(2, length(CAST(event_no * 37 // 3600 AS VARCHAR))) AS INTEGER), '0') || ':'
             || lpad(CAST(event_no * 37 % 3600 // 60 AS VARCHAR), 2, '0') || ':' || lpad(CAST(event_no * 37 % 60 AS VARCHAR), 2, '0') AS duration,
           coalesce(TRY_CAST(event_type AS BIGINT), -1) AS numeric_id, length(rtrim(event_type || '  ')) AS text_length,
           hour(logged_at) * 100 + minute(logged_at) AS time_key
    FROM till_event""")
def _(m: Mart) -> DataFrame:
    from tillroll.functions.keys import time_key
    from tillroll.functions.text import as_bigint, sql_len

    return m.till_events.select(
        "event_no", weekday_no("log_date").alias("weekday"), iso_week("log_date").alias("iso_week"), calendar_week("log_date").alias("calendar_week"),
        hhmmss(F.col("event_no") * 37).alias("duration"), as_bigint("event_type", -1).alias("numeric_id"),
        sql_len(F.concat(F.col("event_type"), F.lit("  "))).alias("text_length"), time_key("logged_at").alias("time_key"),
    )


# -- R49-R52 ----------------------------------------------------------------------------------

_COMMA = "replace(CAST(CAST({0} AS DECIMAL(28,2)) AS VARCHAR), '.', ',')".format


@query("r49_down_pricing_export", f"""
    SELECT strftime(sale_date, '%d.%m.%Y') AS sale_date, gtin, article_name, {_COMMA('sum(cost_amount)')} AS cost, {_COMMA('sum(qty_sold)')} AS qty,
           {_COMMA('sum(discount_amount)')} AS discount, {_COMMA('sum(sales_excl_vat)')} AS net, {_COMMA('sum(sales_vat)')} AS vat, store_id
    FROM receipt_row JOIN article USING (article_idx) JOIN store USING (store_idx)
    WHERE price_type IN (8, 9) AND qty_sold <> 0 AND lev1_chain_no = 'CA' GROUP BY receipt_row.sale_date, article_idx, gtin, article_name, store_id""")
def _(m: Mart) -> DataFrame:
    return exports.down_pricing_export(m.receipt_rows, m.articles, m.stores, group="CA", columns=m.STORE_GROUP_COLUMNS)


@query("r50_week_sales_file", f"SELECT store_idx, line FROM ({_REPORT_LINES})")
def _(m: Mart) -> DataFrame:
    lines = exports.week_sales_lines(m.receipt_rows, m.articles)
    path = f"{scratch_path(m.spark)}/week_sales"
    sinks.write_report_lines(exports.report_lines(lines), path)
    return m.spark.read.schema("value string, store_idx int").text(path).select("store_idx", F.col("value").alias("line"))


@query("r51_wastage_export", f"""
    WITH k AS (SELECT store_idx, article_idx, adj_date, type_no, reason_no, sum(cost_amount * sign) AS cost, sum(qty * sign) AS qty, sum(sales_value * sign) AS value
               FROM stock_move WHERE type_no IN (2, 52) AND reason_no > 0 GROUP BY ALL)
    SELECT gtin, strftime(adj_date, '%d.%m.%Y') AS adj_date, {_COMMA('cost')} AS cost, {_COMMA('qty')} AS qty,
           CASE WHEN t.store_id IS NOT NULL THEN CASE WHEN t.lev1_legal_no = h.lev1_legal_no THEN 23 ELSE 19 END ELSE reason_no END AS reason,
           t.store_id AS to_store, {_COMMA('value')} AS value, h.store_id AS from_store
    FROM k JOIN store h ON h.store_idx = k.store_idx JOIN article a ON a.article_idx = k.article_idx
    LEFT JOIN store t ON k.type_no = 52 AND t.store_idx = k.reason_no""")
def _(m: Mart) -> DataFrame:
    return exports.wastage_export(m.stock_moves, m.articles, m.stores)


@query("r52_financial_figures", f"""
    WITH s AS (SELECT store_idx, {_WEEK_STAMP(d='sale_date')} AS week, sum(sales_excl_vat + return_excl_vat)::DOUBLE AS net, sum(sales_vat + return_vat)::DOUBLE AS vat,
                      sum(cost_amount)::DOUBLE AS cost FROM receipt_row GROUP BY 1, 2),
    p AS (SELECT store_idx, {_WEEK_STAMP(d='sale_date')} AS week, sum(amount)::DOUBLE AS paid, count(*) AS receipts FROM receipt GROUP BY 1, 2)
    SELECT * FROM s JOIN p USING (store_idx, week)""")
def _(m: Mart) -> DataFrame:
    path = f"{scratch_path(m.spark)}/{sinks.export_name('all', AS_OF, 'financial', 'txt')}"
    figures = exports.financial_figures(m.receipt_rows, m.receipts)
    sinks.export_csv(figures, path, sep=",")
    return m.spark.read.schema(figures.schema).options(sep=",", header=True).csv(path)


@query("r17_flight_sales_file", """
    SELECT store_name, count(*) AS line_count, sum(sold)::DOUBLE AS sold FROM (
        SELECT store_idx, sale_date, flight_no, sum(qty_sold - qty_return) AS sold FROM receipt_row JOIN article USING (article_idx)
        GROUP BY store_idx, sale_date, flight_no, CASE WHEN origin_code IN ('D', 'A') THEN origin_code ELSE 'X' END,
                 CASE WHEN origin_code IN ('D', 'A') THEN connected_airport END, lev1_id)
    JOIN store USING (store_idx) GROUP BY store_name""")
def _(m: Mart) -> DataFrame:
    path = f"{scratch_path(m.spark)}/flight_sales"
    out = flights.flight_sales_export(m.receipt_rows, m.articles, m.stores).filter(F.col("group_id") != "9999")
    sinks.export_csv(out, path)
    back = m.spark.read.schema(out.schema).options(sep=";", header=True).csv(path)
    return back.groupBy("store_name").agg(F.count("*").alias("line_count"), F.sum("sold").alias("sold"))

