"""Sales, flights, comparison, campaigns."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, functions as F

from tillroll.catalogue.registry import query
from tillroll.operators.joins import ancestors
from tillroll.plans import campaigns, compare, flights, sales
from tillroll.plans.calendar import Period, YearWindows
from tillroll.sources.mart import AS_OF, Mart

_MEASURES = """sum(qty_sold - qty_return)::DOUBLE AS quantity, sum(sales_amount + return_amount)::DOUBLE AS revenue_incl_vat,
    sum(sales_excl_vat + return_excl_vat)::DOUBLE AS revenue, sum(sales_excl_vat + return_excl_vat - cost_amount)::DOUBLE AS gross_profit,
    sum(list_amount + return_amount)::DOUBLE AS price, sum(cost_amount)::DOUBLE AS cost_of_goods,
    sum(sales_vat + return_vat)::DOUBLE AS revenue_vat"""
_U, _D = "(line_status = 'F')::BIGINT", "(price_type = 0)::BIGINT"
_CONFIG_PRODUCT = f"min({_U}) + min({_U}) * (min({_D}) + max({_D})) AS config"
_CONFIG_SUM = f"min({_U}) + min({_D}) + max({_D}) AS config"
_FLAGS = f"min({_U}) AS use_derived, min({_D}) AS min_derived_used, max({_D}) AS max_derived_used"
_NOT_EMPTY = "HAVING sum(sales_amount + return_amount) <> 0 OR sum(qty_sold - qty_return) <> 0"

Y1999 = (dt.date(1999, 1, 1), dt.date(1999, 12, 31))


@query("r01_top_articles", """
    SELECT article_name, gtin, sum(qty_sold - qty_return)::DOUBLE AS sold_qty, sum(sales_excl_vat + return_excl_vat)::DOUBLE AS net_sales,
           sum(sales_excl_vat + return_excl_vat - cost_amount)::DOUBLE AS gross_profit
    FROM sales_row JOIN article USING (article_idx) WHERE NOT is_third_party GROUP BY article_name, gtin
    ORDER BY sum(sales_excl_vat + return_excl_vat) DESC, article_name, gtin LIMIT 50""")
def _(m: Mart) -> DataFrame:
    return sales.top_articles(m.sales_rows, m.articles)


@query("r01_bottom_articles", """
    SELECT article_name, gtin, sum(qty_sold - qty_return)::DOUBLE AS sold_qty, sum(sales_excl_vat + return_excl_vat)::DOUBLE AS net_sales,
           sum(sales_excl_vat + return_excl_vat - cost_amount)::DOUBLE AS gross_profit
    FROM sales_row JOIN article USING (article_idx) WHERE NOT is_third_party AND supplier_idx = 11
      AND 'Brand#9' IN (lev1_id, lev2_id, lev3_id) AND sale_date BETWEEN DATE '1996-01-01' AND DATE '2000-12-31'
    GROUP BY article_name, gtin ORDER BY sum(sales_excl_vat + return_excl_vat - cost_amount), article_name, gtin LIMIT 20""")
def _(m: Mart) -> DataFrame:
    return sales.top_articles(
        m.sales_rows, m.articles, bounds=(dt.date(1996, 1, 1), dt.date(2000, 12, 31)), supplier_idx=11, group="Brand#9",
        order_by="LowGrossProfit", n=20,
    )


@query("r02_top_by_store_and_direction", """
    SELECT store_id, store_name, article_name, max(gtin) AS gtin, sum(qty_sold - qty_return)::DOUBLE AS sold_qty,
           sum(sales_excl_vat + return_excl_vat)::DOUBLE AS net_sales, sum(sales_excl_vat + return_excl_vat - cost_amount)::DOUBLE AS gross_profit
    FROM receipt_row JOIN article USING (article_idx) JOIN store USING (store_idx)
    WHERE NOT is_third_party AND origin_code = 'D' AND (lev1_region_no IN ('2', '7') OR store_id IN ('2', '7'))
    GROUP BY store_id, store_name, article_name ORDER BY sum(qty_sold - qty_return) DESC, store_id, article_name LIMIT 100""")
def _(m: Mart) -> DataFrame:
    from tillroll.operators.filters import store_group

    chosen = store_group(m.stores, "2,7", m.STORE_GROUP_COLUMNS)
    return sales.top_articles_by_store(m.receipt_rows, chosen, m.articles, direction=1, order_by="TopQuantity", n=100)


_FLIGHT_SQL = """
    SELECT {flight} AS flight_no, {kind} AS flight_type, article_name, sum(qty_sold - qty_return)::DOUBLE AS sold,
           sum(sales_excl_vat + return_excl_vat)::DOUBLE AS revenue, count(CASE WHEN line_no = 1 THEN 1 END) AS customers
    FROM receipt_row JOIN article USING (article_idx) WHERE {cond} GROUP BY 1, 2, 3"""


@query("r03_flight_revenue", _FLIGHT_SQL.format(
    flight="CASE WHEN origin_code IN ('D', 'A') THEN flight_no || ' - ' || connected_airport ELSE flight_no END",
    kind="CASE origin_code WHEN 'D' THEN 'Departure' WHEN 'A' THEN 'Arrival' ELSE '' END",
    cond="local_airport IN ('EN03', 'X2') OR connected_airport IN ('EN03', 'X2')"))
def _(m: Mart) -> DataFrame:
    return flights.flight_revenue(m.receipt_rows, m.articles, by_flight=True, airports="EN03,X2")


@query("r03_flight_revenue_by_article", _FLIGHT_SQL.format(
    flight="CAST(NULL AS VARCHAR)", kind="CAST(NULL AS VARCHAR)", cond="origin_code = 'A' AND flight_no IN ('BU007', 'HO001')"))
def _(m: Mart) -> DataFrame:
    return flights.flight_revenue(m.receipt_rows, m.articles, by_flight=False, direction=2, flights="BU007, HO001")


_GROUP_ID = "CASE WHEN num_levels >= 2 THEN lev2_id WHEN num_levels = 1 THEN lev1_id ELSE 'Unknown' END AS group_id"
_GROUP_NAME = "CASE WHEN num_levels >= 2 THEN lev2_name WHEN num_levels = 1 THEN lev1_name ELSE 'Unknown' END AS group_name"


@query("r04_group_quantities", f"""
    SELECT {_GROUP_ID}, {_GROUP_NAME}, sum(qty_sold - qty_return)::DOUBLE AS sold, sum((qty_sold - qty_return) * unit_amount)::DOUBLE AS units,
           sum(sales_excl_vat + return_excl_vat)::DOUBLE AS revenue, sum(sales_amount + return_amount)::DOUBLE AS revenue_incl_vat
    FROM receipt_row JOIN article USING (article_idx) WHERE origin_code = 'D' GROUP BY 1, 2 HAVING sum(sales_amount + return_amount) <> 0""")
def _(m: Mart) -> DataFrame:
    return flights.group_quantities(m.receipt_rows, m.articles, direction=1)


_P1 = "sale_date BETWEEN DATE '1999-01-01' AND DATE '1999-03-31'"
_P2 = "sale_date BETWEEN DATE '2000-01-01' AND DATE '2000-03-30'"


@query("r05_compared_by_store", f"""
    SELECT store_name, CAST(NULL AS VARCHAR) AS article_id, CAST(NULL AS VARCHAR) AS article_name,
           sum(CASE WHEN {_P1} THEN sales_excl_vat + return_excl_vat ELSE 0 END)::DOUBLE AS revenue_1,
           sum(CASE WHEN {_P1} THEN qty_sold + qty_return ELSE 0 END)::DOUBLE AS moved_1,
           sum(CASE WHEN {_P2} THEN sales_excl_vat + return_excl_vat ELSE 0 END)::DOUBLE AS revenue_2,
           sum(CASE WHEN {_P2} THEN qty_sold + qty_return ELSE 0 END)::DOUBLE AS moved_2
    FROM receipt_row JOIN store USING (store_idx) GROUP BY store_name""")
def _(m: Mart) -> DataFrame:
    return compare.compared_revenue(
        m.receipt_rows, m.stores, m.articles, bounds=(dt.date(1999, 1, 1), dt.date(1999, 3, 31)),
        second_start=dt.date(2000, 1, 1), by_article=False,
    )


@query("r05_compared_by_article", f"""
    WITH days AS (SELECT DISTINCT store_idx, article_idx, sale_date FROM receipt_row WHERE campaign_id IN (2, 4) OR combination_id = 6),
         s AS (SELECT r.* FROM receipt_row r JOIN days USING (store_idx, article_idx, sale_date) WHERE {_P1} OR {_P2})
    SELECT store_name, article_id, article_name,
           sum(CASE WHEN {_P1} THEN sales_excl_vat + return_excl_vat ELSE 0 END)::DOUBLE AS revenue_1,
           sum(CASE WHEN {_P1} THEN qty_sold + qty_return ELSE 0 END)::DOUBLE AS moved_1,
           sum(CASE WHEN {_P2} THEN sales_excl_vat + return_excl_vat ELSE 0 END)::DOUBLE AS revenue_2,
           sum(CASE WHEN {_P2} THEN qty_sold + qty_return ELSE 0 END)::DOUBLE AS moved_2
    FROM s JOIN store USING (store_idx) JOIN article USING (article_idx) GROUP BY store_name, article_id, article_name
    HAVING sum(CASE WHEN {_P1} THEN sales_excl_vat + return_excl_vat ELSE 0 END) <> 0
        OR sum(CASE WHEN {_P2} THEN sales_excl_vat + return_excl_vat ELSE 0 END) <> 0""")
def _(m: Mart) -> DataFrame:
    return compare.compared_revenue(
        m.receipt_rows, m.stores, m.articles, bounds=(dt.date(1999, 1, 1), dt.date(1999, 3, 31)),
        second_start=dt.date(2000, 1, 1), by_article=True, campaigns="2,4,6",
    )


@query("r05_single_period_by_flight", f"""
    SELECT store_name, article_id, article_name, sum(sales_excl_vat + return_excl_vat)::DOUBLE AS revenue_1,
           sum(qty_sold + qty_return)::DOUBLE AS moved_1, CAST(NULL AS DOUBLE) AS revenue_2, CAST(NULL AS DOUBLE) AS moved_2
    FROM receipt_row JOIN store USING (store_idx) JOIN article USING (article_idx) WHERE {_P1} AND coalesce(origin_code, '') = ''
    GROUP BY store_name, article_id, article_name HAVING sum(sales_excl_vat + return_excl_vat) <> 0""")
def _(m: Mart) -> DataFrame:
    return compare.compared_revenue(
        m.receipt_rows, m.stores, m.articles, bounds=(dt.date(1999, 1, 1), dt.date(1999, 3, 31)), second_start=None,
        by_article=True, direction=3,
    )


_LAST_SOLD = """last AS (SELECT article_idx, article_id, article_name, lev2_name, (SELECT max(sale_date) FROM sales_row s
    WHERE s.article_idx = a.article_idx) AS last_sold FROM article a)"""
_ARTICLE_REVENUE = """SELECT article_idx, sum(qty_sold - qty_return) AS sold, sum(sales_amount + return_amount) AS revenue,
    sum(sales_amount + return_amount) - sum(cost_amount) AS gross_profit FROM receipt_row WHERE {cond} GROUP BY article_idx
    HAVING sum(sales_amount + return_amount) <> 0"""
_LAST_COLUMNS = """article_name, article_id, lev2_name, sold::DOUBLE AS sold, revenue::DOUBLE AS revenue, gross_profit::DOUBLE AS gross_profit,
    last_sold::VARCHAR AS last_sold, DATE '2001-08-01' - last_sold AS days_since"""


@query("r09_revenue_last_sold", f"""
    WITH {_LAST_SOLD}, rev AS ({_ARTICLE_REVENUE.format(cond="origin_code = 'D' AND sale_date >= DATE '1998-01-01'")})
    SELECT {_LAST_COLUMNS} FROM last JOIN rev USING (article_idx) ORDER BY rev.revenue DESC, article_id LIMIT 50""")
def _(m: Mart) -> DataFrame:
    kept = flights.flight_filter(m.receipt_rows, direction=1).filter(F.col("sale_date") >= F.lit(dt.date(1998, 1, 1)))
    return flights.revenue_with_last_sold(flights.article_revenue(kept), m.articles, m.sales_rows, as_of=AS_OF)


@query("r09_zero_sale", f"""
    WITH {_LAST_SOLD}, rev AS ({_ARTICLE_REVENUE.format(cond="sale_date >= DATE '2001-07-01' AND origin_code = 'A'")})
    SELECT article_name, article_id, lev2_name, CAST(NULL AS DOUBLE) AS sold, CAST(NULL AS DOUBLE) AS revenue,
           CAST(NULL AS DOUBLE) AS gross_profit, last_sold::VARCHAR AS last_sold, DATE '2001-08-01' - last_sold AS days_since
    FROM last WHERE article_idx NOT IN (SELECT article_idx FROM rev)""")
def _(m: Mart) -> DataFrame:
    kept = flights.flight_filter(m.receipt_rows, direction=2).filter(F.col("sale_date") >= F.lit(dt.date(2001, 7, 1)))
    return flights.revenue_with_last_sold(
        flights.article_revenue(kept), m.articles, m.sales_rows, as_of=AS_OF, zero_sale=True, n=None
    )


_COLLECTED_REVENUE = """SELECT article_idx, sum(received_qty) AS sold, sum(delivered_amount) AS revenue,
    sum(delivered_amount) - max(last_cost) * count(*) AS gross_profit
    FROM order_line JOIN collected USING (order_no) JOIN (
        SELECT article_idx, cost_amount AS last_cost FROM (SELECT *, row_number() OVER (PARTITION BY article_idx
            ORDER BY sale_date DESC, receipt_idx DESC) AS rn FROM sales_row WHERE qty_sold > 0) WHERE rn = 1) c USING (article_idx)
    WHERE delivered_amount <> 0 GROUP BY article_idx"""
_CHANNEL = """SELECT article_name, article_id, lev2_name, sold::DOUBLE AS sold, revenue::DOUBLE AS revenue, gross_profit::DOUBLE AS gross_profit,
    last_sold::VARCHAR AS last_sold, DATE '2001-08-01' - last_sold AS days_since FROM last JOIN rev USING (article_idx)"""


def _channel(m: Mart, channel: int) -> DataFrame:
    revenue = flights.channel_revenue(m.receipt_rows, m.collected_orders, m.order_lines, m.sales_rows, channel=channel)
    return flights.revenue_with_last_sold(revenue, m.articles, m.sales_rows, as_of=AS_OF, n=None)


@query("r10_channel_all", f"WITH {_LAST_SOLD}, rev AS ({_ARTICLE_REVENUE.format(cond='TRUE')}) {_CHANNEL}")
def _(m: Mart) -> DataFrame:
    return _channel(m, flights.ALL_SALES)


@query("r10_channel_collected", f"WITH {_LAST_SOLD}, rev AS ({_COLLECTED_REVENUE}) {_CHANNEL}")
def _(m: Mart) -> DataFrame:
    return _channel(m, flights.COLLECTED_SALES)


@query("r10_channel_other", f"""
    WITH {_LAST_SOLD}, t AS ({_ARTICLE_REVENUE.format(cond='TRUE')}), c AS ({_COLLECTED_REVENUE}),
    rev AS (SELECT article_idx, t.sold - coalesce(c.sold, 0) AS sold, t.revenue - coalesce(c.revenue, 0) AS revenue,
            t.gross_profit - coalesce(c.gross_profit, 0) AS gross_profit FROM t LEFT JOIN c USING (article_idx)
            WHERE t.sold - coalesce(c.sold, 0) <> 0) {_CHANNEL}""")
def _(m: Mart) -> DataFrame:
    return _channel(m, flights.OTHER_SALES)


# -- year report ------------------------------------------------------------------------------

WINDOWS = YearWindows.of(dt.date(2000, 4, 1), dt.date(2000, 6, 30))
_WINDOW_SQL = {
    "period": "BETWEEN DATE '2000-04-01' AND DATE '2000-06-30'",
    "ytd": "BETWEEN DATE '2000-01-01' AND DATE '2000-06-30'",
    "last_year": "BETWEEN DATE '1999-04-01' AND DATE '1999-06-30'",
    "last_ytd": "BETWEEN DATE '1999-01-01' AND DATE '1999-06-30'",
}


def _year_sums_sql(source: str, day: str, revenue: str, items: str) -> str:
    parts = []
    for name, cond in _WINDOW_SQL.items():
        parts += [
            f"sum(CASE WHEN {day} {cond} THEN {revenue} ELSE 0 END) AS revenue_{name}",
            f"sum(CASE WHEN {day} {cond} THEN {items} ELSE 0 END) AS items_{name}",
            f"sum(CASE WHEN {day} {cond} AND line_no = 1 THEN 1 ELSE 0 END) AS customers_{name}",
        ]
    return f"""SELECT lev1_name, {', '.join(parts)} FROM {source} JOIN article USING (article_idx) GROUP BY lev1_name
        HAVING count(CASE WHEN {day} {_WINDOW_SQL['period']} THEN 1 END) > 0"""


_YEAR_ALL = _year_sums_sql("receipt_row", "sale_date", "sales_excl_vat + return_excl_vat", "qty_sold - qty_return")
_YEAR_COLLECTED = _year_sums_sql("order_line JOIN collected USING (order_no)", "collect_date", "delivered_amount", "received_qty")


def _year_report_sql(sums: str) -> str:
    names = [f"{c}_{w}" for c in ("revenue", "items", "customers") for w in _WINDOW_SQL]
    total = ", ".join(f"sum({n}) AS {n}" for n in names)
    customers = ", ".join(f"sum(customers_{w}) AS all_{w}" for w in _WINDOW_SQL)

    def line(label: str, make, cond: str = "TRUE") -> str:
        cols = ", ".join(f"nullif({make(w)}, 0) AS {w}" for w in _WINDOW_SQL)
        return f"SELECT lev1_name, '{label}' AS measure, {cols} FROM j WHERE {cond}"

    lines = [
        line("1 Revenue", lambda w: f"revenue_{w}::DOUBLE"),
        line("2 NoOfArticles", lambda w: f"items_{w}::DOUBLE"),
        line("3 NoOfCustomers", lambda w: f"all_{w}::DOUBLE", "lev1_name = 'Total'"),
        line("4 RevenuePerCustomer", lambda w: f"revenue_{w}::DOUBLE / nullif(all_{w}::DOUBLE, 0)"),
        line("5 ItemsPerCustomer", lambda w: f"items_{w}::DOUBLE / nullif(all_{w}::DOUBLE, 0)"),
        line("6 PricePerItem", lambda w: f"revenue_{w}::DOUBLE / nullif(items_{w}::DOUBLE, 0)"),
    ]
    return f"""{sums},
        j AS (SELECT * FROM (SELECT lev1_name, {', '.join(names)} FROM s UNION ALL SELECT 'Total', {total} FROM s) u,
              (SELECT {customers} FROM s) c WHERE revenue_period <> 0 OR lev1_name = 'Total')
        {' UNION ALL '.join(lines)}"""


@query("r11_year_report", _year_report_sql(f"WITH s AS ({_YEAR_ALL})"))
def _(m: Mart) -> DataFrame:
    return compare.year_report(compare.year_sums(m.receipt_rows, m.articles, WINDOWS))


@query("r12_year_report_collected", _year_report_sql(f"WITH s AS ({_YEAR_COLLECTED})"))
def _(m: Mart) -> DataFrame:
    lines = flights.collected_lines(m.collected_orders, m.order_lines)
    return compare.year_report(compare.collected_year_sums(lines, m.articles, WINDOWS))


_DIFF_COLUMNS = ", ".join(f"a.{c}_{w} - coalesce(b.{c}_{w}, 0) AS {c}_{w}" for c in ("revenue", "items", "customers") for w in _WINDOW_SQL)


@query("r12_year_report_other", _year_report_sql(
    f"WITH a AS ({_YEAR_ALL}), b AS ({_YEAR_COLLECTED}), s AS (SELECT lev1_name, {_DIFF_COLUMNS} FROM a LEFT JOIN b USING (lev1_name))"))
def _(m: Mart) -> DataFrame:
    lines = flights.collected_lines(m.collected_orders, m.order_lines)
    everything = compare.year_sums(m.receipt_rows, m.articles, WINDOWS)
    return compare.year_report(compare.year_difference(everything, compare.collected_year_sums(lines, m.articles, WINDOWS)))


# -- campaigns --------------------------------------------------------------------------------



def _cents_per_unit(amount: str) -> str:
    """Half-up cents from whole-number arithmetic."""
    a, q = f"({amount} * 10000)::BIGINT", "(qty_sold * 100)::BIGINT"
    return f"coalesce((2 * {a} + {q}) // nullif(2 * {q}, 0), 0)::DOUBLE / 100"


_KINDS = """
    WITH p AS (SELECT *, {unit_price} AS unit_price,
                      {unit_cost} AS unit_cost
               FROM receipt_row JOIN store USING (store_idx) JOIN article USING (article_idx) WHERE {cond}),
    g AS (SELECT store_name, article_id, article_name, unit_price::DOUBLE AS unit_price, unit_cost::DOUBLE AS unit_cost,
                 CASE WHEN price_type = 0 THEN 'Single' ELSE 'MixMatch' END AS campaign_kind, sum(sales_amount)::DOUBLE AS sales_amount, sum(qty_sold)::DOUBLE AS sold
          FROM p WHERE combination_id IS NOT NULL OR price_type = 0 GROUP BY ALL)"""


@query("r13_campaign_profitability", _KINDS.format(cond="TRUE", unit_price=_cents_per_unit("sales_amount"), unit_cost=_cents_per_unit("cost_amount")) + """
    , k AS (SELECT DISTINCT store_name, article_id, article_name FROM g)
    SELECT * FROM g
    UNION ALL SELECT store_name, article_id, article_name, NULL, NULL, c.kind, NULL, NULL FROM k CROSS JOIN (VALUES ('Single'), ('MixMatch')) c(kind)
        WHERE NOT EXISTS (SELECT 1 FROM g WHERE g.store_name = k.store_name AND g.article_id = k.article_id AND g.campaign_kind = c.kind)
    UNION ALL SELECT store_name, article_id, article_name, unit_price::DOUBLE, unit_cost::DOUBLE, 'PriceCut', sum(sales_amount)::DOUBLE, sum(qty_sold)::DOUBLE
        FROM p WHERE reduction_id IS NOT NULL GROUP BY store_name, article_id, article_name, p.unit_price, p.unit_cost""")
def _(m: Mart) -> DataFrame:
    return campaigns.campaign_profitability(m.receipt_rows, m.stores, m.articles)


@query("r14_campaign_by_store", """
    SELECT article_name, coalesce(campaign_id, combination_id, reduction_id) AS campaign_no,
           sum(CASE WHEN store_id = '3' THEN qty_sold - qty_return ELSE 0 END)::DOUBLE AS store_3,
           sum(CASE WHEN store_id = '8' THEN qty_sold - qty_return ELSE 0 END)::DOUBLE AS store_8,
           sum(CASE WHEN store_id = '21' THEN qty_sold - qty_return ELSE 0 END)::DOUBLE AS store_21,
           sum(CASE WHEN store_id IN ('3', '8', '21') THEN qty_sold - qty_return ELSE 0 END)::DOUBLE AS total
    FROM receipt_row JOIN store USING (store_idx) JOIN article USING (article_idx)
    WHERE origin_code = 'A' AND (campaign_id IN (1, 7, 9) OR combination_id IN (1, 7, 9) OR reduction_id IN (1, 7, 9))
    GROUP BY 1, 2 HAVING sum(qty_sold) > 0""")
def _(m: Mart) -> DataFrame:
    return campaigns.campaign_quantities(
        m.receipt_rows, m.stores, m.articles, store_columns=("3", "8", "21"), campaigns="1,7,9", direction=2
    )


_QUANTITIES = f"""SELECT {_GROUP_ID}, {_GROUP_NAME}, sum(qty_sold - qty_return) AS sold, sum((qty_sold - qty_return) * unit_amount) AS units,
    sum(sales_excl_vat + return_excl_vat) AS revenue, sum(sales_amount + return_amount) AS revenue_incl_vat
    FROM receipt_row JOIN article USING (article_idx) GROUP BY 1, 2 HAVING sum(sales_amount + return_amount) <> 0"""
_QUANTITIES_COLLECTED = f"""SELECT {_GROUP_ID}, {_GROUP_NAME}, sum(received_qty) AS sold, sum(received_qty * unit_amount) AS units,
    sum(delivered_amount) AS revenue, sum(delivered_amount) AS revenue_incl_vat
    FROM order_line JOIN collected USING (order_no) JOIN article USING (article_idx) GROUP BY 1, 2"""
_AS_DOUBLE = "sold::DOUBLE AS sold, units::DOUBLE AS units, revenue::DOUBLE AS revenue, revenue_incl_vat::DOUBLE AS revenue_incl_vat"


def _channel_quantities(m: Mart, channel: int) -> DataFrame:
    return flights.channel_quantities(m.receipt_rows, m.collected_orders, m.order_lines, m.articles, channel=channel)


@query("r15_group_quantities_all", f"SELECT group_id, group_name, {_AS_DOUBLE} FROM ({_QUANTITIES})")
def _(m: Mart) -> DataFrame:
    return _channel_quantities(m, flights.ALL_SALES)


@query("r15_group_quantities_collected", f"SELECT group_id, group_name, {_AS_DOUBLE} FROM ({_QUANTITIES_COLLECTED})")
def _(m: Mart) -> DataFrame:
    return _channel_quantities(m, flights.COLLECTED_SALES)


@query("r15_group_quantities_other", f"""
    WITH a AS ({_QUANTITIES}), b AS ({_QUANTITIES_COLLECTED})
    SELECT a.group_id, a.group_name, (a.sold - coalesce(b.sold, 0))::DOUBLE AS sold, (a.units - coalesce(b.units, 0))::DOUBLE AS units,
           (a.revenue - coalesce(b.revenue, 0))::DOUBLE AS revenue, (a.revenue_incl_vat - coalesce(b.revenue_incl_vat, 0))::DOUBLE AS revenue_incl_vat
    FROM a LEFT JOIN b ON a.group_id = b.group_id""")
def _(m: Mart) -> DataFrame:
    return _channel_quantities(m, flights.OTHER_SALES)


@query("r17_flight_sales_export", """
    WITH f AS (SELECT *, CASE WHEN origin_code = 'A' THEN connected_airport ELSE local_airport END AS origin,
                      CASE WHEN origin_code = 'D' THEN connected_airport ELSE local_airport END AS destination,
                      CASE origin_code WHEN 'D' THEN 'Departure' WHEN 'A' THEN 'Arrival' ELSE 'Extra' END AS flight_type,
                      CASE origin_code WHEN 'D' THEN 'DEP' WHEN 'A' THEN 'ARR' ELSE 'EXT' END AS travel_type
               FROM receipt_row JOIN article USING (article_idx)),
    u AS (SELECT store_idx, sale_date, flight_no, origin, destination, flight_type, travel_type, lev1_id AS group_id, lev1_name AS group_name,
                 sum(qty_sold - qty_return) AS sold, sum(sales_excl_vat + return_excl_vat) AS revenue FROM f GROUP BY ALL
          UNION ALL SELECT store_idx, sale_date, flight_no, origin, destination, flight_type, travel_type, '9999', '**No of customers**', 0, count(DISTINCT receipt_id)
          FROM f GROUP BY ALL)
    SELECT u.* EXCLUDE (store_idx, sale_date, sold, revenue), sale_date::VARCHAR AS sale_date, sold::DOUBLE AS sold, revenue::DOUBLE AS revenue,
           store_name, airport FROM u JOIN store USING (store_idx)""")
def _(m: Mart) -> DataFrame:
    return flights.flight_sales_export(m.receipt_rows, m.articles, m.stores)


# -- sales by choice --------------------------------------------------------------------------


@query("r20_sales_by_leaf", f"""
    SELECT CASE num_levels WHEN 1 THEN lev1_id WHEN 2 THEN lev2_id WHEN 3 THEN lev3_id ELSE 'None' END AS id,
           CASE num_levels WHEN 1 THEN lev1_name WHEN 2 THEN lev2_name WHEN 3 THEN lev3_name ELSE 'None' END AS name, {_MEASURES}, {_CONFIG_PRODUCT}
    FROM sales_row JOIN article USING (article_idx) GROUP BY 1, 2 {_NOT_EMPTY}""")
def _(m: Mart) -> DataFrame:
    return sales.sales_by_choice(m.sales_rows, m.articles, "LeafArticleHierarchy")


@query("r20_sales_by_store_group", f"""
    SELECT store_id AS id, lev1_region_name AS name, {_MEASURES}, {_CONFIG_PRODUCT}
    FROM receipt_row JOIN store USING (store_idx) GROUP BY 1, 2 {_NOT_EMPTY}""")
def _(m: Mart) -> DataFrame:
    return sales.sales_by_choice(m.receipt_rows, m.articles, "StoreGroup", stores=m.stores)


@query("r20_sales_by_article", f"""
    SELECT article_id AS id, article_name AS name, {_MEASURES}, {_CONFIG_PRODUCT} FROM sales_row JOIN article USING (article_idx)
    WHERE lev1_id || '-' || lev1_name = 'PROMO-Type PROMO' AND isodow(sale_date) <= 5 GROUP BY 1, 2 {_NOT_EMPTY}""")
def _(m: Mart) -> DataFrame:
    return sales.sales_by_choice(
        m.sales_rows, m.articles, "Article", weekdays=(True,) * 5 + (False,) * 2, article_label="PROMO-Type PROMO"
    )


@query("r20_sales_by_weekday", f"""
    SELECT dayname(sale_date) AS id, dayname(sale_date) AS name, {_MEASURES}, {_CONFIG_PRODUCT} FROM sales_row
    WHERE sale_date BETWEEN DATE '1999-01-01' AND DATE '1999-12-31' GROUP BY 1 {_NOT_EMPTY}""")
def _(m: Mart) -> DataFrame:
    return sales.sales_by_choice(m.sales_rows, m.articles, "WeekDay", bounds=Y1999)


def _across(m: Mart, first: dt.date, last: dt.date, group_by: str) -> DataFrame:
    return sales.sales_across_chains(m.sales_rollup.between(first, last), m.articles, group_by)


@query("r20_sales_by_any_level", """
    WITH n AS (SELECT article_idx, unnest(['department|' || left(lev1_id, 1), '1|' || lev1_id, '2|' || lev1_id || '|' || lev2_id, '3|' || lev1_id || '|' || lev2_id || '|' || lev3_id]) AS ancestor FROM article)
    SELECT ancestor, sum(qty_sold - qty_return)::DOUBLE AS quantity, sum(sales_amount + return_amount)::DOUBLE AS revenue_incl_vat
    FROM sales_row JOIN n USING (article_idx) WHERE ancestor IS NOT NULL AND sale_date BETWEEN DATE '1999-01-01' AND DATE '1999-12-31' GROUP BY ancestor""")
def _(m: Mart) -> DataFrame:
    return sales.sales_by_any_level(m.sales_rows, ancestors(sales.hierarchy_links(m.articles)), bounds=Y1999)


@query("r21_across_chains_monthly", f"""
    SELECT lev1_id AS id, lev1_name AS name, {_MEASURES}, {_CONFIG_PRODUCT} FROM sales_row JOIN article USING (article_idx)
    WHERE sale_date BETWEEN DATE '1998-01-01' AND DATE '2000-12-31' GROUP BY 1, 2""")
def _(m: Mart) -> DataFrame:
    return _across(m, dt.date(1998, 1, 1), dt.date(2000, 12, 31), "Lev1ArticleHierarchy")


@query("r21_across_chains_daily", f"""
    SELECT article_id AS id, article_name AS name, {_MEASURES}, {_CONFIG_PRODUCT} FROM sales_row JOIN article USING (article_idx)
    WHERE sale_date BETWEEN DATE '1998-01-15' AND DATE '2000-12-31' GROUP BY 1, 2""")
def _(m: Mart) -> DataFrame:
    return _across(m, dt.date(1998, 1, 15), dt.date(2000, 12, 31), "Article")


@query("r22_price_overrides", """
    SELECT store_idx, till_id, date_key, article_id, gtin, article_name, lev3_id AS group_no, lev3_name AS group_name, qty_sold::DOUBLE AS qty,
           list_amount::DOUBLE AS normal_amount, sales_amount::DOUBLE AS sales_amount, (list_amount - sales_amount)::DOUBLE AS discount_amount,
           price_type, cashier_name
    FROM receipt_row JOIN article USING (article_idx) WHERE price_type = 9""")
def _(m: Mart) -> DataFrame:
    return sales.price_overrides(m.receipt_rows, m.articles, price_types=(9,))


@query("r23_discount_by_kind", """
    SELECT monthname(sale_date) AS month_name, lev2_name,
           sum(CASE WHEN price_type IN (1, 2) THEN discount_amount ELSE 0 END)::DOUBLE AS line_discount,
           sum(CASE WHEN price_type IN (5, 6, 7) THEN discount_amount ELSE 0 END)::DOUBLE AS mix_match,
           sum(CASE WHEN price_type IN (8, 9) THEN discount_amount ELSE 0 END)::DOUBLE AS down_pricing,
           sum(CASE WHEN price_type IN (3, 4) THEN discount_amount ELSE 0 END)::DOUBLE AS campaign,
           sum(CASE WHEN price_type = 10 THEN discount_amount ELSE 0 END)::DOUBLE AS receipt_discount
    FROM sales_row LEFT JOIN article USING (article_idx)
    WHERE discount_amount > 0 AND list_amount > 0 AND qty_sold - qty_return <> 0 GROUP BY 1, 2""")
def _(m: Mart) -> DataFrame:
    return sales.discount_by_kind(m.sales_rows, m.articles)


@query("r24_discount_detail", """
    SELECT monthname(sale_date) AS month_name, store_name, gtin, article_name, sum(qty_sold)::DOUBLE AS sold, sum(list_amount)::DOUBLE AS normal_amount,
           sum(sales_amount)::DOUBLE AS sales_amount, sum(discount_amount)::DOUBLE AS discount_amount,
           sum(((list_amount - sales_amount)::DOUBLE / list_amount::DOUBLE * 100)::DECIMAL(18,6))::DOUBLE AS discount_percent
    FROM receipt_row JOIN article USING (article_idx) JOIN store USING (store_idx)
    WHERE discount_amount > 0 AND list_amount > 0 AND qty_sold - qty_return <> 0 GROUP BY ALL""")
def _(m: Mart) -> DataFrame:
    return sales.discount_detail(m.receipt_rows, m.articles, m.stores)


@query("r26_daily_sales", """
    SELECT sale_date::VARCHAR AS sale_date, sum(qty_sold)::DOUBLE AS sold, sum(qty_return)::DOUBLE AS returned,
           sum(qty_sold + qty_return)::DOUBLE AS movement, sum(sales_excl_vat)::DOUBLE AS sales_excl_vat, sum(return_excl_vat)::DOUBLE AS return_excl_vat,
           coalesce(sum(list_amount + return_amount)::DOUBLE / nullif(sum(qty_sold - qty_return)::DOUBLE, 0), 0) AS price
    FROM receipt_row WHERE store_idx = 12 GROUP BY sale_date""")
def _(m: Mart) -> DataFrame:
    return sales.daily_sales(m.receipt_rows.filter(F.col("store_idx") == 12))


@query("r34_space_planning", """
    SELECT store_idx, article_idx, vat_group,
           coalesce(sum(list_amount + return_amount)::DOUBLE / nullif(sum(qty_sold + qty_return)::DOUBLE, 0), 0) AS price,
           coalesce(sum(cost_amount)::DOUBLE / nullif(sum(qty_sold + qty_return)::DOUBLE, 0), 0) AS cost,
           sum(qty_sold + qty_return)::DOUBLE AS movement,
           coalesce(sum(list_amount - sales_amount)::DOUBLE / nullif(sum(qty_sold + qty_return)::DOUBLE, 0), 0) AS marked_down_value
    FROM receipt_row WHERE sale_date BETWEEN date_trunc('week', DATE '2001-08-01') - INTERVAL 13 WEEK
                                        AND date_trunc('week', DATE '2001-08-01') - INTERVAL 1 DAY
    GROUP BY store_idx, article_idx, vat_group""")
def _(m: Mart) -> DataFrame:
    return sales.space_planning(m.receipt_rows, as_of=AS_OF)


_EXTRACT = f"""SELECT '{{name}}' AS description, sale_date::VARCHAR AS sale_date, {_MEASURES},
    sum(list_amount + return_amount)::DOUBLE / sum(qty_sold - qty_return)::DOUBLE AS unit_price,
    article_id, article_name, gtin, lev2_id, lev2_name, lev3_id, lev3_name
    FROM sales_row JOIN article USING (article_idx) WHERE {{cond}}
    GROUP BY sale_date, article_id, article_name, gtin, lev2_id, lev2_name, lev3_id, lev3_name
    HAVING sum(qty_sold - qty_return) > 0 AND sum(sales_amount + return_amount) > 0 AND sum(sales_excl_vat + return_excl_vat) > 0
       AND sum(sales_excl_vat + return_excl_vat - cost_amount) > 0 AND sum(list_amount + return_amount) > 0 AND sum(cost_amount) > 0
       AND sum(sales_vat + return_vat) > 0"""


@query("r35_sales_extract", _EXTRACT.format(name="Sales", cond="TRUE") + " UNION ALL " + _EXTRACT.format(name="RTC", cond="price_type IN (8, 9)"))
def _(m: Mart) -> DataFrame:
    return sales.sales_extract(m.sales_rows, m.articles)


@query("r38_campaign_listing", """
    WITH s AS (SELECT *, coalesce(campaign_id, combination_id, reduction_id) AS campaign_no FROM receipt_row
               WHERE coalesce(campaign_id, combination_id, reduction_id) IS NOT NULL),
    spans AS (SELECT campaign_no, min(sale_date) AS valid_from, max(sale_date) AS valid_to FROM s GROUP BY campaign_no
              HAVING min(sale_date) BETWEEN DATE '1995-01-01' AND DATE '1995-12-31'),
    regions AS (SELECT campaign_no, string_agg(DISTINCT lev1_region_name, ', ' ORDER BY lev1_region_name) AS selected_regions
                FROM s JOIN store USING (store_idx) GROUP BY campaign_no),
    item AS (SELECT DISTINCT campaign_no, article_idx AS item_idx, lev2_id AS item_group FROM s JOIN article USING (article_idx)
             WHERE combination_id IS NOT NULL),
    cut AS (SELECT campaign_no, article_idx, max(sales_amount) AS campaign_price FROM s WHERE reduction_id IS NOT NULL AND qty_sold > 0 GROUP BY ALL),
    u AS (SELECT DISTINCT campaign_no, 'No' AS promotion_price, article_id, article_name, brand_id, lev1_name AS category, lev2_name AS sub_category,
                 retail_price AS ordinary_price, CAST(NULL AS DECIMAL(18,4)) AS campaign_price
          FROM item JOIN article ON article_idx = item_idx OR lev2_id = item_group
          UNION ALL SELECT campaign_no, 'Yes', article_id, article_name, brand_id, lev1_name, lev2_name, retail_price, campaign_price
          FROM cut JOIN article USING (article_idx))
    SELECT campaign_no, promotion_price, article_id, article_name, brand_id, category, sub_category, ordinary_price::DOUBLE AS ordinary_price,
           campaign_price::DOUBLE AS campaign_price, valid_from::VARCHAR AS valid_from, valid_to::VARCHAR AS valid_to, selected_regions
    FROM u JOIN spans USING (campaign_no) LEFT JOIN regions USING (campaign_no)""")
def _(m: Mart) -> DataFrame:
    return campaigns.campaign_listing(m.receipt_rows, m.stores, m.articles, bounds=(dt.date(1995, 1, 1), dt.date(1995, 12, 31)))


# -- revenue figures --------------------------------------------------------------------------


@query("r39_revenue_by_month", f"""
    SELECT CAST(strftime(sale_date, '%Y%m') AS VARCHAR) AS grouped_by, '' AS gtin, {_MEASURES}, {_FLAGS}, {_CONFIG_SUM}
    FROM sales_row JOIN article USING (article_idx)
    WHERE NOT is_third_party AND article_type_id NOT IN (130, 132, 133) AND isodow(sale_date) <> 7 AND brand_id >= 'Brand#1' AND brand_id <= 'Brand#22'
      AND year(sale_date) IN (1999, 2000) GROUP BY 1""")
def _(m: Mart) -> DataFrame:
    return sales.revenue_figures(
        m.sales_rows, m.articles, m.suppliers, "Month", period=Period("R", unit="Y", start=-2, duration=2), as_of=AS_OF,
        weekdays=(True,) * 6 + (False,), no_third_party=True, no_deposit=True, brand=("Brand#1", "Brand#22"),
    )


@query("r39_revenue_by_article", f"""
    SELECT article_name AS grouped_by, gtin, {_MEASURES}, {_FLAGS}, {_CONFIG_SUM} FROM sales_row JOIN article USING (article_idx)
    WHERE sale_date BETWEEN DATE '1999-01-01' AND DATE '1999-12-31' AND article_idx >= 0 AND lev1_id >= 'LARGE' AND lev1_id <= 'PROMO'
    GROUP BY 1, 2""")
def _(m: Mart) -> DataFrame:
    return sales.revenue_figures(
        m.sales_rows, m.articles, m.suppliers, "Article", period=Period("D", *Y1999), as_of=AS_OF, article_id=(0, None), level1=("LARGE", "PROMO")
    )


@query("r39_revenue_by_week", f"""
    SELECT CAST(isoyear(sale_date) * 100 + weekofyear(sale_date) AS VARCHAR) AS grouped_by, '' AS gtin, {_MEASURES}, {_FLAGS}, {_CONFIG_SUM}
    FROM sales_row JOIN article USING (article_idx) WHERE sale_date BETWEEN DATE '2001-01-01' AND DATE '2001-08-01' GROUP BY 1""")
def _(m: Mart) -> DataFrame:
    return sales.revenue_figures(m.sales_rows, m.articles, m.suppliers, "Week", period=Period("Y"), as_of=AS_OF)


@query("r39_revenue_by_supplier", f"""
    SELECT supplier_name AS grouped_by, '' AS gtin, {_MEASURES}, {_FLAGS}, {_CONFIG_SUM}
    FROM sales_row JOIN supp USING (supplier_idx) WHERE sale_date BETWEEN DATE '1999-01-01' AND DATE '1999-12-31' GROUP BY 1""")
def _(m: Mart) -> DataFrame:
    return sales.revenue_figures(m.sales_rows, m.articles, m.suppliers, "Supplier", period=Period("D", *Y1999), as_of=AS_OF)


@query("r39_revenue_by_weekday", f"""
    SELECT CAST(isodow(sale_date) AS VARCHAR) || ' ' || dayname(sale_date) AS grouped_by, '' AS gtin, {_MEASURES}, {_FLAGS}, {_CONFIG_SUM}
    FROM sales_row WHERE sale_date BETWEEN DATE '1999-01-01' AND DATE '1999-12-31' GROUP BY 1""")
def _(m: Mart) -> DataFrame:
    return sales.revenue_figures(m.sales_rows, m.articles, m.suppliers, "Day", period=Period("D", *Y1999), as_of=AS_OF)


@query("r40_drill_down_group", f"""
    SELECT article_name, gtin, {_MEASURES}, {_CONFIG_SUM} FROM sales_row JOIN article USING (article_idx)
    WHERE lev1_name = 'Type LARGE' AND sale_date BETWEEN DATE '1999-01-01' AND DATE '1999-12-31' GROUP BY article_name, gtin""")
def _(m: Mart) -> DataFrame:
    return sales.revenue_drill_down(m.sales_rows, m.articles, m.suppliers, "ArticleHierarchy", "Type LARGE", bounds=Y1999)


@query("r40_drill_down_month", f"""
    SELECT article_name, gtin, {_MEASURES}, {_CONFIG_SUM} FROM sales_row JOIN article USING (article_idx)
    WHERE sale_date BETWEEN DATE '1999-05-01' AND DATE '1999-05-31' GROUP BY article_name, gtin""")
def _(m: Mart) -> DataFrame:
    return sales.revenue_drill_down(m.sales_rows, m.articles, m.suppliers, "Month", "199905", bounds=Y1999)
