"""Plain ANSI SQL (DuckDB dialect) for every catalog key.

The driver tables are pre-registered views (lineitem, orders, part, ...).
Each query starts from the same CTE chain: the retail mapping of
FIXTURES.md section 2, then normalise -> rank -> enrich -> check -> silver.
Money is DECIMAL(18,2) inside and DOUBLE in every result; integer division
is ``//``; DuckDB's HUGEINT sums and BIGINT date parts are cast back to
the Spark types.
"""

from __future__ import annotations

MONEY_COLUMNS = {
    "unit_price", "discount_percent", "gross_revenue", "net_revenue", "unit_cost",
    "total_cost", "margin", "base_price", "base_cost", "realized_revenue", "realized_margin",
}
SALES = [
    "transaction_id", "order_id", "transaction_date", "product_id", "store_id", "channel",
    "quantity", "unit_price", "discount_percent", "gross_revenue", "net_revenue",
    "unit_cost", "total_cost", "margin", "order_status",
]
SRC = ["_src_partkey", "_src_suppkey", "_src_shipdate"]
ROW_ID = ["transaction_id", *SRC]
PRODUCT_ATTRS = ["product_name", "category", "brand", "base_price", "base_cost", "launch_date", "is_active"]
STORE_ATTRS = ["city", "region", "store_type", "opened_at", "population_segment"]
CAL_ATTRS = ["year", "quarter", "month", "month_name", "week_of_year", "day_of_week",
             "is_weekend", "holiday_name", "season"]
ENRICHED = ["store_id", "product_id"] + [c for c in SALES if c not in ("product_id", "store_id")] \
    + SRC + ["_duplicate_rank"] + PRODUCT_ATTRS + STORE_ATTRS + CAL_ATTRS
SILVER = [c for c in ENRICHED if not c.startswith("_")] + ["realized_revenue", "realized_margin"]
REASONS = [
    "duplicate_transaction", "missing_product_id", "unknown_product", "unknown_store",
    "missing_calendar_date", "invalid_quantity", "invalid_unit_price", "invalid_unit_cost",
    "invalid_channel", "invalid_order_status", "invalid_net_revenue",
]
RULE_SQL = {
    "duplicate_transaction": "_duplicate_rank > 1",
    "missing_product_id": "product_id IS NULL OR product_id = ''",
    "unknown_product": "product_name IS NULL",
    "unknown_store": "city IS NULL",
    "missing_calendar_date": "year IS NULL",
    "invalid_quantity": "quantity IS NULL OR quantity <= 0",
    "invalid_unit_price": "unit_price IS NULL OR unit_price <= 0",
    "invalid_unit_cost": "unit_cost IS NULL OR unit_cost < 0",
    "invalid_channel": "NOT (channel IN ('store', 'online', 'marketplace'))",
    "invalid_order_status": "NOT (order_status IN ('paid', 'cancelled'))",
    "invalid_net_revenue": "net_revenue < 0",
}
M = "DECIMAL(18,2)"


def pub(cols: list[str], prefix: str = "") -> str:
    """Select list with money cast to DOUBLE."""
    return ", ".join(
        f"CAST({prefix}{c} AS DOUBLE) AS {c}" if c in MONEY_COLUMNS else f"{prefix}{c}" for c in cols
    )


def calendar_select(start: str, end: str) -> str:
    """Calendar rows for every day from the scalar ``start`` to ``end``."""
    return f"""
    SELECT d AS date,
      CAST(year(d) AS INTEGER) AS year,
      CAST(quarter(d) AS INTEGER) AS quarter,
      CAST(month(d) AS INTEGER) AS month,
      monthname(d) AS month_name,
      CAST(weekofyear(d) AS INTEGER) AS week_of_year,
      dayname(d) AS day_of_week,
      isodow(d) >= 6 AS is_weekend,
      CASE WHEN month(d) = 11 AND isodow(d) = 5 AND day(d) BETWEEN 23 AND 29 THEN 'Black Friday'
           WHEN month(d) = 12 AND day(d) BETWEEN 10 AND 24 THEN 'Holiday shopping'
           WHEN month(d) = 1 AND day(d) <= 7 THEN 'New Year slowdown' END AS holiday_name,
      CASE WHEN month(d) IN (12, 1, 2) THEN 'winter' WHEN month(d) IN (3, 4, 5) THEN 'spring'
           WHEN month(d) IN (6, 7, 8) THEN 'summer' ELSE 'autumn' END AS season
    FROM (SELECT CAST(ts AS DATE) AS d FROM (
      SELECT unnest(generate_series(CAST(({start}) AS TIMESTAMP), CAST(({end}) AS TIMESTAMP), INTERVAL 1 DAY)) AS ts))
    """


FIRST_ORDER_DAY = "SELECT min(CAST(o_orderdate AS DATE)) FROM orders"
LAST_ORDER_DAY = "SELECT max(CAST(o_orderdate AS DATE)) FROM orders"

BASE = f"""
li AS (
  SELECT l.l_orderkey AS ok, l.l_partkey AS pk, l.l_suppkey AS sk, l.l_linenumber AS ln,
    CAST(trunc(l.l_quantity) AS INTEGER) AS qty,
    CAST(l.l_extendedprice AS {M}) AS gross, l.l_discount AS disc,
    CAST(l.l_shipdate AS DATE) AS shipdate, o.o_orderstatus AS ostatus,
    CAST(o.o_orderdate AS DATE) AS odate, substr(o.o_orderpriority, 1, 1) AS prio,
    p.p_retailprice AS price
  FROM lineitem l
  LEFT JOIN orders o ON l.l_orderkey = o.o_orderkey
  LEFT JOIN part p ON l.l_partkey = p.p_partkey
),
li2 AS (
  SELECT *,
    CAST(round(gross * (1 - CAST(disc AS DECIMAL(4,2))), 2) AS {M}) AS net0,
    CAST(round(CAST(price AS {M}) * CAST(0.60 AS DECIMAL(3,2)), 2) AS {M}) AS uc0
  FROM li
),
raw_sales AS (
  SELECT
    CAST(ok AS VARCHAR) || '-' || CAST(ln AS VARCHAR) AS transaction_id,
    'O' || CAST(ok AS VARCHAR) AS order_id,
    odate AS transaction_date,
    CASE WHEN pk % 97 = 0 THEN '   ' WHEN pk % 89 = 0 THEN 'UNKNOWN_PRODUCT'
         ELSE ' P' || CAST(pk AS VARCHAR) || ' ' END AS product_id,
    CASE WHEN sk % 41 = 0 THEN 'UNKNOWN_STORE' ELSE 'S' || CAST(sk AS VARCHAR) || ' ' END AS store_id,
    CASE WHEN ok % 113 = 0 THEN 'kiosk' WHEN ok % 131 = 0 THEN NULL
         WHEN prio IN ('1', '2') THEN 'store' WHEN prio = '3' THEN 'online'
         WHEN prio = '4' THEN 'marketplace' WHEN prio = '5' THEN ' ONLINE ' END AS channel,
    CASE WHEN ok % 101 = 0 THEN 0 WHEN ok % 103 = 0 THEN NULL ELSE qty END AS quantity,
    CASE WHEN ok % 107 = 0 THEN CAST(-99 AS {M}) ELSE CAST(price AS {M}) END AS unit_price,
    CAST(disc * 100 AS {M}) AS discount_percent,
    gross AS gross_revenue,
    CASE WHEN ok % 107 = 0 THEN CAST(-99 AS {M}) WHEN ostatus = 'O' THEN CAST(0 AS {M})
         ELSE net0 END AS net_revenue,
    CASE WHEN ok % 109 = 0 THEN CAST(-1 AS {M}) ELSE uc0 END AS unit_cost,
    CAST(qty * uc0 AS {M}) AS total_cost,
    CASE WHEN ostatus = 'O' THEN CAST(0 AS {M}) ELSE CAST(net0 - qty * uc0 AS {M}) END AS margin,
    CASE WHEN ok % 127 = 0 THEN 'refunded' WHEN ostatus = 'F' THEN 'paid'
         WHEN ostatus = 'P' THEN ' PAID' WHEN ostatus = 'O' THEN 'Cancelled ' END AS order_status,
    pk AS _src_partkey, sk AS _src_suppkey, shipdate AS _src_shipdate
  FROM li2
),
products AS (
  SELECT 'P' || CAST(p_partkey AS VARCHAR) AS product_id, p_name AS product_name,
    p_type AS category, p_brand AS brand, CAST(p_retailprice AS {M}) AS base_price,
    CAST(round(CAST(p_retailprice AS {M}) * CAST(0.60 AS DECIMAL(3,2)), 2) AS {M}) AS base_cost,
    DATE '1992-01-01' AS launch_date, TRUE AS is_active
  FROM part
),
stores AS (
  SELECT 'S' || CAST(s.s_suppkey AS VARCHAR) AS store_id, n.n_name AS city, r.r_name AS region,
    'supplier_depot' AS store_type, DATE '1992-01-01' AS opened_at, 'national' AS population_segment
  FROM supplier s
  LEFT JOIN nation n ON s.s_nationkey = n.n_nationkey
  LEFT JOIN region r ON n.n_regionkey = r.r_regionkey
),
calendar AS ({calendar_select(FIRST_ORDER_DAY, "SELECT DATE '2000-12-31'")}),
normalized AS (
  SELECT transaction_id, order_id, transaction_date, trim(product_id) AS product_id,
    trim(store_id) AS store_id, lower(trim(channel)) AS channel, quantity, unit_price,
    discount_percent, gross_revenue, net_revenue, unit_cost, total_cost, margin,
    lower(trim(order_status)) AS order_status, _src_partkey, _src_suppkey, _src_shipdate
  FROM raw_sales
),
ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY transaction_id
      ORDER BY _src_partkey, _src_suppkey, _src_shipdate) AS INTEGER) AS _duplicate_rank
  FROM normalized
),
enriched AS (
  SELECT r.*, {", ".join("p." + c for c in PRODUCT_ATTRS)}, {", ".join("s." + c for c in STORE_ATTRS)},
    {", ".join("c." + c for c in CAL_ATTRS)}
  FROM ranked r
  LEFT JOIN products p ON r.product_id = p.product_id
  LEFT JOIN stores s ON r.store_id = s.store_id
  LEFT JOIN calendar c ON r.transaction_date = c.date
),
checked AS (
  SELECT *, concat_ws('|', {", ".join(f"CASE WHEN {RULE_SQL[r]} THEN '{r}' END" for r in REASONS)}) AS quality_reason
  FROM enriched
),
silver AS (
  SELECT {", ".join(c for c in SILVER if not c.startswith("realized_"))},
    CASE WHEN order_status = 'paid' THEN net_revenue ELSE CAST(0 AS {M}) END AS realized_revenue,
    CASE WHEN order_status = 'paid' THEN margin ELSE CAST(0 AS {M}) END AS realized_margin
  FROM checked WHERE quality_reason = ''
),
paid AS (SELECT * FROM silver WHERE order_status = 'paid')
"""


def q(body: str) -> str:
    return f"WITH {BASE}\n{body}"


def _rollup(keys: list[str]) -> str:
    k = ", ".join(["transaction_date", *keys])
    return q(f"""SELECT {k}, count(*) AS order_line_count, CAST(sum(quantity) AS BIGINT) AS units_sold,
      CAST(round(sum(realized_revenue), 2) AS DOUBLE) AS net_revenue,
      CAST(round(sum(realized_margin), 2) AS DOUBLE) AS margin
    FROM paid GROUP BY {k}""")


OVERVIEW = q("""
SELECT transaction_date, order_count, order_line_count, units_sold, net_revenue, gross_revenue,
  total_cost, margin,
  CASE WHEN order_count = 0 THEN CAST(0 AS DOUBLE)
       ELSE CAST((2 * revenue_cents + order_count) // (2 * order_count) AS DOUBLE) / 100 END
    AS average_order_value
FROM (
  SELECT transaction_date, count(DISTINCT order_id) AS order_count, count(*) AS order_line_count,
    CAST(sum(quantity) AS BIGINT) AS units_sold,
    CAST(round(sum(realized_revenue), 2) AS DOUBLE) AS net_revenue,
    CAST(round(sum(gross_revenue), 2) AS DOUBLE) AS gross_revenue,
    CAST(round(sum(total_cost), 2) AS DOUBLE) AS total_cost,
    CAST(round(sum(realized_margin), 2) AS DOUBLE) AS margin,
    CAST(round(sum(realized_revenue) * 100, 0) AS BIGINT) AS revenue_cents
  FROM paid GROUP BY transaction_date)
""")

DEFECTS = """
picked AS (
  SELECT *, row_number() OVER (ORDER BY transaction_id, _src_partkey, _src_suppkey, _src_shipdate) - 1 AS pick
  FROM (SELECT * FROM raw_sales ORDER BY transaction_id, _src_partkey, _src_suppkey, _src_shipdate LIMIT 3)
),
start_day AS (SELECT min(transaction_date) AS start FROM raw_sales),
issues AS (
  SELECT
    CASE pick WHEN 1 THEN 'T_INVALID_PRICE' WHEN 2 THEN 'T_MISSING_PRODUCT' ELSE transaction_id END AS transaction_id,
    CASE pick WHEN 1 THEN 'O_INVALID_PRICE' WHEN 2 THEN 'O_MISSING_PRODUCT' ELSE order_id END AS order_id,
    CASE pick WHEN 1 THEN CAST(start + INTERVAL 10 DAY AS DATE) WHEN 2 THEN CAST(start + INTERVAL 20 DAY AS DATE)
         ELSE transaction_date END AS transaction_date,
    CASE pick WHEN 2 THEN 'UNKNOWN_PRODUCT' ELSE product_id END AS product_id,
    store_id, channel, quantity,
    CASE pick WHEN 1 THEN CAST(-99 AS DECIMAL(18,2)) ELSE unit_price END AS unit_price,
    discount_percent,
    CASE pick WHEN 1 THEN CAST(-99 AS DECIMAL(18,2)) ELSE gross_revenue END AS gross_revenue,
    CASE pick WHEN 1 THEN CAST(-99 AS DECIMAL(18,2)) ELSE net_revenue END AS net_revenue,
    unit_cost, total_cost,
    CASE pick WHEN 1 THEN CAST(-150 AS DECIMAL(18,2)) ELSE margin END AS margin,
    CASE WHEN pick >= 1 THEN 'paid' ELSE order_status END AS order_status,
    _src_partkey, _src_suppkey, _src_shipdate
  FROM picked, start_day
),
with_defects AS (
  SELECT * FROM raw_sales UNION ALL SELECT * FROM issues
)
"""


def qd(body: str) -> str:
    return f"WITH {BASE},\n{DEFECTS}\n{body}"


def _share_body(keys: list[str], frame: list[str]) -> str:
    k = ", ".join(keys)
    f = ", ".join(frame)
    return f"""SELECT {k}, line_count,
      CAST(line_count AS DOUBLE) / CAST(sum(line_count) OVER (PARTITION BY {f}) AS DOUBLE) AS share
    FROM (SELECT {k}, count(*) AS line_count FROM paid GROUP BY {k})"""


def _job_outputs() -> str:
    """Rows, a sum and cents of every table that a whole run writes, and its report."""

    def cents(column: str) -> str:
        return f"CAST(sum(round({column} * 100)) AS BIGINT)"

    def total(column: str) -> str:
        return f"CAST(sum({column}) AS BIGINT)"

    none = "CAST(NULL AS BIGINT)"
    rollups = {
        "sales_by_product_daily": "transaction_date, product_id, product_name, category",
        "sales_by_category_daily": "transaction_date, category",
        "sales_by_city_daily": "transaction_date, city, region",
        "sales_by_channel_daily": "transaction_date, channel",
        "metric_overview_daily": "transaction_date",
    }
    parts = [
        f"SELECT 'bronze.sales_transactions' AS output, count(*) AS row_count, {total('quantity')} AS total, "
        f"{cents('net_revenue')} AS cents FROM raw_sales",
        f"SELECT 'silver', count(*), {total('quantity')}, {cents('realized_revenue')} FROM silver",
        f"SELECT 'quarantine', count(*), {total('_duplicate_rank')}, {cents('net_revenue')} "
        "FROM checked WHERE quality_reason <> ''",
        *[f"SELECT 'bronze.{n}', count(*), {none}, {none} FROM {n}" for n in ("products", "stores", "calendar")],
        *[
            f"SELECT 'gold.{n}', count(*), {total('units')}, {cents('revenue')} FROM "
            f"(SELECT sum(quantity) AS units, sum(realized_revenue) AS revenue FROM paid GROUP BY {keys})"
            for n, keys in rollups.items()
        ],
        f"SELECT 'reason.' || quality_reason, count(*), {none}, {none} FROM checked "
        "WHERE quality_reason <> '' GROUP BY quality_reason",
    ]
    counts = {
        "input_rows": "SELECT count(*) FROM raw_sales",
        "accepted_rows": "SELECT count(*) FROM silver",
        "rejected_rows": "SELECT count(*) FROM checked WHERE quality_reason <> ''",
        "duplicate_rows": "SELECT count(*) FROM checked WHERE _duplicate_rank > 1",
        "missing_product_rows":
            "SELECT count(*) FROM checked WHERE product_id IS NULL OR product_id = '' OR product_name IS NULL",
        "invalid_price_rows": "SELECT count(*) FROM checked WHERE unit_price IS NULL OR unit_price <= 0",
    }
    parts += [f"SELECT 'report.{c}', ({text}), {none}, {none}" for c, text in counts.items()]
    return q(" UNION ALL ".join(parts))


def oracle_queries() -> dict[str, str]:
    out: dict[str, str] = {}
    out["csv_roundtrip"] = q(f"SELECT {pub(SALES)} FROM raw_sales")
    out["parquet_roundtrip"] = q(f"SELECT {pub(SALES + SRC)} FROM raw_sales")
    out["bronze_ingest"] = q("""
      SELECT 'sales_transactions' AS table_name, count(*) AS row_count, CAST(1 AS BIGINT) AS distinct_ingest_times FROM raw_sales
      UNION ALL SELECT 'products', count(*), 1 FROM products
      UNION ALL SELECT 'stores', count(*), 1 FROM stores
      UNION ALL SELECT 'calendar', count(*), 1 FROM calendar""")
    types = {
        "transaction_date": "date", "quantity": "int",
        **{c: "double" for c in SALES if c in MONEY_COLUMNS},
    }
    out["schema_contract"] = q(" UNION ALL ".join(
        f"SELECT CAST({i + 1} AS INTEGER) AS position, '{c}' AS column_name, "
        f"'{types.get(c, 'string')}' AS data_type, count(*) FILTER (WHERE {c} IS NULL) AS null_count FROM raw_sales"
        for i, c in enumerate(SALES)
    ))
    out["csv_file_order_rank"] = q(
        "SELECT transaction_id, product_id, quantity, CAST(gross_revenue AS DOUBLE) AS gross_revenue, "
        "_duplicate_rank FROM ranked")
    edge = {
        c: f"CASE (_src_partkey + {k}) % 8 WHEN 0 THEN CAST(0.004 AS DOUBLE) WHEN 1 THEN CAST(-0.004 AS DOUBLE) "
           f"WHEN 2 THEN CAST('NaN' AS DOUBLE) WHEN 3 THEN CAST(1e17 AS DOUBLE) WHEN 4 THEN CAST(1.005 AS DOUBLE) "
           f"WHEN 5 THEN NULL ELSE CAST({c} AS DOUBLE) END"
        for k, c in enumerate(("unit_price", "unit_cost", "net_revenue"))
    }
    out["csv_money_edge"] = q(f"""
      SELECT transaction_id, product_id,
        p IS NULL OR p <= 0 AS invalid_unit_price, c IS NULL OR c < 0 AS invalid_unit_cost,
        coalesce(n < 0, false) AS invalid_net_revenue,
        round(CASE WHEN isnan(p) THEN -1 ELSE p END * 1000) AS unit_price_mills,
        round(CASE WHEN isnan(c) THEN -1 ELSE c END * 1000) AS unit_cost_mills,
        round(CASE WHEN isnan(n) THEN -1 ELSE n END * 1000) AS net_revenue_mills
      FROM (SELECT transaction_id, product_id, {edge['unit_price']} AS p, {edge['unit_cost']} AS c,
              {edge['net_revenue']} AS n FROM raw_sales)""")
    out["source_row_id"] = q("SELECT count(*) AS row_count, count(*) AS distinct_ids FROM raw_sales")
    out["normalize_text"] = q(
        f"SELECT {', '.join(ROW_ID)}, channel, order_status, product_id, store_id FROM normalized")
    out["duplicate_rank"] = q(f"SELECT {', '.join(ROW_ID)}, _duplicate_rank FROM ranked")
    out["realized_measures"] = q(
        f"SELECT transaction_id, order_status, {pub(['realized_revenue', 'realized_margin'])} FROM silver")
    out["join_products"] = q(f"""
      SELECT {', '.join('r.' + c for c in ROW_ID)}, r.product_id, {pub(PRODUCT_ATTRS, 'p.')}
      FROM ranked r LEFT JOIN products p ON r.product_id = p.product_id""")
    out["join_stores"] = q(f"""
      SELECT {', '.join('r.' + c for c in ROW_ID)}, r.store_id, {', '.join('s.' + c for c in STORE_ATTRS)}
      FROM ranked r LEFT JOIN stores s ON r.store_id = s.store_id""")
    out["join_calendar"] = q(f"""
      SELECT {', '.join('r.' + c for c in ROW_ID)}, r.transaction_date, {', '.join('c.' + c for c in CAL_ATTRS)}
      FROM ranked r LEFT JOIN calendar c ON r.transaction_date = c.date""")
    out["enriched_sales"] = q(f"SELECT {pub(ENRICHED)} FROM enriched")
    out["quality_reason"] = q(f"SELECT {', '.join(ROW_ID)}, quality_reason FROM checked")
    for r in REASONS:
        out[f"rule_{r}"] = q(f"SELECT {', '.join(ROW_ID)} FROM checked WHERE {RULE_SQL[r]}")
    out["silver_sales"] = q(f"SELECT {pub(SILVER)} FROM silver")
    out["quarantine_sales"] = q(f"SELECT {pub(ENRICHED + ['quality_reason'])} FROM checked WHERE quality_reason <> ''")
    out["metric_overview_daily"] = OVERVIEW
    out["sales_by_product_daily"] = _rollup(["product_id", "product_name", "category"])
    out["sales_by_category_daily"] = _rollup(["category"])
    out["sales_by_city_daily"] = _rollup(["city", "region"])
    out["sales_by_channel_daily"] = _rollup(["channel"])
    out["rejection_reasons"] = q(
        "SELECT quality_reason, count(*) AS row_count FROM checked WHERE quality_reason <> '' GROUP BY quality_reason")
    out["quality_report"] = q("""
      SELECT (SELECT count(*) FROM raw_sales) AS input_rows,
        count(*) FILTER (WHERE quality_reason = '') AS accepted_rows,
        count(*) FILTER (WHERE quality_reason <> '') AS rejected_rows,
        count(*) FILTER (WHERE quality_reason LIKE '%duplicate_transaction%') AS duplicate_rows,
        count(*) FILTER (WHERE quality_reason LIKE '%missing_product_id%'
                            OR quality_reason LIKE '%unknown_product%') AS missing_product_rows,
        count(*) FILTER (WHERE quality_reason LIKE '%invalid_unit_price%') AS invalid_price_rows
      FROM checked""")
    out["check_row_accounting"] = q("""
      SELECT input_rows, accepted_rows, rejected_rows, input_rows = accepted_rows + rejected_rows AS balanced
      FROM (SELECT (SELECT count(*) FROM raw_sales) AS input_rows,
        count(*) FILTER (WHERE quality_reason = '') AS accepted_rows,
        count(*) FILTER (WHERE quality_reason <> '') AS rejected_rows FROM checked)""")
    out["dataset_manifest"] = q("""
      SELECT 'sales_transactions' AS table_name, count(*) AS row_count FROM raw_sales
      UNION ALL SELECT 'products', count(*) FROM products
      UNION ALL SELECT 'stores', count(*) FROM stores
      UNION ALL SELECT 'calendar', count(*) FROM calendar""")
    full_calendar = calendar_select(FIRST_ORDER_DAY, LAST_ORDER_DAY)
    out["calendar_dim"] = full_calendar
    out["calendar_season"] = f"SELECT date, month, season FROM ({full_calendar})"
    out["calendar_holiday"] = f"SELECT date, holiday_name FROM ({full_calendar}) WHERE holiday_name IS NOT NULL"
    out["line_measures"] = q(f"""
      SELECT {', '.join(ROW_ID)}, {pub(['gross_revenue', 'net_revenue', 'total_cost', 'margin'])}
      FROM (
        SELECT {', '.join(ROW_ID)}, gross_revenue, total_cost,
          CASE WHEN cancelled THEN CAST(0 AS {M}) ELSE net END AS net_revenue,
          CASE WHEN cancelled THEN CAST(0 AS {M}) ELSE CAST(round(net - total_cost, 2) AS {M}) END AS margin
        FROM (
          SELECT *, CAST(round(gross_revenue * (100 - discount_percent) * CAST(0.01 AS DECIMAL(3,2)), 2) AS {M}) AS net
          FROM (
            SELECT {', '.join(ROW_ID)},
              CAST(round(quantity * unit_price, 2) AS {M}) AS gross_revenue,
              CAST(round(quantity * unit_cost, 2) AS {M}) AS total_cost,
              discount_percent, lower(trim(order_status)) = 'cancelled' AS cancelled
            FROM raw_sales)))""")
    out["product_dim"] = q(f"SELECT product_id, {pub(PRODUCT_ATTRS)} FROM products")
    out["store_dim"] = q(f"SELECT store_id, {', '.join(STORE_ATTRS)} FROM stores")
    out["inject_defects"] = qd(f"SELECT {pub(SALES + SRC)} FROM with_defects")
    out["check_order_metadata"] = q("""
      SELECT * FROM (
        SELECT order_id,
          count(DISTINCT transaction_date) + max(CAST(transaction_date IS NULL AS INTEGER)) > 1 AS transaction_date_differs,
          count(DISTINCT store_id) + max(CAST(store_id IS NULL AS INTEGER)) > 1 AS store_id_differs,
          count(DISTINCT channel) + max(CAST(channel IS NULL AS INTEGER)) > 1 AS channel_differs,
          count(DISTINCT order_status) + max(CAST(order_status IS NULL AS INTEGER)) > 1 AS order_status_differs
        FROM raw_sales GROUP BY order_id)
      WHERE transaction_date_differs OR store_id_differs OR channel_differs OR order_status_differs""")
    out["order_line_histogram"] = q("""
      SELECT lines_per_order, count(*) AS order_count
      FROM (SELECT order_id, count(*) AS lines_per_order FROM raw_sales GROUP BY order_id)
      GROUP BY lines_per_order""")
    cols = SALES + SRC
    out["check_dataset_equal"] = qd(f"""
      SELECT 'left_only' AS side, {pub(cols)} FROM (SELECT * FROM raw_sales EXCEPT ALL SELECT * FROM with_defects)
      UNION ALL
      SELECT 'right_only' AS side, {pub(cols)} FROM (SELECT * FROM with_defects EXCEPT ALL SELECT * FROM raw_sales)""")
    out["pattern_event_category_share"] = q("""
      SELECT in_event_window, category, line_count,
        CAST(line_count AS DOUBLE) / CAST(sum(line_count) OVER (PARTITION BY in_event_window) AS DOUBLE) AS share
      FROM (SELECT (month(transaction_date) = 11 AND day(transaction_date) >= 23) AS in_event_window,
              category, count(*) AS line_count
            FROM paid GROUP BY 1, 2)""")
    out["pattern_weekend_effect"] = q("""
      SELECT c.is_weekend, c.category, c.line_count, d.day_count,
        CAST(c.line_count AS DOUBLE) / CAST(d.day_count AS DOUBLE) AS lines_per_day,
        CAST(c.line_count AS DOUBLE) / CAST(sum(c.line_count) OVER (PARTITION BY c.is_weekend) AS DOUBLE) AS share
      FROM (SELECT is_weekend, category, count(*) AS line_count FROM paid GROUP BY 1, 2) c
      JOIN (SELECT is_weekend, count(DISTINCT transaction_date) AS day_count FROM paid GROUP BY 1) d
        ON c.is_weekend = d.is_weekend""")
    out["pattern_channel_share_monthly"] = q(_share_body(["year", "month", "channel"], ["year", "month"]))
    out["pattern_category_share_monthly"] = q(
        _share_body(["year", "month", "season", "category"], ["year", "month"]))
    out["pattern_category_share_season"] = q(_share_body(["season", "category"], ["season"]))
    for name in ("metric_overview_daily", "sales_by_product_daily", "sales_by_category_daily",
                 "sales_by_city_daily", "sales_by_channel_daily"):
        out[f"sql_{name}"] = out[name]
        out[f"sql_double_{name}"] = out[name]
    out["silver_month_pruned"] = q(f"SELECT {pub(SILVER)} FROM silver WHERE year = 1995 AND month = 3")
    for name in ("metric_overview_daily", "sales_by_city_daily"):
        out[f"partials_{name}"] = out[name]
    out["job_outputs"] = _job_outputs()
    return out
