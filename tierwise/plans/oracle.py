"""Independent SQL for every registry key, written by hand for DuckDB.

The driver pre-registers the input tables as views. These statements restate
each operator's semantics in plain SQL (window ``row_number`` for dedup and
keys, ``CASE`` for labels, exact decimals for money) so the Spark plans are
checked against a different formulation, not against themselves.
"""

from __future__ import annotations

# ---------------------------------------------------------------- bronze / silver

BRONZE_SALES = """
bronze_sales AS (
  SELECT l.l_orderkey AS order_id, l.l_linenumber AS line_no,
         CASE WHEN l.l_orderkey % 97 = 0 THEN NULL ELSE o.o_custkey END AS customer_id,
         l.l_partkey AS product_id, l.l_suppkey AS supplier_id,
         CAST(o.o_orderdate AS DATE) AS order_date, CAST(l.l_shipdate AS DATE) AS ship_date,
         CAST(l.l_quantity AS INTEGER) AS quantity,
         CASE WHEN l.l_quantity = 0 THEN NULL ELSE l.l_extendedprice / l.l_quantity END AS unit_price,
         CASE WHEN l.l_orderkey % 89 = 0 THEN -l.l_extendedprice ELSE l.l_extendedprice END AS amount,
         o.o_orderpriority AS channel,
         CAST(round(l.l_discount * 100) AS INTEGER) AS discount_pct,
         l.l_tax AS tax, l.l_returnflag AS return_flag, l.l_linestatus AS line_status,
         'lineitem_orders' AS _source
  FROM lineitem l LEFT JOIN orders o ON l.l_orderkey = o.o_orderkey)"""

LABELLED_SALES = BRONZE_SALES + """,
labelled_sales AS (
  SELECT order_id, line_no, customer_id, product_id, supplier_id, order_date, ship_date,
         quantity, unit_price, amount, NULLIF(trim(channel), '') AS channel, discount_pct, tax,
         NULLIF(trim(return_flag), '') AS return_flag, NULLIF(trim(line_status), '') AS line_status,
         _source,
         CASE WHEN customer_id IS NULL AND amount < 0 THEN 'missing customer and negative amount'
              WHEN customer_id IS NULL THEN 'missing customer_id'
              WHEN amount < 0 THEN 'negative amount'
              ELSE 'ok' END AS data_issue
  FROM bronze_sales)"""

DEDUP_SALES = LABELLED_SALES + """,
ranked_sales AS (
  SELECT *,
         row_number() OVER (PARTITION BY order_id, line_no
           ORDER BY ship_date NULLS FIRST, product_id NULLS FIRST, supplier_id NULLS FIRST,
                    amount NULLS FIRST, quantity NULLS FIRST, discount_pct NULLS FIRST,
                    tax NULLS FIRST, return_flag NULLS FIRST, line_status NULLS FIRST,
                    customer_id NULLS FIRST, order_date NULLS FIRST, unit_price NULLS FIRST,
                    channel NULLS FIRST) AS rn,
         count(*) OVER (PARTITION BY order_id, line_no) AS copies
  FROM labelled_sales WHERE data_issue = 'ok'),
silver_sales AS (
  SELECT order_id, line_no, customer_id, product_id, supplier_id, order_date, ship_date,
         quantity, unit_price, amount, channel, discount_pct, tax, return_flag, line_status,
         _source, copies
  FROM ranked_sales WHERE rn = 1)"""

SALES_COLS = ("order_id, line_no, customer_id, product_id, supplier_id, order_date, ship_date, "
              "quantity, unit_price, amount, channel, discount_pct, tax, return_flag, "
              "line_status, _source")


def _customers(dirty: bool) -> str:
    name = "CASE WHEN c.c_custkey % 83 = 0 THEN NULL ELSE c.c_name END" if dirty else "c.c_name"
    return f"""
bronze_customers AS (
  SELECT c.c_custkey AS customer_id, {name} AS name, CAST(NULL AS VARCHAR) AS email,
         r.r_name AS region, c.c_mktsegment AS segment, n.n_name AS country_code,
         CAST(NULL AS DATE) AS updated_at, 'customer_nation_region' AS _source
  FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
                  LEFT JOIN region r ON n.n_regionkey = r.r_regionkey),
labelled_customers AS (
  SELECT customer_id, NULLIF(trim(name), '') AS name, NULLIF(trim(email), '') AS email,
         NULLIF(trim(region), '') AS region, NULLIF(trim(segment), '') AS segment,
         NULLIF(upper(trim(country_code)), '') AS country_code, updated_at, _source
  FROM bronze_customers),
labelled_customers2 AS (
  SELECT *, CASE WHEN customer_id IS NULL THEN 'missing customer_id'
                 WHEN name IS NULL THEN 'missing name'
                 WHEN country_code IS NULL THEN 'missing country_code'
                 ELSE 'ok' END AS data_issue
  FROM labelled_customers),
silver_customers AS (
  SELECT customer_id, name, email, region, segment, country_code, updated_at, _source
  FROM (SELECT *, row_number() OVER (PARTITION BY customer_id
          ORDER BY updated_at DESC NULLS LAST, name NULLS FIRST, email NULLS FIRST,
                   region NULLS FIRST, segment NULLS FIRST, country_code NULLS FIRST,
                   _source NULLS FIRST) AS rn
        FROM labelled_customers2 WHERE data_issue = 'ok') t
  WHERE rn = 1)"""


def _products(dirty: bool) -> str:
    cost = ("CASE WHEN p_partkey % 71 = 0 THEN NULL ELSE p_retailprice END" if dirty
            else "p_retailprice")
    return f"""
bronze_products AS (
  SELECT p_partkey AS product_id, p_name AS name, p_type AS category, p_brand AS brand,
         {cost} AS unit_cost, 'part' AS _source
  FROM part),
labelled_products AS (
  SELECT product_id, NULLIF(trim(name), '') AS name, NULLIF(trim(category), '') AS category,
         NULLIF(trim(brand), '') AS brand, unit_cost, _source,
         CASE WHEN product_id IS NULL THEN 'missing product_id'
              WHEN NULLIF(trim(name), '') IS NULL THEN 'missing name'
              WHEN NULLIF(trim(category), '') IS NULL THEN 'missing category'
              WHEN unit_cost IS NULL THEN 'missing unit_cost'
              ELSE 'ok' END AS data_issue
  FROM bronze_products),
silver_products AS (
  SELECT product_id, name, category, brand, unit_cost, _source
  FROM (SELECT *, row_number() OVER (PARTITION BY product_id
          ORDER BY name NULLS FIRST, category NULLS FIRST, brand NULLS FIRST,
                   unit_cost NULLS FIRST, _source NULLS FIRST) AS rn
        FROM labelled_products WHERE data_issue = 'ok') t
  WHERE rn = 1)"""


def with_(*ctes: str) -> str:
    return "WITH " + ",".join(c.strip().rstrip(",") for c in ctes) + "\n"


SQL: dict[str, str] = {}

SQL["bronze_sales"] = with_(BRONZE_SALES) + "SELECT * FROM bronze_sales"

SQL["label_sales"] = with_(LABELLED_SALES) + """
SELECT data_issue, count(*) AS row_count,
       CAST(sum(CAST(CAST(amount AS DECIMAL(18,2)) * 100 AS BIGINT)) AS DOUBLE) / 100 AS amount_total
FROM labelled_sales GROUP BY data_issue"""

SQL["quarantine_sales"] = with_(LABELLED_SALES) + """
SELECT * FROM labelled_sales WHERE data_issue <> 'ok'"""

SQL["dedup_sales"] = with_(DEDUP_SALES) + "SELECT * FROM silver_sales"

SQL["silver_sales"] = with_(DEDUP_SALES) + f"SELECT {SALES_COLS} FROM silver_sales"

SQL["pipeline_metrics"] = with_(LABELLED_SALES) + """
SELECT count(*) AS bronze_rows,
       count(*) FILTER (WHERE data_issue = 'ok') AS good_rows,
       count(*) FILTER (WHERE data_issue <> 'ok') AS quarantined_rows,
       count(DISTINCT CASE WHEN data_issue = 'ok' THEN (order_id, line_no) END) AS silver_rows,
       count(*) FILTER (WHERE data_issue = 'ok')
         - count(DISTINCT CASE WHEN data_issue = 'ok' THEN (order_id, line_no) END)
         AS duplicates_removed
FROM labelled_sales"""

SQL["label_customers"] = with_(_customers(True)) + """
SELECT data_issue, count(*) AS row_count FROM labelled_customers2 GROUP BY data_issue"""

SQL["label_products"] = with_(_products(True)) + """
SELECT data_issue, count(*) AS row_count FROM labelled_products GROUP BY data_issue"""

SQL["silver_customers"] = with_(_customers(False)) + "SELECT * FROM silver_customers"

SQL["silver_products"] = with_(_products(False)) + "SELECT * FROM silver_products"


# ---------------------------------------------------------------- gold

def _gold(dirty_customers: bool = False) -> str:
    return with_(DEDUP_SALES, _customers(dirty_customers), _products(False), """
dim_customer AS (
  SELECT row_number() OVER (ORDER BY customer_id NULLS FIRST) AS customer_sk,
         customer_id, name, email, region, segment, country_code, updated_at
  FROM silver_customers),
dim_product AS (
  SELECT row_number() OVER (ORDER BY product_id NULLS FIRST) AS product_sk,
         product_id, name, category, brand, unit_cost
  FROM silver_products),
dim_channel AS (
  SELECT row_number() OVER (ORDER BY channel NULLS FIRST) AS channel_sk, channel
  FROM (SELECT DISTINCT channel FROM silver_sales) t),
spine AS (
  SELECT CAST(unnest(generate_series(min(order_date), max(order_date), INTERVAL 1 DAY)) AS DATE)
         AS full_date
  FROM silver_sales),
dim_date AS (
  SELECT CAST(strftime(full_date, '%Y%m%d') AS INTEGER) AS date_sk, full_date,
         CAST(year(full_date) AS INTEGER) AS year, CAST(quarter(full_date) AS INTEGER) AS quarter,
         CAST(month(full_date) AS INTEGER) AS month, CAST(day(full_date) AS INTEGER) AS day,
         strftime(full_date, '%A') AS day_name, strftime(full_date, '%B') AS month_name,
         CAST(weekofyear(full_date) AS INTEGER) AS week_of_year,
         CASE WHEN strftime(full_date, '%A') IN ('Saturday', 'Sunday') THEN 'Weekend'
              ELSE 'Weekday' END AS day_type
  FROM spine),
fact_sales AS (
  SELECT s.order_id, s.line_no, c.customer_sk, p.product_sk, ch.channel_sk,
         CAST(strftime(s.order_date, '%Y%m%d') AS INTEGER) AS date_sk,
         s.customer_id, s.product_id, s.channel, s.order_date, s.quantity, s.unit_price,
         s.amount, s.discount_pct, s.amount - s.quantity * p.unit_cost AS gross_profit
  FROM silver_sales s
  LEFT JOIN dim_customer c ON s.customer_id = c.customer_id
  LEFT JOIN dim_product p ON s.product_id = p.product_id
  LEFT JOIN dim_channel ch ON s.channel = ch.channel)""")


def cents_sum(expr: str) -> str:
    return f"CAST(sum(CAST({expr} AS DECIMAL(18,2)) * 100) AS BIGINT)"


def from_cents(expr: str) -> str:
    """Exact cents -> DOUBLE currency units."""
    return f"(CAST({expr} AS DOUBLE) / 100)"


def money(expr: str) -> str:
    """Exact sum of a double money column, as DOUBLE."""
    return from_cents(cents_sum(expr))


def rounded(num: str, den: str, scale: int) -> str:
    """round(num/den*scale), half away from zero, with integer arithmetic."""
    return (f"(CASE WHEN ({den}) = 0 THEN NULL ELSE sign({num}) * sign({den}) * "
            f"((abs({num}) * {2 * scale} + abs({den})) // (abs({den}) * 2)) END)")


def avg_money(sum_cents: str, n: str) -> str:
    return from_cents(rounded(sum_cents, n, 1))


def pct(part: str, whole: str) -> str:
    return f"(CAST({rounded(part, whole, 1000)} AS DOUBLE) / 10)"


STAR_GROUPS = ("d.year, d.quarter, d.month, d.month_name, d.day_type, p.category, p.brand, "
               "c.region, c.segment, c.country_code, ch.channel")

KPI_STAR = f"""
kpi AS (
  SELECT {STAR_GROUPS},
         count(DISTINCT f.order_id) AS order_count,
         CAST(sum(f.quantity) AS BIGINT) AS units_sold,
         {money('f.amount')} AS revenue,
         {avg_money(cents_sum('f.amount'), 'count(DISTINCT f.order_id)')} AS avg_order_value,
         {money('f.gross_profit')} AS gross_profit,
         {pct(cents_sum('f.gross_profit'), cents_sum('f.amount'))} AS margin_pct
  FROM fact_sales f
  JOIN dim_date d ON f.date_sk = d.date_sk
  JOIN dim_product p ON f.product_sk = p.product_sk
  JOIN dim_customer c ON f.customer_sk = c.customer_sk
  JOIN dim_channel ch ON f.channel_sk = ch.channel_sk
  GROUP BY {STAR_GROUPS})"""

SQL["dim_date_data"] = _gold() + "SELECT * FROM dim_date"
SQL["dim_date_range"] = _gold() + \
    "SELECT * FROM dim_date WHERE full_date BETWEEN DATE '1998-01-15' AND DATE '1998-01-18'"
SQL["dim_customer"] = _gold() + "SELECT * FROM dim_customer"
SQL["dim_product"] = _gold() + "SELECT * FROM dim_product"
SQL["dim_channel"] = _gold() + "SELECT * FROM dim_channel"
SQL["fact_sales"] = _gold() + "SELECT * FROM fact_sales"
SQL["kpi_star"] = _gold().rstrip() + "," + KPI_STAR + "\nSELECT * FROM kpi"
SQL["kpi_top"] = _gold().rstrip() + "," + KPI_STAR + """
SELECT * FROM kpi
ORDER BY revenue DESC, year NULLS FIRST, quarter NULLS FIRST, month NULLS FIRST,
         month_name NULLS FIRST, day_type NULLS FIRST, category NULLS FIRST, brand NULLS FIRST,
         region NULLS FIRST, segment NULLS FIRST, country_code NULLS FIRST, channel NULLS FIRST
LIMIT 10"""

SQL["kpi_time"] = _gold() + f"""
SELECT CAST(year(order_date) AS INTEGER) AS year, CAST(quarter(order_date) AS INTEGER) AS quarter,
       CAST(month(order_date) AS INTEGER) AS month,
       CAST(GROUPING(year(order_date), quarter(order_date), month(order_date)) AS INTEGER)
         AS grouping_level,
       count(DISTINCT order_id) AS order_count, CAST(sum(quantity) AS BIGINT) AS units_sold,
       {money('amount')} AS revenue
FROM fact_sales
GROUP BY ROLLUP (year(order_date), quarter(order_date), month(order_date))"""

SQL["kpi_channel"] = _gold() + f"""
SELECT channel, count(DISTINCT order_id) AS order_count, count(*) AS line_count,
       {money('amount')} AS revenue
FROM fact_sales GROUP BY channel"""

SQL["kpi_daytype"] = _gold() + f"""
SELECT CASE WHEN dayofweek(order_date) IN (0, 6) THEN 'Weekend' ELSE 'Weekday' END AS day_type,
       count(DISTINCT order_id) AS order_count, CAST(sum(quantity) AS BIGINT) AS units_sold,
       {money('amount')} AS revenue
FROM fact_sales GROUP BY 1"""

SQL["kpi_segment"] = _gold() + f"""
SELECT c.segment, count(DISTINCT f.order_id) AS order_count, {money('f.amount')} AS revenue,
       {avg_money(cents_sum('f.amount'), 'count(DISTINCT f.order_id)')} AS avg_order_value
FROM fact_sales f JOIN dim_customer c ON f.customer_sk = c.customer_sk
GROUP BY c.segment"""

SQL["kpi_category"] = _gold() + f"""
SELECT p.category, {money('f.amount')} AS revenue, {money('f.gross_profit')} AS gross_profit,
       {pct(cents_sum('f.gross_profit'), cents_sum('f.amount'))} AS margin_pct
FROM fact_sales f JOIN dim_product p ON f.product_sk = p.product_sk
GROUP BY p.category"""

SQL["kpi_geo"] = _gold() + f"""
SELECT c.region, c.country_code,
       CAST(GROUPING(c.region, c.country_code) AS INTEGER) AS grouping_level,
       count(*) AS line_count, {money('f.amount')} AS revenue
FROM fact_sales f JOIN dim_customer c ON f.customer_sk = c.customer_sk
GROUP BY ROLLUP (c.region, c.country_code)"""

SQL["kpi_dropped"] = _gold(dirty_customers=True) + f"""
SELECT count(*) FILTER (WHERE dropped) AS dropped_rows,
       COALESCE({money('CASE WHEN dropped THEN amount END')}, CAST(0 AS DOUBLE))
         AS dropped_revenue,
       count(*) FILTER (WHERE customer_sk IS NULL) AS missing_customer,
       count(*) FILTER (WHERE product_sk IS NULL) AS missing_product,
       count(*) FILTER (WHERE channel_sk IS NULL) AS missing_channel,
       count(*) FILTER (WHERE has_date IS NULL) AS missing_date
FROM (SELECT f.*, d.date_sk IS NOT NULL AS has_date,
             (f.customer_sk IS NULL OR f.product_sk IS NULL OR f.channel_sk IS NULL
              OR d.date_sk IS NULL) AS dropped
      FROM fact_sales f LEFT JOIN dim_date d ON f.date_sk = d.date_sk) t"""


# ---------------------------------------------------------------- customer history

HISTORY = with_(DEDUP_SALES, _customers(False), """
history AS (
  SELECT customer_id, name, email, region, segment, country_code, DATE '1990-01-01' AS updated_at, _source
  FROM silver_customers
  UNION ALL
  SELECT customer_id, name, email, region, 'MOVED', country_code,
         DATE '1996-01-01' + CAST(customer_id % 1500 AS INTEGER), _source
  FROM silver_customers WHERE customer_id % 3 = 0),
versions AS (
  SELECT customer_id, name, segment, country_code, updated_at AS valid_from,
         lead(updated_at) OVER w AS valid_to, CAST(row_number() OVER w AS INTEGER) AS version_no,
         lead(updated_at) OVER w IS NULL AS is_current
  FROM history WINDOW w AS (PARTITION BY customer_id ORDER BY updated_at))""")

SQL["upsert_customers"] = HISTORY + """
SELECT * FROM history QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY updated_at DESC) = 1"""

SQL["dim_customer_scd2"] = HISTORY + "SELECT * FROM versions"

SQL["snapshot_customers"] = SQL["upsert_customers"]

SQL["merge_customer_versions"] = HISTORY + """
SELECT *, md5('false|' || customer_id || '|' || strftime(valid_from, '%Y-%m-%d')) AS version_key FROM versions"""

SQL["fact_asof"] = HISTORY + """
SELECT s.order_id, s.line_no, s.customer_id, s.order_date, s.amount, v.segment, v.version_no,
       v.valid_from, v.valid_to
FROM silver_sales s ASOF LEFT JOIN versions v
  ON s.customer_id = v.customer_id AND s.order_date >= v.valid_from"""


SQL["events_once"] = """
SELECT * FROM events WHERE event_id IS NOT NULL AND ts IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY ts, user_id, event_type, value, props) = 1"""


# ---------------------------------------------------------------- checks and health

def _renamed(cte_sql: str, names: list[str], prefix: str) -> str:
    for n in sorted(names, key=len, reverse=True):
        cte_sql = cte_sql.replace(n, prefix + n)
    return cte_sql


DIRTY_DIMS = (
    _renamed(_customers(True), ["bronze_customers", "labelled_customers", "silver_customers"],
             "dirty_")
    + "," + _renamed(_products(True), ["bronze_products", "labelled_products", "silver_products"],
                     "dirty_"))

CENTS = "CAST(CAST({} AS DECIMAL(18,2)) * 100 AS BIGINT)"

METRICS = """
m_bronze AS (
  SELECT count(*) AS rows,
         count(*) FILTER (WHERE data_issue <> 'ok') AS quarantined,
         count(DISTINCT CASE WHEN data_issue = 'ok' THEN (order_id, line_no) END) AS good_keys,
         count(*) FILTER (WHERE data_issue = 'ok')
           - count(DISTINCT CASE WHEN data_issue = 'ok' THEN (order_id, line_no) END) AS duplicates,
         sum(CASE WHEN data_issue = 'ok' THEN CAST(CAST(amount AS DECIMAL(18,2)) * 100 AS BIGINT) END)
           AS valid_revenue_all,
         max(CASE WHEN data_issue = 'ok' THEN order_date END) AS latest
  FROM labelled_sales),
m_silver AS (
  SELECT count(*) AS rows,
         count(*) FILTER (WHERE order_id IS NULL) AS null_order_id,
         count(*) FILTER (WHERE product_id IS NULL) AS null_product_id,
         count(*) FILTER (WHERE amount IS NULL) AS null_amount,
         count(*) FILTER (WHERE order_date IS NULL) AS null_order_date,
         count(*) FILTER (WHERE amount < 0) AS negative,
         sum(CAST(CAST(amount AS DECIMAL(18,2)) * 100 AS BIGINT)) AS revenue,
         max(order_date) AS latest
  FROM silver_sales),
m_dups AS (
  SELECT count(*) AS n FROM (SELECT order_id, line_no FROM silver_sales
                             GROUP BY order_id, line_no HAVING count(*) > 1) t),
m_orphan_c AS (
  SELECT count(*) AS n FROM silver_sales s
  WHERE NOT EXISTS (SELECT 1 FROM dirty_silver_customers c WHERE c.customer_id = s.customer_id)),
m_orphan_p AS (
  SELECT count(*) AS n FROM silver_sales s
  WHERE NOT EXISTS (SELECT 1 FROM dirty_silver_products p WHERE p.product_id = s.product_id)),
m_repeats AS (
  SELECT coalesce(sum(CAST(CAST(amount AS DECIMAL(18,2)) * 100 AS BIGINT)), 0) AS revenue
  FROM ranked_sales WHERE rn > 1),
m_schema AS (
  SELECT 9 - len(list_intersect(json_keys(to_json(s)), ['order_id', 'customer_id', 'product_id', 'order_date',
         'quantity', 'unit_price', 'amount', 'channel', 'discount_pct'])) AS missing
  FROM (SELECT silver_sales AS s FROM silver_sales LIMIT 1)),
m_fact AS (
  SELECT count(*) FILTER (WHERE gross_profit < 0) AS negative_profit FROM fact_sales)"""


def _money_txt(cents: str) -> str:
    return f"CAST(CAST(CAST({cents} AS DECIMAL(38,0)) * 0.01 AS DECIMAL(38,2)) AS VARCHAR)"


def _row(name: str, actual: str, expected: str, details: str, src: str) -> str:
    return (f"SELECT '{name}' AS \"check\", CASE WHEN ({actual}) IS NOT DISTINCT FROM ({expected}) "
            f"THEN 'PASS' ELSE 'FAIL' END AS status, CAST({expected} AS VARCHAR) AS expected, "
            f"CAST({actual} AS VARCHAR) AS actual, {details} AS details FROM {src}")


CHECK_ROWS = {
    "check_row_count": [_row(
        "silver_sales holds every valid key once", "s.rows", "b.good_keys",
        "'of ' || b.rows || ' bronze lines ' || b.quarantined || ' rejected, ' || b.duplicates || ' repeated'",
        "m_silver s, m_bronze b")],
    "check_nulls": [_row(f"silver_sales.{c} is filled", f"s.null_{c}", "0",
                         f"s.null_{c} || ' lines without {c}'", "m_silver s")
                    for c in ["order_id", "product_id", "amount", "order_date"]],
    "check_unique": [_row("silver_sales key occurs once", "d.n", "0",
                          "d.n || ' repeated keys'", "m_dups d")],
    "check_negative": [_row("silver_sales amounts are not below zero", "s.negative", "0",
                            "s.negative || ' lines below zero'", "m_silver s")],
    "check_orphan_customer": [_row("every line''s customer is known", "o.n", "0",
                                   "o.n || ' lines with an unknown customer'",
                                   "m_orphan_c o")],
    "check_orphan_product": [_row("every line''s product is known", "o.n", "0",
                                  "o.n || ' lines with an unknown product'",
                                  "m_orphan_p o")],
    "check_reconcile": [
        f"SELECT 'silver_sales revenue agrees with bronze' AS \"check\", "
        f"CASE WHEN s.revenue IS NOT DISTINCT FROM b.valid_revenue_all - r.revenue THEN 'PASS' ELSE 'FAIL' END AS status, "
        f"{_money_txt('b.valid_revenue_all - r.revenue')} AS expected, {_money_txt('s.revenue')} AS actual, "
        f"'repeated lines included: ' || {_money_txt('b.valid_revenue_all')} AS details "
        f"FROM m_silver s, m_bronze b, m_repeats r"],
    "check_freshness": [_row("silver_sales is as recent as bronze", "s.latest", "b.latest",
                             "'newest order is of ' || s.latest || ', needed ' || b.latest",
                             "m_silver s, m_bronze b")],
    "check_profit": [_row("no line sells below cost", "f.negative_profit", "0",
                          "f.negative_profit || ' lines below cost'",
                          "m_fact f")],
    "check_schema": [_row("silver_sales has every expected column", "k.missing", "0",
                          "(9 - k.missing) || ' of 9 present'", "m_schema k")],
}

CHECKS_BASE = _gold().rstrip() + "," + DIRTY_DIMS + "," + METRICS + "\n"

for _k, _rows in CHECK_ROWS.items():
    SQL[_k] = CHECKS_BASE + "\nUNION ALL\n".join(_rows)

SQL["checks_summary"] = CHECKS_BASE + f"""
SELECT status, count(*) AS n_checks FROM (
{chr(10).join(['UNION ALL ' + r if i else r for i, r in enumerate(
    [r for rows in CHECK_ROWS.values() for r in rows])])}
) t GROUP BY status"""

SQL["reconcile_detail"] = with_(DEDUP_SALES) + """
, b AS (SELECT order_id, line_no, count(*) AS bronze_rows,
               sum(CAST(CAST(amount AS DECIMAL(18,2)) * 100 AS BIGINT)) AS bc
        FROM labelled_sales WHERE data_issue = 'ok' GROUP BY order_id, line_no),
  s AS (SELECT order_id, line_no, sum(CAST(CAST(amount AS DECIMAL(18,2)) * 100 AS BIGINT)) AS sc
        FROM silver_sales GROUP BY order_id, line_no)
SELECT COALESCE(b.order_id, s.order_id) AS order_id, COALESCE(b.line_no, s.line_no) AS line_no,
       COALESCE(b.bronze_rows, 0) AS bronze_rows,
       """ + from_cents("b.bc") + """ AS bronze_amount,
       """ + from_cents("s.sc") + """ AS silver_amount,
       """ + from_cents("COALESCE(b.bc, 0) - COALESCE(s.sc, 0)") + """ AS difference
FROM b FULL OUTER JOIN s ON b.order_id = s.order_id AND b.line_no = s.line_no
WHERE b.bc IS DISTINCT FROM s.sc"""

SQL["health_counts"] = CHECKS_BASE.rstrip() + "," + KPI_STAR + """,
counts AS (
  SELECT 'bronze_sales' AS table_name, (SELECT count(*) FROM lineitem) AS expected_rows,
         (SELECT count(*) FROM bronze_sales) AS actual_rows
  UNION ALL SELECT 'bronze_customers', (SELECT count(*) FROM customer),
         (SELECT count(*) FROM bronze_customers)
  UNION ALL SELECT 'bronze_products', (SELECT count(*) FROM part),
         (SELECT count(*) FROM bronze_products)
  UNION ALL SELECT 'quarantine_sales',
         (SELECT count(*) FILTER (WHERE data_issue <> 'ok') FROM labelled_sales),
         (SELECT count(*) FROM labelled_sales WHERE data_issue <> 'ok')
  UNION ALL SELECT 'silver_sales', (SELECT good_keys FROM m_bronze),
         (SELECT count(*) FROM silver_sales)
  UNION ALL SELECT 'silver_customers',
         (SELECT count(DISTINCT customer_id) FROM labelled_customers2 WHERE data_issue = 'ok'),
         (SELECT count(*) FROM silver_customers)
  UNION ALL SELECT 'silver_products',
         (SELECT count(DISTINCT product_id) FROM labelled_products WHERE data_issue = 'ok'),
         (SELECT count(*) FROM silver_products)
  UNION ALL SELECT 'dim_date',
         (SELECT max(order_date) - min(order_date) + 1 FROM silver_sales),
         (SELECT count(*) FROM dim_date)
  UNION ALL SELECT 'dim_customer', (SELECT count(*) FROM silver_customers),
         (SELECT count(*) FROM dim_customer)
  UNION ALL SELECT 'dim_product', (SELECT count(*) FROM silver_products),
         (SELECT count(*) FROM dim_product)
  UNION ALL SELECT 'dim_channel',
         (SELECT count(DISTINCT channel) + max(CASE WHEN channel IS NULL THEN 1 ELSE 0 END)
          FROM silver_sales),
         (SELECT count(*) FROM dim_channel)
  UNION ALL SELECT 'fact_sales', (SELECT count(*) FROM silver_sales),
         (SELECT count(*) FROM fact_sales)
  UNION ALL SELECT 'kpi_star',
         (SELECT count(*) FROM (SELECT DISTINCT date_trunc('month', s.order_date),
                 dayofweek(s.order_date) IN (0, 6), p.category, p.brand, c.region, c.segment,
                 c.country_code, s.channel
          FROM silver_sales s JOIN silver_products p USING (product_id)
          JOIN silver_customers c USING (customer_id) WHERE s.channel IS NOT NULL) t),
         (SELECT count(*) FROM kpi)),
rows_ AS (
  SELECT table_name, CAST(expected_rows AS BIGINT) AS expected_rows,
         CAST(actual_rows AS BIGINT) AS actual_rows,
         CASE WHEN expected_rows = actual_rows THEN 'PASS' ELSE 'FAIL' END AS status
  FROM counts)
SELECT * FROM rows_
UNION ALL
SELECT 'ALL', count(*), count(*) FILTER (WHERE status = 'PASS'),
       CASE WHEN bool_and(status = 'PASS') THEN 'PASS' ELSE 'FAIL' END
FROM rows_"""
