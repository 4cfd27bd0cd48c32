"""DuckDB SQL oracles.  Written directly against the driver's tables
(region nation customer supplier part orders lineitem events ...), sharing
only the data-model mapping below, which both engines must apply identically."""
from __future__ import annotations

VIEWS = {
    "transactions": """transactions AS (
  SELECT l.l_orderkey AS transaction_id, o.o_custkey AS customer_id, l.l_partkey AS sku_id,
         o.o_orderdate AS "timestamp", CAST(trunc(l.l_quantity) AS INTEGER) AS quantity,
         CAST(l.l_discount AS DECIMAL(4,2)) AS discount_applied,
         round(CAST(l.l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l.l_discount AS DECIMAL(4,2))), 2) AS total_amount
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey)""",
    "products": """products AS (
  SELECT p_partkey AS sku_id, p_type AS category, CAST(p_retailprice AS DECIMAL(12,2)) AS base_price,
         CAST(CAST(p_retailprice AS DECIMAL(12,2)) * CAST(0.6 AS DECIMAL(2,1)) AS DECIMAL(12,2)) AS cost_price
  FROM part)""",
    "customers": """customers AS (
  SELECT c.c_custkey AS customer_id, CAST(18 + c.c_custkey % 57 AS INTEGER) AS age,
         CASE WHEN c.c_custkey % 25 = 0 THEN 'Other' WHEN (c.c_custkey % 25) % 2 = 1 THEN 'M' ELSE 'F' END AS gender,
         c.c_mktsegment AS segment, n.n_name AS region
  FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey)""",
    "inventory": """inventory AS (
  SELECT p_partkey AS sku_id, CAST((p_partkey * 37) % 500 AS INTEGER) AS current_stock,
         CAST(20 + p_partkey % 80 AS INTEGER) AS reorder_point,
         CAST(2 + p_partkey % 12 AS INTEGER) AS supplier_lead_time_days
  FROM part)""",
}


def with_views(*names: str, extra: str = "") -> str:
    parts = [VIEWS[n] for n in names]
    if extra:
        parts.append(extra)
    return "WITH " + ",\n".join(parts) + "\n"


def elapsed(later: str, earlier: str) -> str:
    return f"CAST(floor((epoch_us({later}) - epoch_us({earlier})) / 86400000000) AS BIGINT)"


def r6(expr: str) -> str:
    return f"round(CAST({expr} AS DOUBLE), 6)"


ORACLE: dict[str, str] = {}

# ---------------------------------------------------------------- customer --
_RFM_BODY = """
SELECT customer_id,
       {rec} AS recency,
       CAST(count(DISTINCT transaction_id) AS BIGINT) AS frequency,
       {mon} AS monetary,
       round(CAST(sum(total_amount) AS DECIMAL(38,2)) / count(*), 6) AS avg_basket,
       {mx} AS max_basket,
       CAST(sum(quantity) AS BIGINT) AS total_qty,
       round(exp(-0.01 * {rec}), 6) AS recency_decay{extra}
FROM transactions GROUP BY customer_id"""

_REC = elapsed("(SELECT max(\"timestamp\") FROM transactions)", 'max("timestamp")')

ORACLE["rfm_features"] = with_views("transactions") + _RFM_BODY.format(
    rec=_REC, mon=r6("sum(total_amount)"), mx=r6("max(total_amount)"),
    extra=f",\n       CAST({_REC} > 90 AS BIGINT) AS churn")
ORACLE["rfm_from_lines"] = with_views("transactions") + _RFM_BODY.format(
    rec=_REC, mon=r6("sum(total_amount)"), mx=r6("max(total_amount)"), extra="")

ORACLE["rfm_lite"] = with_views("transactions", "customers", extra=f"""r AS (
  SELECT customer_id, {_REC} AS recency, count(*) AS frequency, sum(total_amount) AS monetary
  FROM transactions GROUP BY customer_id)""") + f"""
SELECT c.customer_id, CAST(c.age AS BIGINT) AS age, coalesce(r.recency, 0) AS recency,
       CAST(coalesce(r.frequency, 0) AS BIGINT) AS frequency, {r6('coalesce(r.monetary, 0)')} AS monetary
FROM customers c LEFT JOIN r ON c.customer_id = r.customer_id"""

ORACLE["promo_features"] = with_views("transactions") + f"""
SELECT customer_id, {r6('avg(discount_applied)')} AS avg_discount,
       {r6('max(discount_applied)')} AS max_discount,
       {r6('avg(CASE WHEN discount_applied > 0 THEN 1.0 ELSE 0.0 END)')} AS discount_txn_ratio
FROM transactions GROUP BY customer_id"""

_CAT = """per_cat AS (
  SELECT t.customer_id, p.category, count(*) AS n
  FROM transactions t LEFT JOIN products p ON t.sku_id = p.sku_id GROUP BY 1, 2),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY (category IS NULL), n DESC, category) AS rn,
         n * 1.0 / sum(CASE WHEN category IS NOT NULL THEN n END) OVER (PARTITION BY customer_id) AS p
  FROM per_cat),
cat AS (
  SELECT customer_id, CAST(count(category) AS BIGINT) AS distinct_categories,
         max(CASE WHEN rn = 1 THEN category END) AS favourite_category,
         coalesce(sum(CASE WHEN category IS NOT NULL THEN -p * log2(p + 1e-9) END), 0.0) AS category_entropy
  FROM ranked GROUP BY customer_id)"""

ORACLE["category_features"] = with_views("transactions", "products", extra=_CAT) + f"""
SELECT customer_id, distinct_categories, favourite_category, {r6('category_entropy')} AS category_entropy FROM cat"""

ORACLE["customer_features"] = with_views("transactions", "products", "customers", extra=_CAT + f""",
rfm AS (
  SELECT customer_id, {_REC} AS recency, count(DISTINCT transaction_id) AS frequency,
         sum(total_amount) AS monetary, sum(total_amount) / count(*) AS avg_basket,
         max(total_amount) AS max_basket, sum(quantity) AS total_qty
  FROM transactions GROUP BY customer_id),
promo AS (
  SELECT customer_id, avg(discount_applied) AS avg_discount, max(discount_applied) AS max_discount,
         avg(CASE WHEN discount_applied > 0 THEN 1.0 ELSE 0.0 END) AS discount_txn_ratio
  FROM transactions GROUP BY customer_id)""") + f"""
SELECT c.customer_id, CAST(c.age AS BIGINT) AS age, coalesce(c.gender, '') AS gender,
       coalesce(c.segment, '') AS segment, coalesce(c.region, '') AS region,
       CAST(coalesce(r.recency, 0) AS BIGINT) AS recency, CAST(coalesce(r.frequency, 0) AS BIGINT) AS frequency,
       {r6('coalesce(r.monetary, 0)')} AS monetary, {r6('coalesce(r.avg_basket, 0)')} AS avg_basket,
       {r6('coalesce(r.max_basket, 0)')} AS max_basket, CAST(coalesce(r.total_qty, 0) AS BIGINT) AS total_qty,
       {r6('coalesce(exp(-0.01 * r.recency), 0)')} AS recency_decay,
       coalesce(k.distinct_categories, 0) AS distinct_categories,
       coalesce(k.favourite_category, '') AS favourite_category,
       {r6('coalesce(k.category_entropy, 0)')} AS category_entropy,
       {r6('coalesce(p.avg_discount, 0)')} AS avg_discount, {r6('coalesce(p.max_discount, 0)')} AS max_discount,
       {r6('coalesce(p.discount_txn_ratio, 0)')} AS discount_txn_ratio,
       CAST(coalesce(r.recency, 0) > 90 AS BIGINT) AS churn
FROM customers c LEFT JOIN rfm r ON c.customer_id = r.customer_id
LEFT JOIN cat k ON c.customer_id = k.customer_id LEFT JOIN promo p ON c.customer_id = p.customer_id"""

ORACLE["last_sku"] = with_views("transactions") + """
SELECT customer_id, arg_max(sku_id, ("timestamp", transaction_id, sku_id)) AS last_sku
FROM transactions GROUP BY customer_id"""

ORACLE["serving_features"] = with_views("transactions", "customers", extra=f"""r AS (
  SELECT customer_id, {_REC} AS recency, count(*) AS frequency, round(sum(total_amount), 2) AS monetary,
         arg_max(sku_id, ("timestamp", transaction_id, sku_id)) AS last_sku
  FROM transactions GROUP BY customer_id)""") + f"""
SELECT c.customer_id, CAST(c.age AS BIGINT) AS age, coalesce(c.gender, '') AS gender,
       coalesce(c.segment, '') AS segment, coalesce(c.region, '') AS region,
       CAST(coalesce(r.recency, 0) AS BIGINT) AS recency, CAST(coalesce(r.frequency, 0) AS BIGINT) AS frequency,
       {r6('coalesce(r.monetary, 0)')} AS monetary, coalesce(r.last_sku, 0) AS last_sku,
       CAST(coalesce(r.recency, 0) > 90 AS DOUBLE) AS churn_risk,
       {r6('coalesce(round(r.monetary * r.frequency * CAST(0.001 AS DECIMAL(4,3)), 4), 0)')} AS clv_score,
       (SELECT max("timestamp") FROM transactions) AS event_timestamp,
       (SELECT max("timestamp") FROM transactions) AS created_timestamp
FROM customers c LEFT JOIN r ON c.customer_id = r.customer_id"""


# ------------------------------------------------------------- daily / sku --
def _win(n):
    return f"OVER (PARTITION BY sku_id ORDER BY date ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"


_CAL = """CAST(isodow(date) - 1 AS BIGINT) AS day_of_week, CAST(month(date) AS BIGINT) AS month,
       CAST(isodow(date) IN (6, 7) AS BIGINT) AS is_weekend, CAST(last_day(date) = date AS BIGINT) AS is_month_end,
       CAST(quarter(date) AS BIGINT) AS quarter,
       CAST((month(date) = 1 AND day(date) <= 7) OR (month(date) = 12 AND day(date) >= 25) AS BIGINT) AS is_holiday_proxy"""

ORACLE["sku_daily_features"] = with_views("transactions", extra="""daily AS (
  SELECT sku_id, CAST("timestamp" AS DATE) AS date, CAST(sum(quantity) AS BIGINT) AS daily_qty,
         sum(total_amount) AS daily_revenue, CAST(count(DISTINCT transaction_id) AS BIGINT) AS daily_txn_count
  FROM transactions GROUP BY 1, 2)""") + "SELECT sku_id, strftime(date, '%Y-%m-%d') AS date, daily_qty, " + \
    r6("daily_revenue") + " AS daily_revenue, daily_txn_count,\n" + ",\n".join(
        f"round(avg(daily_qty) {_win(n)}, 6) AS qty_roll_{n}d, "
        f"round(avg(CAST(daily_revenue AS DOUBLE)) {_win(n)}, 6) AS rev_roll_{n}d" for n in (7, 14, 28)) + ",\n" + \
    ",\n".join(f"CAST(coalesce(lag(daily_qty, {k}) OVER (PARTITION BY sku_id ORDER BY date), 0) AS BIGINT) AS qty_lag_{k}d"
               for k in (1, 7, 14)) + ",\n" + _CAL + "\nFROM daily"

ORACLE["daily_demand"] = with_views("transactions") + """
SELECT strftime(CAST("timestamp" AS DATE), '%Y-%m-%d') AS date, sku_id, CAST(sum(quantity) AS BIGINT) AS daily_demand
FROM transactions GROUP BY CAST("timestamp" AS DATE), sku_id"""

ORACLE["platform_daily"] = with_views("transactions") + """
SELECT strftime(CAST("timestamp" AS DATE), '%Y-%m-%d') AS ds, CAST(sum(quantity) AS BIGINT) AS y
FROM transactions GROUP BY CAST("timestamp" AS DATE)"""

_STATS = """daily AS (
  SELECT sku_id, CAST("timestamp" AS DATE) AS date, sum(quantity) AS q,
         min("timestamp") AS f, max("timestamp") AS l
  FROM transactions GROUP BY 1, 2),
stats AS (
  SELECT sku_id, """ + elapsed("max(l)", "min(f)") + """ + 1 AS date_range, CAST(sum(q) AS BIGINT) AS total_qty,
         sum(q) / greatest(""" + elapsed("max(l)", "min(f)") + """ + 1, 1) AS avg_daily_demand,
         stddev_samp(q) AS demand_std, max(l) AS last_sale
  FROM daily GROUP BY sku_id)"""

ORACLE["sku_demand_stats"] = with_views("transactions", extra=_STATS) + f"""
SELECT sku_id, date_range, total_qty, {r6('avg_daily_demand')} AS avg_daily_demand,
       {r6('demand_std')} AS demand_std, last_sale FROM stats"""

ORACLE["revenue_by_sku"] = with_views("transactions") + f"""
SELECT sku_id, {r6('sum(total_amount)')} AS revenue FROM transactions GROUP BY sku_id"""

ORACLE["revenue_by_category"] = with_views("transactions", "products") + f"""
SELECT p.category, {r6('sum(t.total_amount)')} AS revenue
FROM transactions t LEFT JOIN products p ON t.sku_id = p.sku_id GROUP BY p.category"""

_ABC = """rev AS (SELECT sku_id, sum(total_amount) AS revenue FROM transactions GROUP BY sku_id),
cum AS (
  SELECT sku_id, revenue,
         sum(revenue) OVER (ORDER BY revenue DESC, sku_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS c,
         sum(revenue) OVER () AS tot
  FROM rev),
abc AS (
  SELECT sku_id, revenue, CAST(c AS DOUBLE) / CAST(tot AS DOUBLE) AS cumulative_share,
         CASE WHEN c * 10 <= tot * 7 THEN 'A' WHEN c * 10 <= tot * 9 THEN 'B' ELSE 'C' END AS abc_class
  FROM cum)"""

ORACLE["abc_classes"] = with_views("transactions", extra=_ABC) + f"""
SELECT sku_id, {r6('revenue')} AS revenue, {r6('cumulative_share')} AS cumulative_share, abc_class FROM abc"""


def _report_sql(lead: str) -> str:
    return with_views("transactions", "products", "inventory", extra=_STATS + ",\n" + _ABC + f""",
base AS (
  SELECT p.sku_id, coalesce(i.current_stock, 0) AS stock,
         coalesce(CAST(p.cost_price AS DOUBLE), 10.0) AS cost,
         CASE WHEN s.total_qty IS NOT NULL THEN s.avg_daily_demand ELSE 5.0 END AS avg_d,
         coalesce(CASE WHEN s.total_qty IS NOT NULL THEN s.demand_std ELSE 2.0 END, 2.0) AS sd,
         {lead} AS lead, s.total_qty, s.last_sale, a.abc_class
  FROM products p LEFT JOIN inventory i ON p.sku_id = i.sku_id
  LEFT JOIN stats s ON p.sku_id = s.sku_id LEFT JOIN abc a ON p.sku_id = a.sku_id),
calc AS (
  SELECT *, 1.65 * sd * sqrt(lead) AS safety, avg_d * lead + 1.65 * sd * sqrt(lead) AS rop,
         CASE WHEN cost * 0.2 > 0 AND avg_d * 365 > 0 THEN sqrt(2 * avg_d * 365 * 50.0 / (cost * 0.2)) ELSE 100.0 END AS eoq
  FROM base)
SELECT sku_id, CAST(stock AS BIGINT) AS current_stock,
       CAST(round_even(eoq, 0) AS BIGINT) AS recommended_reorder_qty,
       CAST(round_even(safety, 0) AS BIGINT) AS safety_stock,
       {r6('rop')} AS reorder_point,
       {r6('round_even(greatest(0.0, least(1.0, 1.0 - stock / greatest(rop, 1.0))), 4)')} AS stockout_risk,
       {r6('round_even(stock / greatest(avg_d, 0.1), 1)')} AS days_of_supply,
       coalesce(abc_class, 'C') AS abc_class,
       CASE WHEN total_qty IS NOT NULL THEN {elapsed('(SELECT max("timestamp") FROM transactions)', 'last_sale')} > 90
            ELSE TRUE END AS dead_stock
FROM calc""")


ORACLE["inventory_report"] = "SELECT *, CASE WHEN stockout_risk < 0.3 THEN 'green' WHEN stockout_risk < 0.6 " \
    "THEN 'orange' ELSE 'red' END AS risk_band FROM (" + _report_sql("7.0") + ")"
ORACLE["inventory_report_own_lead"] = _report_sql("CAST(i.supplier_lead_time_days AS DOUBLE)")
ORACLE["inventory_kpis"] = f"""SELECT CAST(count(*) AS BIGINT) AS sku_count,
       CAST(count(*) FILTER (WHERE stockout_risk > 0.5) AS BIGINT) AS high_risk_count,
       CAST(count(*) FILTER (WHERE dead_stock) AS BIGINT) AS dead_stock_count,
       {r6('avg(days_of_supply)')} AS avg_days_of_supply FROM (""" + _report_sql("7.0") + ")"
ORACLE["abc_summary"] = """SELECT abc_class, CAST(count(*) AS BIGINT) AS sku_count, min(sku_id) AS first_sku,
       max(sku_id) AS last_sku FROM (""" + _report_sql("7.0") + ") GROUP BY abc_class"

_SPAN = elapsed('(SELECT max("timestamp") FROM transactions)', '(SELECT min("timestamp") FROM transactions)')
ORACLE["sales_velocity"] = with_views("transactions") + f"""
SELECT sku_id, {r6(f'sum(quantity) * 1.0 / {_SPAN}')} AS velocity FROM transactions GROUP BY sku_id"""

ORACLE["product_catalog"] = with_views("transactions", "products", "inventory", extra=f"""vel AS (
  SELECT sku_id, sum(quantity) * 1.0 / {_SPAN} AS velocity FROM transactions GROUP BY sku_id)""") + f"""
SELECT p.sku_id, p.category, {r6('p.base_price')} AS base_price, {r6('p.cost_price')} AS cost_price,
       CAST(i.current_stock AS BIGINT) AS current_stock, CAST(i.reorder_point AS BIGINT) AS reorder_point,
       CAST(i.supplier_lead_time_days AS BIGINT) AS supplier_lead_time_days,
       {r6('round((p.base_price - p.cost_price) / p.base_price * 100, 2)')} AS margin_pct,
       {r6('round_even(i.current_stock / v.velocity, 1)')} AS days_of_stock,
       {r6('CASE WHEN p.cost_price >= p.base_price THEN CAST(p.base_price * CAST(0.6 AS DECIMAL(2,1)) AS DECIMAL(12,2)) ELSE p.cost_price END')} AS capped_cost
FROM products p LEFT JOIN inventory i ON p.sku_id = i.sku_id LEFT JOIN vel v ON p.sku_id = v.sku_id"""


# ------------------------------------------------------------- exploration --
ORACLE["value_counts_category"] = with_views("products") + f"""
SELECT category, count(*) AS n, {r6('count(*) * 100.0 / (SELECT count(category) FROM products)')} AS pct
FROM products WHERE category IS NOT NULL GROUP BY category"""

_LITE = f"""lite AS (
  SELECT c.customer_id, c.age, coalesce(r.recency, 0) AS recency, coalesce(r.frequency, 0) AS frequency,
         coalesce(r.monetary, 0) AS monetary
  FROM customers c LEFT JOIN (
    SELECT customer_id, {_REC} AS recency, count(*) AS frequency, sum(total_amount) AS monetary
    FROM transactions GROUP BY customer_id) r ON c.customer_id = r.customer_id)"""

ORACLE["value_counts_churn"] = with_views("transactions", "customers", extra=_LITE) + f"""
SELECT CAST(recency > 90 AS BIGINT) AS churn, count(*) AS n, {r6('count(*) * 100.0 / (SELECT count(*) FROM lite)')} AS pct
FROM lite GROUP BY 1"""


def _describe(col: str) -> str:
    x = f"CAST({col} AS DOUBLE)"
    return (f"SELECT '{col}' AS \"column\", count({x}) AS count, "
            f"CAST((CAST(sum(CAST({col} AS DECIMAL(20,4))) * 10000 AS HUGEINT) * 200 + count({col})) // (2 * count({col})) AS DOUBLE) / 1000000 AS mean, "
            f"{r6(f'stddev_samp({x})')} AS std, {r6(f'min({x})')} AS min, "
            f"{r6(f'quantile_cont({x}, 0.25)')} AS p25, {r6(f'quantile_cont({x}, 0.5)')} AS p50, "
            f"{r6(f'quantile_cont({x}, 0.75)')} AS p75, {r6(f'max({x})')} AS max")


ORACLE["describe_transactions"] = with_views("transactions") + "\nUNION ALL ".join(
    _describe(c) + " FROM transactions" for c in ("quantity", "discount_applied", "total_amount"))
ORACLE["describe_customers"] = with_views("customers") + _describe("age") + " FROM customers"


def _hist(view: str, col: str, bins: int) -> str:
    x = f"CAST({col} AS DOUBLE)"
    return f"""b AS (SELECT min({x}) AS lo, max({x}) AS hi, (max({x}) - min({x})) / {bins}.0 AS w FROM {view}),
h AS (SELECT CAST(CASE WHEN b.w = 0 THEN 0 ELSE least(floor(({x} - b.lo) / b.w), {bins - 1}) END AS INTEGER) AS bin
      FROM {view}, b WHERE {col} IS NOT NULL)
SELECT CAST(bin AS BIGINT) AS bin, {r6('min(b.lo) + bin * min(b.w)')} AS lower,
       {r6('min(b.lo) + (bin + 1) * min(b.w)')} AS upper, count(*) AS n
FROM h, b GROUP BY bin"""


ORACLE["histogram_age"] = with_views("customers") + ",\n" + _hist("customers", "age", 30)
ORACLE["histogram_amount"] = with_views("transactions") + ",\n" + _hist("transactions", "total_amount", 50)

_CORR_COLS = ("age", "recency", "frequency", "monetary")
ORACLE["correlation_rfm"] = with_views("transactions", "customers", extra=_LITE) + "\nUNION ALL ".join(
    f"SELECT '{a}' AS a, '{b}' AS b, {r6(f'corr(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE))')} AS corr FROM lite"
    for a in _CORR_COLS for b in _CORR_COLS)

ORACLE["weekday_quantity"] = with_views("transactions") + f"""
SELECT CAST(isodow("timestamp") - 1 AS BIGINT) AS day_index, {r6('avg(quantity)')} AS avg_quantity,
       ['Monday','Tuesday','Wednesday','Thursday','Friday','Saturday','Sunday'][isodow("timestamp")] AS day_name
FROM transactions GROUP BY 1, 3"""

ORACLE["distinct_categories"] = with_views("products") + "SELECT DISTINCT category FROM products"

ORACLE["top_skus_by_revenue"] = with_views("transactions") + f"""
SELECT sku_id, {r6('sum(total_amount)')} AS revenue FROM transactions GROUP BY sku_id
ORDER BY sum(total_amount) DESC, sku_id LIMIT 20"""

ORACLE["customer_head"] = with_views("transactions", "customers", extra=_LITE) + f"""
SELECT customer_id, CAST(age AS BIGINT) AS age, CAST(recency AS BIGINT) AS recency,
       CAST(frequency AS BIGINT) AS frequency, {r6('monetary')} AS monetary
FROM lite ORDER BY customer_id LIMIT 50"""

ORACLE["customer_sample"] = with_views("customers") + """
SELECT customer_id, CAST(age AS BIGINT) AS age, gender, segment, region FROM customers
WHERE (customer_id * 7919 + 42 * 104729) % 10000 < 5000"""

ORACLE["latest_days"] = with_views("transactions") + """
SELECT strftime(CAST("timestamp" AS DATE), '%Y-%m-%d') AS ds, CAST(sum(quantity) AS BIGINT) AS y
FROM transactions GROUP BY CAST("timestamp" AS DATE) ORDER BY CAST("timestamp" AS DATE) DESC LIMIT 30"""

ORACLE["latest_baskets_per_customer"] = with_views("transactions", extra="""b AS (
  SELECT customer_id, transaction_id, max("timestamp") AS "timestamp", sum(total_amount) AS amount_sum
  FROM transactions GROUP BY customer_id, transaction_id)""") + f"""
SELECT customer_id, transaction_id, "timestamp", {r6('amount_sum')} AS amount_sum, rank FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY customer_id ORDER BY "timestamp" DESC, transaction_id DESC) AS BIGINT) AS rank
  FROM b) WHERE rank <= 5"""

ORACLE["daily_sales_ma7"] = with_views("transactions", extra="""d AS (
  SELECT CAST("timestamp" AS DATE) AS ds, CAST(sum(quantity) AS BIGINT) AS y FROM transactions GROUP BY 1)""") + f"""
SELECT strftime(ds, '%Y-%m-%d') AS ds, y,
       CASE WHEN count(y) OVER w = 7 THEN {r6('avg(y) OVER w')} END AS ma_7
FROM d WINDOW w AS (ORDER BY ds ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)"""

ORACLE["pareto_share"] = with_views("transactions", extra="""r AS (
  SELECT sku_id, sum(total_amount) AS revenue,
         row_number() OVER (ORDER BY sum(total_amount) DESC, sku_id) AS rk FROM transactions GROUP BY sku_id),
n AS (SELECT count(*) AS n FROM r)""") + f"""
SELECT CAST(ceil(n.n * 0.2) AS BIGINT) AS top_skus, n.n AS sku_count,
       {r6('sum(CASE WHEN rk <= ceil(n.n * 0.2) THEN revenue END) / sum(revenue)')} AS top_revenue_share
FROM r, n GROUP BY n.n"""


# ------------------------------------------------------------ data quality --
def _dq_rows() -> str:
    suites = {
        "customers": [("exists", "customer_id"), ("exists", "age"), ("exists", "region"),
                      ("between", "age", 18, 100), ("not_null", "customer_id"), ("unique", "customer_id")],
        "products": [("exists", "sku_id"), ("exists", "category"), ("exists", "cost_price"),
                     ("exists", "base_price"), ("not_null", "sku_id"), ("unique", "sku_id")],
        "transactions": [("exists", "transaction_id"), ("exists", "customer_id"), ("exists", "sku_id"),
                         ("exists", "quantity"), ("exists", "total_amount"), ("not_null", "transaction_id"),
                         ("unique", "transaction_id"), ("between", "quantity", 1, 100)],
        "inventory": [("exists", "sku_id"), ("exists", "current_stock"), ("not_null", "sku_id"),
                      ("between", "current_stock", 0, 10000)],
    }
    rows = []
    for t, exps in suites.items():
        for e in exps:
            kind, c = e[0], e[1]
            if kind == "exists":
                rows.append(f"SELECT '{t}' AS \"table\", 'exists' AS expectation, '{c}' AS \"column\", "
                            f"CAST(NULL AS BIGINT) AS failed_rows, TRUE AS success")
                continue
            if kind == "between":
                f = f"(SELECT count(*) FROM {t} WHERE {c} < {e[2]} OR {c} > {e[3]})"
            elif kind == "not_null":
                f = f"(SELECT count(*) FROM {t} WHERE {c} IS NULL)"
            else:
                f = (f"(SELECT coalesce(sum(n), 0) FROM (SELECT count(*) AS n FROM {t} WHERE {c} IS NOT NULL "
                     f"GROUP BY {c} HAVING count(*) > 1))")
            rows.append(f"SELECT '{t}', '{kind}', '{c}', CAST({f} AS BIGINT), {f} = 0")
    return "\nUNION ALL ".join(rows)


_DQ = with_views("transactions", "products", "customers", "inventory") + _dq_rows()
ORACLE["dq_results"] = _DQ
ORACLE["dq_table_summary"] = f"""SELECT "table", count(*) AS evaluated, count(*) FILTER (WHERE success) AS successful,
       count(*) = count(*) FILTER (WHERE success) AS passed FROM ({_DQ}) GROUP BY "table" """
ORACLE["dq_gate"] = f"""SELECT count(*) AS total, count(*) FILTER (WHERE success) AS passed,
       {r6('count(*) FILTER (WHERE success) * 100.0 / count(*)')} AS dq_score, bool_and(success) AS gate_passed
FROM ({_DQ})"""


# ------------------------------------------------------------------- drift --
def _num_drift(col: str, tag: str, ks: bool = False) -> tuple[str, str]:
    x = f"CAST({col} AS DOUBLE)"
    ctes = f"""cnt_{tag} AS (
  SELECT v, sum(r) AS cr, sum(c) AS cc FROM (
    SELECT {x} AS v, 1 AS r, 0 AS c FROM ref UNION ALL SELECT {x}, 0, 1 FROM cur) WHERE v IS NOT NULL GROUP BY v),
s_{tag} AS (SELECT (SELECT count({col}) FROM ref) AS nr, (SELECT count({col}) FROM cur) AS nc,
                   greatest((SELECT stddev_pop({x}) FROM ref), 0.001) AS sd),
e_{tag} AS (
  SELECT v, sum(cr) OVER w AS cum_r, sum(cc) OVER w AS cum_c, lead(v) OVER (ORDER BY v) AS vn
  FROM cnt_{tag} WINDOW w AS (ORDER BY v ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
st_{tag} AS (
  SELECT coalesce(sum(abs(cum_r / s.nr - cum_c / s.nc) * (vn - v)), 0) AS w1,
         max(abs(cum_r / s.nr - cum_c / s.nc)) AS d, any_value(s.nr) AS nr, any_value(s.nc) AS nc,
         any_value(s.sd) AS sd
  FROM e_{tag}, s_{tag} s),
sc_{tag} AS (
  SELECT *, {_KS_SQL if ks else "w1 / sd"} AS score
  FROM st_{tag})"""
    sel = f"""SELECT '{col}' AS "column", '{"ks" if ks else "wasserstein"}' AS stat_test,
       round(score, 6) AS score, CAST({"0.05" if ks else "0.1"} AS DOUBLE) AS threshold,
       {"score < 0.05" if ks else "score >= 0.1"} AS detected,
       CAST(nr AS BIGINT) AS n_ref, CAST(nc AS BIGINT) AS n_cur FROM sc_{tag}"""
    return ctes, sel


_KS_SQL = """CASE WHEN sqrt(nr * nc / (nr + nc)) * d < 0.2 THEN 1.0 ELSE greatest(0.0, least(1.0, 2 * (
      SELECT sum(pow(-1.0, k - 1) * exp(-2.0 * k * k * pow(sqrt(nr * nc / (nr + nc)) * d, 2)))
      FROM range(1, 101) t(k)))) END"""


def _cat_drift(col: str, tag: str) -> tuple[str, str]:
    ctes = f"""j_{tag} AS (
  SELECT sum(r) * 1.0 / (SELECT count({col}) FROM ref) AS p, sum(c) * 1.0 / (SELECT count({col}) FROM cur) AS q
  FROM (SELECT {col} AS v, 1 AS r, 0 AS c FROM ref UNION ALL SELECT {col}, 0, 1 FROM cur)
  WHERE v IS NOT NULL GROUP BY v)"""
    sel = f"""SELECT '{col}' AS "column", 'jensenshannon' AS stat_test,
       round(sqrt(greatest(0.0, sum(CASE WHEN p > 0 THEN p * ln(p / ((p + q) / 2)) ELSE 0 END
                             + CASE WHEN q > 0 THEN q * ln(q / ((p + q) / 2)) ELSE 0 END) / 2)), 6) AS score,
       CAST(0.1 AS DOUBLE) AS threshold,
       sqrt(greatest(0.0, sum(CASE WHEN p > 0 THEN p * ln(p / ((p + q) / 2)) ELSE 0 END
                             + CASE WHEN q > 0 THEN q * ln(q / ((p + q) / 2)) ELSE 0 END) / 2)) >= 0.1 AS detected,
       (SELECT count({col}) FROM ref) AS n_ref, (SELECT count({col}) FROM cur) AS n_cur FROM j_{tag}"""
    return ctes, sel


def _drift_sql(frames: str, numeric, categorical, ks: bool = False) -> str:
    ctes, sels = [frames], []
    for i, c in enumerate(numeric):
        a, b = _num_drift(c, f"n{i}", ks)
        ctes.append(a)
        sels.append(b)
    for i, c in enumerate(categorical):
        a, b = _cat_drift(c, f"c{i}")
        ctes.append(a)
        sels.append(b)
    return ",\n".join(ctes) + "\n" + "\nUNION ALL ".join(sels)


_TEMPORAL = with_views("transactions", "products", extra="""tp AS (
  SELECT t.*, p.category FROM transactions t LEFT JOIN products p ON t.sku_id = p.sku_id),
ref AS (SELECT * FROM tp WHERE "timestamp" < TIMESTAMP '1998-05-01'),
cur AS (SELECT * FROM tp WHERE "timestamp" >= TIMESTAMP '1998-05-01')""").rstrip()
_SHIFTED = with_views("transactions", "products", extra="""tp AS (
  SELECT t.*, p.category FROM transactions t LEFT JOIN products p ON t.sku_id = p.sku_id),
ref AS (SELECT * FROM tp),
cur AS (SELECT * REPLACE (quantity + 2 AS quantity, total_amount * 1.5 AS total_amount) FROM ref)""").rstrip()
_EVENTS = """WITH e AS (SELECT value AS latency_ms, event_type, ts FROM events),
ref AS (SELECT * FROM e WHERE ts < TIMESTAMP '2024-01-16'),
cur AS (SELECT * FROM e WHERE ts >= TIMESTAMP '2024-01-16')"""

_NUMS = ("quantity", "discount_applied", "total_amount")
ORACLE["drift_report_temporal"] = _drift_sql(_TEMPORAL, _NUMS, ["category"])
ORACLE["drift_report_shifted"] = _drift_sql(_SHIFTED, _NUMS, ["category"])
ORACLE["drift_report_events"] = _drift_sql(_EVENTS, ["latency_ms"], ["event_type"])
ORACLE["drift_report_events_ks"] = _drift_sql(_EVENTS, ["latency_ms"], ["event_type"], ks=True)
ORACLE["drift_summary_temporal"] = f"""SELECT count(*) AS total, count(*) FILTER (WHERE detected) AS drifted,
  {r6('count(*) FILTER (WHERE detected) * 1.0 / count(*)')} AS drift_share,
  count(*) FILTER (WHERE detected) * 1.0 / count(*) > 0.2 AS dataset_drift,
  CASE WHEN count(*) FILTER (WHERE detected) * 1.0 / count(*) > 0.2 THEN 'DRIFT_DETECTED' ELSE 'OK' END AS status,
  CASE WHEN count(*) FILTER (WHERE detected) * 1.0 / count(*) > 0.4 THEN 'critical'
       WHEN count(*) FILTER (WHERE detected) * 1.0 / count(*) > 0.2 THEN 'warning' ELSE 'ok' END AS severity,
  count(*) FILTER (WHERE detected) * 1.0 / count(*) > 0.2 AS retrain_triggered,
  count(*) FILTER (WHERE detected) * 1.0 / count(*) > 0.1 AS confirmed
FROM ({ORACLE['drift_report_temporal']})"""
ORACLE["psi_total_amount"] = _TEMPORAL + """,
b AS (SELECT list_sort(quantile_cont(CAST(total_amount AS DOUBLE), [0.1,0.2,0.3,0.4,0.5,0.6,0.7,0.8,0.9])) AS bounds FROM ref),
rs AS (SELECT len(list_filter(b.bounds, lambda x: x < CAST(total_amount AS DOUBLE))) AS bin, count(*) * 1.0 / (SELECT count(total_amount) FROM ref) AS r
       FROM ref, b GROUP BY 1),
cs AS (SELECT len(list_filter(b.bounds, lambda x: x < CAST(total_amount AS DOUBLE))) AS bin, count(*) * 1.0 / (SELECT count(total_amount) FROM cur) AS c
       FROM cur, b GROUP BY 1)
SELECT 'total_amount' AS "column", round(sum((greatest(coalesce(c, 0), 1e-4) - greatest(coalesce(r, 0), 1e-4))
       * ln(greatest(coalesce(c, 0), 1e-4) / greatest(coalesce(r, 0), 1e-4))), 6) AS psi
FROM rs FULL OUTER JOIN cs USING (bin)"""


# ----------------------------------------------------------------- pricing --
_LINES = """lines AS (
  SELECT t.transaction_id, t.sku_id, p.category, t."timestamp", t.quantity,
         CAST(t.discount_applied AS DOUBLE) AS discount,
         CAST(t.total_amount / nullif(t.quantity, 0) AS DOUBLE) AS unit_price,
         ln(CAST(t.total_amount / nullif(t.quantity, 0) AS DOUBLE) + 1e-5) AS log_price,
         ln(greatest(CAST(t.quantity AS DOUBLE), 0.1) + 1e-5) AS log_demand
  FROM transactions t JOIN products p ON t.sku_id = p.sku_id)"""


def _dml(src: str, keys: list[str], y: str, t: str, w: str, fold: str, tag: str, k: int = 2) -> str:
    kl = ", ".join(keys)
    on = " AND ".join(f"a.{c} = b.{c}" for c in keys)

    def slope(n, sw, sv, sww, swv):
        return (f"CASE WHEN ({n}) * ({sww}) - ({sw}) * ({sw}) <> 0 THEN "
                f"(({n}) * ({swv}) - ({sw}) * ({sv})) / (({n}) * ({sww}) - ({sw}) * ({sw})) ELSE 0.0 END")
    o = {s: f"(b.T{s} - a.{s})" for s in ("n", "sw", "sy", "st", "sww", "swy", "swt")}
    by = slope(o["n"], o["sw"], o["sy"], o["sww"], o["swy"])
    bt = slope(o["n"], o["sw"], o["st"], o["sww"], o["swt"])
    return f"""b_{tag} AS (SELECT {kl}, {y} AS y, {t} AS t, {w} AS w, (({fold}) % {k} + {k}) % {k} AS f FROM {src}),
pf_{tag} AS (SELECT {kl}, f, CAST(count(*) AS DOUBLE) AS n, sum(w) AS sw, sum(y) AS sy, sum(t) AS st,
                    sum(w * w) AS sww, sum(w * y) AS swy, sum(w * t) AS swt FROM b_{tag} GROUP BY {kl}, f),
tt_{tag} AS (SELECT {kl}, sum(n) AS Tn, sum(sw) AS Tsw, sum(sy) AS Tsy, sum(st) AS Tst, sum(sww) AS Tsww,
                    sum(swy) AS Tswy, sum(swt) AS Tswt FROM pf_{tag} GROUP BY {kl}),
co_{tag} AS (SELECT {", ".join("a." + c for c in keys)}, a.f, {by} AS by_, ({o['sy']} - ({by}) * {o['sw']}) / {o['n']} AS ay,
                    {bt} AS bt, ({o['st']} - ({bt}) * {o['sw']}) / {o['n']} AS at_
             FROM pf_{tag} a JOIN tt_{tag} b ON {on}),
dml_{tag} AS (SELECT {", ".join("x." + c for c in keys)},
                     sum((x.y - (c.ay + c.by_ * x.w)) * (x.t - (c.at_ + c.bt * x.w)))
                       / nullif(sum((x.t - (c.at_ + c.bt * x.w)) * (x.t - (c.at_ + c.bt * x.w))), 0) AS theta,
                     count(*) AS n
              FROM b_{tag} x JOIN co_{tag} c ON {" AND ".join(f"x.{c} = c.{c}" for c in keys)} AND x.f = c.f
              GROUP BY {", ".join("x." + c for c in keys)})"""


_OLS = """ols AS (
  SELECT category, count(*) AS n, CASE WHEN count(*) >= 30 THEN regr_slope(log_demand, log_price) END AS ols,
         CASE WHEN count(*) >= 30 THEN regr_intercept(log_demand, log_price) END AS intercept,
         CASE WHEN count(*) >= 30 THEN regr_r2(log_demand, log_price) END AS r_squared,
         avg(unit_price) AS avg_price, avg(quantity) AS avg_demand
  FROM lines GROUP BY category)"""

_REPORT = with_views("transactions", "products", extra=_LINES + ",\n" + _OLS + ",\n" + _dml(
    "lines", ["category"], "log_demand", "log_price", "discount", "transaction_id * 7 + sku_id * 13", "e")) + """,
report AS (
  SELECT o.category, o.n, o.ols, d.theta AS linear_dml, CAST(NULL AS DOUBLE) AS nonlinear_dml,
         coalesce(d.theta, o.ols) AS elasticity, o.r_squared, o.avg_price, o.avg_demand,
         CASE WHEN abs(coalesce(d.theta, o.ols)) > 1 THEN 'elastic' WHEN coalesce(d.theta, o.ols) IS NOT NULL THEN 'inelastic' END AS label
  FROM ols o LEFT JOIN dml_e d ON o.category = d.category AND o.n >= 30)
"""

ORACLE["elasticity_ols"] = with_views("transactions", "products", extra=_LINES + ",\n" + _OLS) + f"""
SELECT category, n, {r6('ols')} AS ols, {r6('intercept')} AS intercept, {r6('r_squared')} AS r_squared,
       {r6('avg_price')} AS avg_price, {r6('avg_demand')} AS avg_demand FROM ols"""

ORACLE["price_elasticity"] = _REPORT + f"""
SELECT category, n, {r6('ols')} AS ols, {r6('linear_dml')} AS linear_dml, nonlinear_dml, {r6('elasticity')} AS elasticity,
       {r6('r_squared')} AS r_squared, {r6('avg_price')} AS avg_price, {r6('avg_demand')} AS avg_demand, label
FROM report"""
# residuals row by row: both regressions of every fold solved by Cramer's rule on centred sums of the other folds
ORACLE["price_elasticity_two_controls"] = with_views("transactions", "products", extra=_LINES) + f""",
r AS (SELECT category, log_demand AS y, log_price AS t, discount AS a, CAST(month("timestamp") AS DOUBLE) AS b, (transaction_id * 7 + sku_id * 13) % 2 AS f FROM lines),
o AS (SELECT r.category, g.f, avg(y) AS my, avg(t) AS mt, avg(a) AS ma, avg(b) AS mb, covar_pop(a, a) AS aa, covar_pop(b, b) AS bb, covar_pop(a, b) AS ab,
             covar_pop(a, y) AS ay, covar_pop(b, y) AS yb, covar_pop(a, t) AS at_, covar_pop(b, t) AS bt FROM r, range(2) g(f) WHERE r.f <> g.f GROUP BY r.category, g.f),
c AS (SELECT *, (ay * bb - yb * ab) / (aa * bb - ab * ab) AS y1, (yb * aa - ay * ab) / (aa * bb - ab * ab) AS y2,
             (at_ * bb - bt * ab) / (aa * bb - ab * ab) AS t1, (bt * aa - at_ * ab) / (aa * bb - ab * ab) AS t2 FROM o),
e AS (SELECT r.category, y - my - y1 * (a - ma) - y2 * (b - mb) AS ry, t - mt - t1 * (a - ma) - t2 * (b - mb) AS rt FROM r JOIN c ON r.category = c.category AND r.f = c.f)
SELECT category, count(*) AS n, {r6('sum(ry * rt) / sum(rt * rt)')} AS elasticity FROM e GROUP BY category"""

ORACLE["price_elasticity_focal"] = ORACLE["price_elasticity"] + " WHERE category = (SELECT min(category) FROM products)"

ORACLE["elasticity_kpis"] = _REPORT + f"""
SELECT {r6('avg(elasticity)')} AS mean_elasticity, count(*) FILTER (WHERE label = 'elastic') AS elastic_count,
       {r6('avg(r_squared)')} AS mean_r_squared FROM report"""

_CP = """cp AS (SELECT category, "timestamp" AS period, sum(quantity) AS qty,
       CAST((CAST(sum(CAST(unit_price AS DECIMAL(24,10))) * 10000000000 AS HUGEINT) * 2 + count(unit_price) * 10000)
            // (count(unit_price) * 20000) AS DOUBLE) / 1000000 AS price
           FROM lines GROUP BY category, "timestamp")"""

ORACLE["category_periods"] = with_views("transactions", "products", extra=_LINES + ",\n" + _CP) + f"""
SELECT category, period, CAST(qty AS BIGINT) AS qty, {r6('price')} AS price FROM cp"""

ORACLE["cross_elasticity"] = with_views("transactions", "products", extra=_LINES + ",\n" + _CP + """,
pairs AS (
  SELECT f.category AS focal, c.category AS competitor, f.period,
         ln(f.qty + 1e-5) AS log_q, ln(f.price + 1e-5) AS log_fp, ln(c.price + 1e-5) AS log_cp
  FROM cp f JOIN cp c ON f.period = c.period AND f.category <> c.category),
""" + _dml("pairs", ["focal", "competitor"], "log_q", "log_cp", "log_fp",
           "(CAST(period AS DATE) - DATE '1970-01-01')", "x")) + f"""
SELECT focal, competitor, n AS n_periods, {r6('CASE WHEN n >= 20 THEN coalesce(theta, 0.0) END')} AS elasticity,
       CASE WHEN n < 20 THEN NULL WHEN coalesce(theta, 0.0) > 0 THEN 'Substitute'
            WHEN coalesce(theta, 0.0) < 0 THEN 'Complement' ELSE 'Independent' END AS label
FROM dml_x"""


def _sim_sql(scenarios: list[tuple[int, bool]], select: str) -> str:
    vals = ", ".join(f"({p}, {str(b).upper()})" for p, b in scenarios)
    return _REPORT + f""", sc AS (SELECT * FROM (VALUES {vals}) v(pct, promo)),
dem AS (SELECT sku_id, CAST(sum(quantity) AS DOUBLE) AS d FROM transactions GROUP BY sku_id),
base AS (
  SELECT p.sku_id, p.base_price AS pdec, CAST(p.base_price AS DOUBLE) AS p, coalesce(dem.d, 100.0) AS d,
         coalesce(r.elasticity, -0.5) AS e, sc.pct, sc.promo,
         1.0 + sc.pct / 100.0 AS ratio, CASE WHEN sc.promo THEN 1.25 ELSE 1.0 END AS lift
  FROM products p LEFT JOIN dem ON p.sku_id = dem.sku_id LEFT JOIN report r ON p.category = r.category, sc),
calc AS (SELECT *, d * pow(ratio, e) * lift AS pd, d * p AS cr, d * pow(ratio, e) * lift * p * ratio AS pr FROM base),
sim AS (
  SELECT sku_id, CAST(pct AS BIGINT) AS price_change_pct, promo AS promotion_flag, CAST(pdec AS DOUBLE) AS current_price,
         CAST(round(pdec * (100 + pct) / 100, 2) AS DOUBLE) AS new_price,
         round_even(d, 0) AS current_demand, round_even(pd, 0) AS projected_demand,
         round_even((pd / d - 1) * 100, 2) AS demand_change_pct, round_even(cr, 2) AS current_revenue,
         round_even(pr, 2) AS projected_revenue, round_even((pr / cr - 1) * 100, 2) AS revenue_change_pct,
         CAST(round_even((lift - 1) * 100, 1) AS DOUBLE) AS promotion_lift
  FROM calc)
{select}"""


_SCEN = [(p, b) for p in (-10, 10) for b in (False, True)]
ORACLE["revenue_simulation"] = _sim_sql(_SCEN, "SELECT * FROM sim")
ORACLE["price_sensitivity"] = _sim_sql([(p, False) for p in range(-30, 31, 5)],
                                       "SELECT sku_id, price_change_pct, projected_revenue, projected_demand FROM sim")
ORACLE["revenue_waterfall"] = _sim_sql(_SCEN, f"""SELECT sku_id, price_change_pct, promotion_flag, current_revenue,
       {r6('projected_revenue / (1 + promotion_lift / 100) - current_revenue')} AS price_effect,
       {r6('projected_revenue - current_revenue - (projected_revenue / (1 + promotion_lift / 100) - current_revenue)')} AS promo_effect,
       projected_revenue FROM sim""")


# --------------------------------------------------------------- streaming --
_EV = "ev AS (SELECT event_id, ts, user_id, event_type, value AS latency_ms, event_type = 'error' AS is_error FROM events)"
_SLIDE = """slid AS (
  SELECT e.*, to_timestamp((floor(epoch(ts) / 30) * 30 - k * 30)::DOUBLE)::TIMESTAMP AS window_start
  FROM ev e, range(0, 10) t(k))"""

_RATES = """seen AS (SELECT event_type, window_start, count(*) AS n FROM slid GROUP BY event_type, window_start),
spine AS (
  SELECT f.event_type, f.first_ws + to_seconds(30 * k) AS window_start
  FROM (SELECT event_type, min(window_start) AS first_ws FROM seen GROUP BY event_type) f,
       range(0, (SELECT CAST(date_diff('second', min(window_start), max(window_start)) / 30 AS BIGINT) + 1 FROM seen)) t(k)
  WHERE f.first_ws + to_seconds(30 * k) <= (SELECT max(window_start) FROM seen)),
rates AS (
  SELECT s.event_type, s.window_start, coalesce(x.n, 0) AS n
  FROM spine s LEFT JOIN seen x ON s.event_type = x.event_type AND s.window_start = x.window_start)"""
ORACLE["request_rate"] = f"WITH {_EV},\n{_SLIDE},\n{_RATES}\n" + f"""
SELECT event_type, window_start, window_start + INTERVAL 5 MINUTE AS window_end, n, {r6('n / 300.0')} AS rate
FROM rates"""

ORACLE["latency_percentiles"] = f"WITH {_EV}\n" + f"""
SELECT event_type, to_timestamp((floor(epoch(ts) / 300) * 300)::DOUBLE)::TIMESTAMP AS window_start, count(*) AS n,
       {r6('quantile_cont(latency_ms, 0.5)')} AS p50, {r6('quantile_cont(latency_ms, 0.95)')} AS p95,
       {r6('quantile_cont(latency_ms, 0.99)')} AS p99,
       quantile_cont(latency_ms, 0.95) > 500 AS p95_breach, quantile_cont(latency_ms, 0.99) > 1000 AS p99_breach
FROM ev GROUP BY 1, 2"""

# windows of up to 1,024 values: the sketches are exact there
ORACLE["latency_sliding"] = f"WITH {_EV},\n{_SLIDE}\n" + """
SELECT event_type, window_start, count(*) AS n, quantile_disc(latency_ms, 0.5) AS p50, quantile_disc(latency_ms, 0.95) AS p95,
       quantile_disc(latency_ms, 0.99) AS p99, quantile_disc(latency_ms, 0.95) > 500 AS p95_breach, quantile_disc(latency_ms, 0.99) > 1000 AS p99_breach
FROM slid GROUP BY event_type, window_start"""

_ERR = f"""err AS (
  SELECT window_start, count(*) FILTER (WHERE is_error) AS errors, count(*) AS n FROM slid GROUP BY window_start)"""
ORACLE["error_ratio"] = f"WITH {_EV},\n{_SLIDE},\n{_ERR}\n" + f"""
SELECT window_start, errors, n, {r6('errors * 1.0 / n')} AS error_ratio, {r6('errors * 100.0 / n')} AS error_pct,
       errors * 1.0 / n > 0.01 AS breach FROM err"""

ORACLE["throughput_drop"] = f"WITH {_EV},\n{_SLIDE},\n{_RATES}\n" + f"""
SELECT event_type, window_start, {r6('n / 300.0')} AS rate,
       CAST((CAST(sum(n) OVER w AS BIGINT) * 2000000 + count(*) OVER w * 300) // (count(*) OVER w * 600) AS DOUBLE) / 1000000 AS hour_avg_rate,
       n * count(*) OVER w * 2 < sum(n) OVER w AS "drop"
FROM rates WINDOW w AS (PARTITION BY event_type ORDER BY epoch(window_start) RANGE BETWEEN 3600 PRECEDING AND CURRENT ROW)"""

ORACLE["sustained_error_breach"] = f"WITH {_EV},\n{_SLIDE},\n{_ERR}\n" + f"""
SELECT window_start, errors, n, {r6('errors * 1.0 / n')} AS error_ratio, {r6('errors * 100.0 / n')} AS error_pct,
       errors * 1.0 / n > 0.01 AS breach,
       count(*) FILTER (WHERE errors * 1.0 / n > 0.01) OVER (ORDER BY epoch(window_start)
           RANGE BETWEEN 300 PRECEDING AND CURRENT ROW) = 11 AS breach_sustained
FROM err"""

ORACLE["latency_histogram"] = f"WITH {_EV}\n" + """, b AS (
  SELECT event_type, CASE WHEN latency_ms / 1000.0 <= 0.01 THEN 0.01 WHEN latency_ms / 1000.0 <= 0.025 THEN 0.025
    WHEN latency_ms / 1000.0 <= 0.05 THEN 0.05 WHEN latency_ms / 1000.0 <= 0.1 THEN 0.1
    WHEN latency_ms / 1000.0 <= 0.25 THEN 0.25 WHEN latency_ms / 1000.0 <= 0.5 THEN 0.5
    WHEN latency_ms / 1000.0 <= 1.0 THEN 1.0 WHEN latency_ms / 1000.0 <= 2.5 THEN 2.5
    WHEN latency_ms / 1000.0 <= 5.0 THEN 5.0 ELSE 'inf'::DOUBLE END AS le, count(*) AS n
  FROM ev GROUP BY 1, 2)
SELECT event_type, le, n, CAST(sum(n) OVER (PARTITION BY event_type ORDER BY le ROWS UNBOUNDED PRECEDING) AS BIGINT) AS cumulative FROM b"""

ORACLE["incremental_orders"] = """SELECT year(o_orderdate) AS year, count(*) AS n FROM orders
WHERE o_orderdate > TIMESTAMP '1998-05-01 00:00:00' GROUP BY 1"""


# ----------------------------------------------------------- feature views --
_TXF = """tf AS (
  SELECT customer_id, arg_max(sku_id, ("timestamp", "timestamp", transaction_id, sku_id, quantity, discount_applied, total_amount)) AS sku_id,
         arg_max(quantity, ("timestamp", "timestamp", transaction_id, sku_id, quantity, discount_applied, total_amount)) AS quantity,
         arg_max(discount_applied, ("timestamp", "timestamp", transaction_id, sku_id, quantity, discount_applied, total_amount)) AS discount_applied,
         arg_max(total_amount, ("timestamp", "timestamp", transaction_id, sku_id, quantity, discount_applied, total_amount)) AS total_amount,
         max("timestamp") AS event_timestamp
  FROM transactions
  WHERE "timestamp" >= (SELECT max("timestamp") FROM transactions) - INTERVAL 365 DAY
  GROUP BY customer_id)"""

ORACLE["rfm_online_lookup"] = with_views("transactions", "customers", extra=_TXF) + f"""
SELECT c.customer_id, tf.sku_id, CAST(tf.quantity AS BIGINT) AS quantity,
       {r6('tf.discount_applied')} AS discount_applied, {r6('tf.total_amount')} AS total_amount, tf.event_timestamp
FROM customers c LEFT JOIN tf ON c.customer_id = tf.customer_id"""

ORACLE["customer_online_lookup"] = with_views("transactions", "customers", extra="""f AS (
  SELECT customer_id, min("timestamp") AS first_ts FROM transactions GROUP BY customer_id)""") + """
SELECT c.customer_id, CASE WHEN f.first_ts >= (SELECT max(first_ts) FROM f) - INTERVAL 3650 DAY THEN CAST(c.age AS BIGINT) END AS age,
       CASE WHEN f.first_ts >= (SELECT max(first_ts) FROM f) - INTERVAL 3650 DAY THEN c.gender END AS gender,
       CASE WHEN f.first_ts >= (SELECT max(first_ts) FROM f) - INTERVAL 3650 DAY THEN c.segment END AS segment,
       CASE WHEN f.first_ts >= (SELECT max(first_ts) FROM f) - INTERVAL 3650 DAY THEN f.first_ts END AS event_timestamp
FROM customers c LEFT JOIN f ON c.customer_id = f.customer_id"""

ORACLE["point_in_time_features"] = with_views("transactions", extra="""last_per_ts AS (
  SELECT customer_id, "timestamp" AS ft,
         arg_max(sku_id, (transaction_id, sku_id, quantity, discount_applied, total_amount)) AS sku_id, arg_max(quantity, (transaction_id, sku_id, quantity, discount_applied, total_amount)) AS quantity,
         arg_max(discount_applied, (transaction_id, sku_id, quantity, discount_applied, total_amount)) AS discount_applied,
         arg_max(total_amount, (transaction_id, sku_id, quantity, discount_applied, total_amount)) AS total_amount
  FROM transactions GROUP BY customer_id, "timestamp"),
o AS (SELECT o_orderkey, o_custkey AS customer_id, o_orderdate AS as_of FROM orders)""") + f"""
SELECT o.o_orderkey, o.customer_id, o.as_of,
       CASE WHEN o.as_of - l.ft <= INTERVAL 365 DAY THEN l.sku_id END AS sku_id,
       CASE WHEN o.as_of - l.ft <= INTERVAL 365 DAY THEN CAST(l.quantity AS BIGINT) END AS quantity,
       {r6("CASE WHEN o.as_of - l.ft <= INTERVAL 365 DAY THEN l.discount_applied END")} AS discount_applied,
       {r6("CASE WHEN o.as_of - l.ft <= INTERVAL 365 DAY THEN l.total_amount END")} AS total_amount,
       CASE WHEN o.as_of - l.ft <= INTERVAL 365 DAY THEN l.ft END AS feature_ts
FROM o ASOF LEFT JOIN last_per_ts l ON o.customer_id = l.customer_id AND o.as_of >= l.ft"""


# ------------------------------------------------------------ segmentation --
_SEGRFM = f"""srfm AS (
  SELECT customer_id, {_REC} AS recency, count(*) AS frequency, sum(total_amount) AS monetary
  FROM transactions GROUP BY customer_id),
z AS (
  SELECT *, CASE WHEN stddev_pop(recency) OVER () > 0 THEN (recency - avg(recency) OVER ()) / stddev_pop(recency) OVER () ELSE 0 END AS recency_z,
         CASE WHEN stddev_pop(frequency) OVER () > 0 THEN (frequency - avg(frequency) OVER ()) / stddev_pop(frequency) OVER () ELSE 0 END AS frequency_z,
         CASE WHEN stddev_pop(CAST(monetary AS DOUBLE)) OVER () > 0 THEN (CAST(monetary AS DOUBLE) - avg(CAST(monetary AS DOUBLE)) OVER ()) / stddev_pop(CAST(monetary AS DOUBLE)) OVER () ELSE 0 END AS monetary_z
  FROM srfm)"""

ORACLE["standardized_rfm"] = with_views("transactions", extra=_SEGRFM) + f"""
SELECT customer_id, recency, frequency, {r6('monetary')} AS monetary, {r6('recency_z')} AS recency_z,
       {r6('frequency_z')} AS frequency_z, {r6('monetary_z')} AS monetary_z,
       {r6('CAST(monetary AS DOUBLE) * (frequency / (recency + 1))')} AS lifetime_value FROM z"""

ORACLE["segment_profile_names"] = with_views("transactions", "customers", extra=_SEGRFM + """,
cent AS (SELECT c.segment, avg(recency_z) AS c_rec, avg(frequency_z) AS c_freq, avg(monetary_z) AS c_mon
         FROM z JOIN customers c ON z.customer_id = c.customer_id GROUP BY c.segment)""") + f"""
SELECT segment, {r6('c_rec')} AS c_rec, {r6('c_freq')} AS c_freq, {r6('c_mon')} AS c_mon,
       CASE WHEN c_mon > 0.5 AND c_freq > 0.5 THEN 'VIP Champions'
            WHEN c_freq > 0.3 AND c_rec < 0 THEN 'Loyal Customers'
            WHEN c_rec < -0.5 THEN 'Recent Buyers'
            WHEN c_rec > 0.5 AND c_freq < 0 THEN 'At Risk'
            WHEN c_rec > 1.0 THEN 'Lost Customers'
            ELSE 'Potential Loyalists' END AS segment_name
FROM cent"""


# ------------------------------------------------------------- forecasting --
def _seasonal(series_cte: str, keys: list[str], horizon: int, tag: str, z: float = 1.2816) -> str:
    k = ", ".join(keys)
    return f"""{series_cte},
s_{tag} AS (SELECT {k}, CAST(ds AS DATE) AS ds, CAST(y AS DOUBLE) AS y,
                   CAST(CAST(ds AS DATE) - DATE '1970-01-01' AS DOUBLE) AS t FROM ser_{tag}),
tr_{tag} AS (SELECT {k}, min(ds) AS first_ds, max(ds) AS last_ds, count(*) AS n,
                    CASE WHEN count(*) > 1 AND var_pop(t) > 0 THEN regr_slope(y, t) ELSE 0.0 END AS b,
                    CASE WHEN count(*) > 1 AND var_pop(t) > 0 THEN regr_intercept(y, t) ELSE avg(y) END AS a,
                    TRUE AS yearly
             FROM s_{tag} GROUP BY {k}),
r_{tag} AS (SELECT s.*, tr.a, tr.b, tr.yearly, s.y - (tr.a + tr.b * s.t) AS r1, isodow(s.ds) - 1 AS wd,
                   month(s.ds) AS mo FROM s_{tag} s JOIN tr_{tag} tr USING ({k})),
wd_{tag} AS (SELECT {k}, wd, avg(r1) AS w_eff FROM r_{tag} GROUP BY {k}, wd),
r2_{tag} AS (SELECT r.*, r.r1 - w.w_eff AS r2 FROM r_{tag} r JOIN wd_{tag} w USING ({k}, wd)),
mo_{tag} AS (SELECT {k}, mo, avg(r2) AS m_eff FROM r2_{tag} WHERE yearly GROUP BY {k}, mo),
res_{tag} AS (SELECT r.*, r.r2 - coalesce(m.m_eff, 0) AS resid FROM r2_{tag} r LEFT JOIN mo_{tag} m USING ({k}, mo)),
sig_{tag} AS (SELECT {k}, coalesce(stddev_samp(resid), 0.0) AS sigma FROM res_{tag} GROUP BY {k}),
fut_{tag} AS (SELECT tr.*, sg.sigma, CAST(tr.last_ds + CAST(kk AS INTEGER) AS DATE) AS fds
              FROM tr_{tag} tr JOIN sig_{tag} sg USING ({k}), range(1, {horizon + 1}) t(kk)),
fc_{tag} AS (SELECT {", ".join("f." + c for c in keys)}, f.fds AS ds,
                    f.a + f.b * CAST(f.fds - DATE '1970-01-01' AS DOUBLE) + coalesce(w.w_eff, 0) + coalesce(m.m_eff, 0) AS yhat,
                    f.sigma
             FROM fut_{tag} f
             LEFT JOIN wd_{tag} w ON {" AND ".join(f"w.{c} = f.{c}" for c in keys)} AND w.wd = isodow(f.fds) - 1
             LEFT JOIN mo_{tag} m ON {" AND ".join(f"m.{c} = f.{c}" for c in keys)} AND m.mo = month(f.fds))"""


def _fc_select(keys, tag, z=1.2816):
    k = ", ".join(keys)
    return f"""SELECT {k}, strftime(ds, '%Y-%m-%d') AS ds, {r6('yhat')} AS yhat,
       {r6(f'yhat - {z} * sigma')} AS yhat_lower, {r6(f'yhat + {z} * sigma')} AS yhat_upper FROM fc_{tag}"""


_SKU_SER = with_views("transactions", extra="""ser_k AS (
  SELECT sku_id, CAST("timestamp" AS DATE) AS ds, sum(quantity) AS y FROM transactions GROUP BY 1, 2)""").rstrip()
_PLAT_SER = with_views("transactions", extra="""ser_p AS (
  SELECT 'platform' AS series, CAST("timestamp" AS DATE) AS ds, sum(quantity) AS y FROM transactions GROUP BY 2)""").rstrip()

ORACLE["sku_forecast"] = _seasonal(_SKU_SER, ["sku_id"], 7, "k") + "\n" + _fc_select(["sku_id"], "k")
ORACLE["platform_forecast"] = _seasonal(_PLAT_SER, ["series"], 30, "p") + "\n" + _fc_select(["series"], "p")
ORACLE["forecast_horizon_end"] = _seasonal(_SKU_SER, ["sku_id"], 7, "k") + f"""
SELECT sku_id, strftime(max(ds), '%Y-%m-%d') AS ds, {r6('arg_max(yhat, ds)')} AS yhat,
       {r6('arg_max(yhat - 1.2816 * sigma, ds)')} AS yhat_lower, {r6('arg_max(yhat + 1.2816 * sigma, ds)')} AS yhat_upper
FROM fc_k GROUP BY sku_id"""

# trend, weekdays and yearly harmonics by Gauss-Jordan elimination on the normal equations
_DESIGN = ("[1.0::DOUBLE, date_diff('day', first_ds, ds) / 365.25, " + ", ".join(f"(isodow(ds) = {d})::INT::DOUBLE" for d in range(2, 8))
           + ", " + ", ".join(f"{f}(date_diff('day', DATE '1970-01-01', ds) * 2 * pi() * {h} / 365.25)" for h in (1, 2) for f in ("sin", "cos")) + "]")
ORACLE["category_seasonal_regression"] = "WITH RECURSIVE " + with_views("transactions", "products").split("WITH ", 1)[1].rstrip() + f""",
ser AS (SELECT category, CAST("timestamp" AS DATE) AS ds, CAST(sum(quantity) AS DOUBLE) AS y FROM transactions JOIN products USING (sku_id) GROUP BY 1, 2),
s AS (SELECT *, min(ds) OVER (PARTITION BY category) AS first_ds, max(ds) OVER (PARTITION BY category) AS last_ds FROM ser),
x AS (SELECT *, {_DESIGN} AS x FROM s),
cell AS (SELECT category, i, j, sum(x[i] * CASE WHEN j = 13 THEN y ELSE x[j] END) AS v FROM x, range(1, 13) a(i), range(1, 14) b(j) GROUP BY category, i, j),
ln AS (SELECT category, i, list(v ORDER BY j) AS r FROM cell GROUP BY category, i),
el(category, k, m) AS (
  SELECT category, 1, list(r ORDER BY i) FROM ln GROUP BY category
  UNION ALL SELECT category, k + 1, list_transform(m, lambda r, i: CASE WHEN i = k THEN list_transform(r, lambda e: e / m[k][k])
                                                                      ELSE list_transform(r, lambda e, j: e - r[k] * m[k][j] / m[k][k]) END) FROM el WHERE k <= 12),
beta AS (SELECT category, list_transform(m, lambda r: r[13]) AS b FROM el WHERE k = 13),
fit AS (SELECT x.category, any_value(x.first_ds) AS first_ds, any_value(x.last_ds) AS last_ds, any_value(b) AS b,
               sqrt(sum((y - list_dot_product(x, b)) ** 2) / (count(*) - 12)) AS sigma FROM x JOIN beta ON beta.category = x.category GROUP BY x.category),
fut AS (SELECT *, last_ds + CAST(h AS INTEGER) AS ds FROM fit, range(1, 31) t(h)),
yh AS (SELECT category, ds, sigma, list_dot_product(b, {_DESIGN}) AS yhat FROM fut)
SELECT category, strftime(ds, '%Y-%m-%d') AS ds, {r6('yhat')} AS yhat, {r6('yhat - 1.2816 * sigma')} AS yhat_lower, {r6('yhat + 1.2816 * sigma')} AS yhat_upper FROM yh"""

ORACLE["series_index_scaled"] = _SKU_SER + f"""
SELECT sku_id, strftime(ds, '%Y-%m-%d') AS ds, CAST(y AS BIGINT) AS y,
       CAST(row_number() OVER (PARTITION BY sku_id ORDER BY ds) - 1 AS BIGINT) AS time_idx,
       {r6("CASE WHEN max(y) OVER (PARTITION BY sku_id) > min(y) OVER (PARTITION BY sku_id) THEN (y - min(y) OVER (PARTITION BY sku_id)) * 1.0 / (max(y) OVER (PARTITION BY sku_id) - min(y) OVER (PARTITION BY sku_id)) ELSE 0.0 END")} AS y_scaled
FROM ser_k"""

ORACLE["lag_windows"] = _PLAT_SER + """
SELECT series, strftime(ds, '%Y-%m-%d') AS ds, CAST(y AS BIGINT) AS y, array_to_string(x, ',') AS x FROM (
  SELECT *, list(CAST(y AS BIGINT)) OVER (ORDER BY ds ROWS BETWEEN 28 PRECEDING AND 1 PRECEDING) AS x FROM ser_p)
WHERE len(x) = 28"""

ORACLE["chrono_split"] = _SKU_SER + """
SELECT sku_id, strftime(ds, '%Y-%m-%d') AS ds, CAST(y AS BIGINT) AS y,
       row_number() OVER (PARTITION BY sku_id ORDER BY ds) <= floor(count(*) OVER (PARTITION BY sku_id) * 0.8) AS is_train
FROM ser_k"""

_BF_SER = with_views("transactions", extra="""allp AS (
  SELECT 'platform' AS series, CAST("timestamp" AS DATE) AS ds, sum(quantity) AS y FROM transactions GROUP BY 2),
ser_b AS (SELECT * FROM allp WHERE ds <= (SELECT max(ds) FROM allp) - 30)""").rstrip()
_BF = _seasonal(_BF_SER, ["series"], 30, "b") + """,
bf AS (SELECT f.series, f.ds, f.yhat, f.yhat - 1.2816 * f.sigma AS yhat_lower, f.yhat + 1.2816 * f.sigma AS yhat_upper,
              CAST(a.y AS DOUBLE) AS actual
       FROM fc_b f LEFT JOIN allp a ON a.series = f.series AND a.ds = f.ds)"""

ORACLE["forecast_backfill"] = _BF + f"""
SELECT series, strftime(ds, '%Y-%m-%d') AS ds, {r6('yhat')} AS yhat, {r6('yhat_lower')} AS yhat_lower,
       {r6('yhat_upper')} AS yhat_upper, {r6('actual')} AS actual,
       {r6('abs(actual - yhat) / nullif(actual, 0.0) * 100')} AS mape FROM bf"""

ORACLE["forecast_accuracy"] = _BF + f"""
SELECT series, {r6('avg((actual - yhat) * (actual - yhat))')} AS mse, {r6('avg(abs(actual - yhat))')} AS mae,
       {r6('sqrt(avg((actual - yhat) * (actual - yhat)))')} AS rmse,
       {r6('avg(abs(actual - yhat) / nullif(abs(actual), 0)) * 100')} AS mape,
       {r6('avg(CAST(actual BETWEEN yhat_lower AND yhat_upper AS DOUBLE))')} AS coverage, count(*) AS n
FROM bf WHERE actual IS NOT NULL GROUP BY series"""


# ------------------------------------------------------------------- churn --
def _churn_sql(legacy: bool) -> str:
    if legacy:
        cut = '(SELECT max("timestamp") FROM transactions)'
        hist = "transactions"
    else:
        cut = '((SELECT max("timestamp") FROM transactions) - INTERVAL 90 DAY)'
        hist = f'(SELECT * FROM transactions WHERE "timestamp" <= {cut})'
    body = with_views("transactions", "customers", extra=f"""h AS (
  SELECT customer_id, max("timestamp") AS last_ts, count(*) AS frequency, sum(total_amount) AS monetary
  FROM {hist} GROUP BY customer_id),
f AS (
  SELECT c.customer_id, CAST(c.age AS DOUBLE) AS age,
         CAST(coalesce({elapsed(cut, 'h.last_ts')}, 0) AS DOUBLE) AS recency,
         CAST(coalesce(h.frequency, 0) AS DOUBLE) AS frequency, coalesce(CAST(h.monetary AS DOUBLE), 0.0) AS monetary
  FROM customers c LEFT JOIN h ON c.customer_id = h.customer_id)""")
    if legacy:
        label = "CAST(recency > 90 AS INTEGER)"
        frm = "f"
    else:
        label = "CASE WHEN a.customer_id IS NULL THEN 1 ELSE 0 END"
        frm = (f'f LEFT JOIN (SELECT DISTINCT customer_id FROM transactions WHERE "timestamp" > {cut} '
               f'AND "timestamp" <= {cut} + INTERVAL 90 DAY) a ON f.customer_id = a.customer_id')
    return body + f"""SELECT f.customer_id, f.age, f.recency, f.frequency, {r6('f.monetary')} AS monetary,
       CAST({label} AS BIGINT) AS churn FROM {frm}"""


ORACLE["churn_training_set"] = _churn_sql(False)
ORACLE["churn_training_set_legacy"] = _churn_sql(True)

_DOCS = """WITH d AS (SELECT l.doc_id, l.quality, l.toxic, d.n_chars, d.text FROM labels l JOIN documents d ON l.doc_id = d.doc_id),
sd AS (SELECT doc_id, quality, toxic, n_chars * 1.0 / (SELECT max(n_chars) FROM d) AS score,
              CAST(len(string_split(text, chr(10))) AS DOUBLE) AS line_score FROM d)"""


def _auc_sql(score: str, label: str, src: str = "sd") -> str:
    return f"""(SELECT (sum(CASE WHEN {label} = 1 THEN rk END) - n1 * (n1 + 1) / 2.0) / nullif(n1 * n0, 0) AS auc,
       n1 AS n_pos, n0 AS n_neg FROM (
  SELECT {label}, rank() OVER (ORDER BY {score}) + (count(*) OVER (PARTITION BY {score}) - 1) / 2.0 AS rk,
         count(*) FILTER (WHERE {label} = 1) OVER () AS n1, count(*) FILTER (WHERE {label} = 0) OVER () AS n0
  FROM {src}) GROUP BY n1, n0)"""


ORACLE["auc_labels"] = _DOCS + f"\nSELECT {r6('auc')} AS auc, n_pos, n_neg FROM {_auc_sql('score', 'quality')}"
ORACLE["f1_labels"] = _DOCS + f""",
c AS (SELECT count(*) FILTER (WHERE score > 0.35 AND quality = 1) AS tp,
             count(*) FILTER (WHERE score > 0.35 AND quality <> 1) AS fp,
             count(*) FILTER (WHERE NOT score > 0.35 AND quality = 1) AS fn FROM sd)
SELECT tp, fp, fn, {r6('tp * 1.0 / nullif(tp + fp, 0)')} AS precision, {r6('tp * 1.0 / nullif(tp + fn, 0)')} AS recall,
       {r6('coalesce(2.0 * tp / nullif(2 * tp + fp + fn, 0), 0.0)')} AS f1 FROM c"""
ORACLE["precision_top_labels"] = _DOCS + f"""
SELECT {r6('avg(CAST(quality AS DOUBLE))')} AS precision_top, count(*) AS n_top FROM (
  SELECT quality, row_number() OVER (ORDER BY score DESC, doc_id) AS rn FROM sd)
WHERE rn <= ceil((SELECT count(*) FROM sd) * 0.2)"""
ORACLE["champion_challenger_labels"] = _DOCS + f"""
SELECT {r6('a.auc')} AS champion_auc, {r6('b.auc')} AS challenger_auc, b.auc > a.auc + 0.01 AS promote_challenger,
       CASE WHEN b.auc > a.auc + 0.01 THEN 'PROMOTE line_score' ELSE 'KEEP score' END AS recommendation
FROM {_auc_sql('score', 'quality')} a, {_auc_sql('line_score', 'quality')} b"""

ORACLE["sku_lookup_with_defaults"] = "SELECT r.* FROM (" + _report_sql("7.0") + \
    """) r WHERE r.sku_id IN (SELECT DISTINCT l_partkey FROM lineitem)
UNION ALL SELECT -k - 1, 0, CAST(round_even(sqrt(2 * 5.0 * 365 * 50.0 / (10.0 * 0.2)), 0) AS BIGINT),
       CAST(round_even(1.65 * 2.0 * sqrt(7.0), 0) AS BIGINT), round(5.0 * 7.0 + 1.65 * 2.0 * sqrt(7.0), 6), 1.0, 0.0, 'C', TRUE
FROM (SELECT DISTINCT l_partkey AS k FROM lineitem)"""
ORACLE["unknown_skus"] = """SELECT k AS sku_id FROM (SELECT DISTINCT l_partkey AS k FROM lineitem UNION ALL SELECT DISTINCT -l_partkey - 1 FROM lineitem)
WHERE k NOT IN (SELECT p_partkey FROM part)"""
ORACLE["capped_costs"] = with_views("products", extra="""c AS (
  SELECT sku_id, base_price, CAST(base_price * (CAST(0.4 AS DECIMAL(3,1)) + CAST(sku_id % 10 AS DECIMAL(2,0)) * CAST(0.1 AS DECIMAL(2,1))) AS DECIMAL(12,2)) AS cost
  FROM products)""") + f"""
SELECT sku_id, {r6('base_price')} AS base_price, {r6('cost')} AS cost,
       {r6('CASE WHEN cost >= base_price THEN CAST(base_price * CAST(0.6 AS DECIMAL(2,1)) AS DECIMAL(12,2)) ELSE cost END')} AS capped_cost FROM c"""
ORACLE["online_lookup_keys"] = with_views("transactions", "customers", extra="""f AS (
  SELECT customer_id, min("timestamp") AS first_ts FROM transactions GROUP BY customer_id),
k AS (SELECT DISTINCT o_custkey * 2 AS customer_id FROM orders),
ok AS (SELECT c.*, f.first_ts FROM customers c JOIN f ON c.customer_id = f.customer_id
       WHERE f.first_ts >= (SELECT max(first_ts) FROM f) - INTERVAL 3650 DAY)""") + """
SELECT k.customer_id, CAST(ok.age AS BIGINT) AS age, ok.gender, ok.segment, ok.first_ts AS event_timestamp
FROM k LEFT JOIN ok ON k.customer_id = ok.customer_id"""


# --------------------------------------------- brute-force / extra oracles --
# K3: DBSCAN noise by brute force over all customer pairs (the Spark side uses
# the grid formulation); cheap for DuckDB at the check scale.
ORACLE["density_outliers"] = with_views("transactions", extra=_SEGRFM + """,
pairs AS (
  SELECT a.customer_id AS id, b.customer_id AS nid
  FROM z a JOIN z b ON sqrt((a.recency_z - b.recency_z) ^ 2 + (a.frequency_z - b.frequency_z) ^ 2
                            + (a.monetary_z - b.monetary_z) ^ 2) <= 0.8),
cnt AS (SELECT id, count(*) AS n FROM pairs GROUP BY id),
core AS (SELECT id FROM cnt WHERE n >= 5),
border AS (SELECT DISTINCT p.id FROM pairs p JOIN core c ON p.nid = c.id)""") + """
SELECT z.customer_id, z.customer_id IN (SELECT id FROM core) AS is_core,
       NOT (z.customer_id IN (SELECT id FROM core)) AND NOT (z.customer_id IN (SELECT id FROM border)) AS is_outlier
FROM z"""

# E7 over the serving snapshot: every customer's row is at the reference date,
# inside the 30-day TTL, so the snapshot is the serving table's RFM columns.
ORACLE["rfm_view_snapshot"] = "SELECT customer_id, recency, frequency, monetary, churn_risk, clv_score, " \
    "event_timestamp FROM (" + ORACLE["serving_features"] + ")"

# N12 over the paths of page URLs and of requests derived from the event log
ORACLE["endpoint_classes"] = """WITH p AS (
  SELECT ['/api/v1/predict/', '/api/v1/segment/', '/api/v1/revenue/', '/api/v1/inventory/', '/health/'][event_id % 5 + 1] || event_type AS path FROM events
  UNION ALL
  SELECT CASE WHEN regexp_matches(url, '^[A-Za-z][A-Za-z0-9+.-]*://')
              THEN regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1) END AS path FROM pages)
SELECT CASE WHEN contains(path, '/predict/') OR starts_with(path, '/api/v1/predict') THEN '/api/v1/predict/*'
            WHEN contains(path, '/segment') THEN '/api/v1/segment/*'
            WHEN contains(path, '/revenue') THEN '/api/v1/revenue/*'
            WHEN contains(path, '/inventory') THEN '/api/v1/inventory/*'
            ELSE path END AS endpoint, count(*) AS n
FROM p GROUP BY 1"""


# ------------------------------------------------------- event validation --
# messages damaged by integer arithmetic on the ids (see streaming.ingest.damaged_messages)
_MESSAGES = with_views("transactions", extra="""m AS (
  SELECT *, CASE WHEN (transaction_id * 31 + sku_id) % 20 <> 0 THEN -1 ELSE (transaction_id // 20) % 6 END AS kind
  FROM transactions)""")
ORACLE["event_validation"] = _MESSAGES + f"""
SELECT CASE WHEN kind <> 3 THEN CAST(transaction_id AS VARCHAR) END AS transaction_id,
       CASE WHEN kind NOT IN (0, 3) THEN CAST(sku_id AS VARCHAR) END AS sku_id,
       CASE WHEN kind NOT IN (1, 2, 3) THEN CAST(quantity AS BIGINT) END AS quantity,
       CASE WHEN kind <> 3 THEN {r6('total_amount')} END AS total_amount,
       CASE WHEN kind IN (0, 3) THEN 0.0 ELSE {r6('discount_applied')} END AS discount_applied,
       CASE WHEN kind NOT IN (3, 4) THEN date_trunc('second', "timestamp") END AS "timestamp",
       CASE WHEN kind = 5 THEN '{{"store":"S1"}}' END AS _extra,
       CASE kind WHEN 0 THEN 'Missing required field: sku_id' WHEN 1 THEN 'Type cast error: quantity is not an integer'
                 WHEN 2 THEN 'Type cast error: quantity is not an integer' WHEN 3 THEN 'JSON decode error' END AS _dlq_reason
FROM m"""
ORACLE["dead_letter_counts"] = f"""SELECT coalesce(_dlq_reason, 'valid') AS outcome, count(*) AS n
FROM ({ORACLE['event_validation']}) GROUP BY 1"""


# ------------------------------------------------------- further profiles --
ORACLE["market_segment_profile"] = with_views("transactions", "customers", extra=_SEGRFM + """,
sm AS (SELECT c.segment, count(*) AS n, avg(recency) AS ar, avg(frequency) AS af, avg(CAST(monetary AS DOUBLE)) AS am, sum(monetary) AS tr
       FROM srfm r JOIN customers c ON r.customer_id = c.customer_id GROUP BY c.segment)""") + f"""
SELECT segment, n AS count, {r6('ar')} AS avg_recency, {r6('af')} AS avg_frequency, {r6('am')} AS avg_monetary, {r6('tr')} AS total_revenue,
       {r6('ar / greatest(max(ar) OVER (), 1.0) * 100')} AS avg_recency_pct, {r6('af / greatest(max(af) OVER (), 1.0) * 100')} AS avg_frequency_pct,
       {r6('am / greatest(max(am) OVER (), 1.0) * 100')} AS avg_monetary_pct
FROM sm"""

ORACLE["cross_elasticity_matrix"] = ORACLE["cross_elasticity"].rsplit("SELECT focal, competitor, n AS n_periods", 1)[0].rstrip() + f""",
mx AS (SELECT focal, competitor, {r6('CASE WHEN n >= 20 THEN coalesce(theta, 0.0) END')} AS e FROM dml_x
       UNION ALL SELECT DISTINCT focal, focal, 0.0 FROM dml_x)
SELECT focal, {", ".join(f"max(CASE WHEN competitor = '{c}' THEN e END) AS {c}" for c in ("ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"))}
FROM mx GROUP BY focal"""

ORACLE["fpr_gap_recency"] = f"""WITH d AS ({ORACLE['churn_training_set']}),
p AS (SELECT CASE WHEN age < 30 THEN 'young' WHEN age > 50 THEN 'old' END AS cohort,
             recency / (recency + 60.0) > 0.5 AS pred, churn = 0 AS neg FROM d),
f AS (SELECT cohort, count(*) FILTER (WHERE pred AND neg) * 1.0 / nullif(count(*) FILTER (WHERE neg), 0) AS fpr FROM p WHERE cohort IS NOT NULL GROUP BY cohort),
w AS (SELECT max(CASE WHEN cohort = 'young' THEN fpr END) AS y, max(CASE WHEN cohort = 'old' THEN fpr END) AS o FROM f)
SELECT {r6('y')} AS fpr_young, {r6('o')} AS fpr_old, {r6('abs(y - o)')} AS fpr_gap, abs(y - o) <= 0.05 AS within_tolerance FROM w"""

ORACLE["holdout_split"] = f"""WITH d AS (SELECT churn, count(*) AS n FROM ({ORACLE['churn_training_set']}) GROUP BY churn),
s AS (SELECT churn, TRUE AS is_train, n * 80 // 100 AS n FROM d UNION ALL SELECT churn, FALSE, n - n * 80 // 100 FROM d)
SELECT churn, is_train, CAST(n AS BIGINT) AS n FROM s WHERE n > 0"""

ORACLE["churn_feature_matrix"] = f"""WITH d AS ({ORACLE['churn_training_set']})
SELECT customer_id, 'age' AS feature, age AS value FROM d UNION ALL SELECT customer_id, 'recency', recency FROM d
UNION ALL SELECT customer_id, 'frequency', frequency FROM d UNION ALL SELECT customer_id, 'monetary', monetary FROM d"""

ORACLE["dq_missing_columns"] = with_views("transactions") + """,
u AS (SELECT count(*) AS dup FROM transactions WHERE customer_id IN (SELECT customer_id FROM transactions GROUP BY customer_id HAVING count(*) > 1))
SELECT 'transactions' AS "table", 'exists' AS expectation, c AS "column", CAST(NULL AS BIGINT) AS failed_rows, c = 'customer_id' AS success
FROM (VALUES ('customer_id'), ('age'), ('region')) x(c)
UNION ALL SELECT 'transactions', 'between', 'age', NULL, FALSE
UNION ALL SELECT 'transactions', 'not_null', 'customer_id', count(*) FILTER (WHERE customer_id IS NULL), count(*) FILTER (WHERE customer_id IS NULL) = 0 FROM transactions
UNION ALL SELECT 'transactions', 'unique', 'customer_id', dup, dup = 0 FROM u"""

# the expected fields, declared here; their JSON text is in canonical form already
_FIELDS = {
    "customers": "customer_id bigint, age int, gender string, segment string, region string",
    "products": "sku_id bigint, category string, base_price decimal(12;2), cost_price decimal(12;2)",
    "transactions": "transaction_id bigint, customer_id bigint, sku_id bigint, timestamp timestamp_ntz, quantity int, "
                    "discount_applied decimal(4;2), total_amount decimal(15;2)",
    "inventory": "sku_id bigint, current_stock int, reorder_point int, supplier_lead_time_days int",
}
_FIELD_ROWS = ", ".join(f"('{t}', {i}, '{f.split()[0]}', '{f.split()[1].replace(';', ',')}')" for t, fs in _FIELDS.items() for i, f in enumerate(fs.split(", ")))
ORACLE["dataset_profile"] = with_views("transactions", "products", "customers", "inventory") + f""",
f AS (SELECT t AS dataset, count(*) AS field_count, '[' || string_agg('{{"name":"' || c || '","type":"' || k || '"}}', ',' ORDER BY i) || ']' AS fields
      FROM (VALUES {_FIELD_ROWS}) x(t, i, c, k) GROUP BY t),
n AS (SELECT 'customers' AS dataset, count(*) AS row_count FROM customers UNION ALL SELECT 'products', count(*) FROM products
      UNION ALL SELECT 'transactions', count(*) FROM transactions UNION ALL SELECT 'inventory', count(*) FROM inventory)
SELECT dataset, row_count, field_count, fields, substr(sha256(fields), 1, 12) AS schema_hash FROM f JOIN n USING (dataset)"""

ORACLE["dataset_sizes"] = with_views("transactions", "products", "customers", "inventory") + """
SELECT 'customers' AS dataset, count(*) AS row_count, CAST(5 AS BIGINT) AS field_count FROM customers
UNION ALL SELECT 'products', count(*), 4 FROM products UNION ALL SELECT 'transactions', count(*), 7 FROM transactions
UNION ALL SELECT 'inventory', count(*), 4 FROM inventory"""

ORACLE["forecast_degradation"] = _BF + f""",
h AS (SELECT series, date_diff('day', (SELECT min(ds) FROM bf WHERE actual IS NOT NULL), ds) >= 15 AS late,
             abs(actual - yhat) / nullif(actual, 0.0) * 100 AS mape FROM bf WHERE actual IS NOT NULL)
SELECT series, {r6('avg(mape) FILTER (WHERE NOT late)')} AS baseline_mape, {r6('avg(mape) FILTER (WHERE late)')} AS current_mape,
       avg(mape) FILTER (WHERE late) > avg(mape) FILTER (WHERE NOT late) * 1.15 AS degraded
FROM h GROUP BY series"""

_ARITHMETIC = "WITH d AS (" + ORACLE["churn_training_set"] + """),
e AS (SELECT customer_id, feature, CAST(((customer_id * k + CAST(floor(v) AS BIGINT)) % 11 + 11) % 11 - 5 AS DOUBLE) AS attribution FROM (
  SELECT customer_id, 'age' AS feature, 3 AS k, age AS v FROM d UNION ALL SELECT customer_id, 'recency', 4, recency FROM d
  UNION ALL SELECT customer_id, 'frequency', 5, frequency FROM d UNION ALL SELECT customer_id, 'monetary', 6, monetary FROM d))
"""
ORACLE["attribution_ranks"] = _ARITHMETIC + """
SELECT customer_id, feature, attribution, CAST(row_number() OVER (PARTITION BY customer_id ORDER BY abs(attribution) DESC, feature) AS INTEGER) AS rank FROM e"""
ORACLE["attribution_importance"] = _ARITHMETIC + f"""
SELECT feature, {r6('avg(abs(attribution))')} AS mean_abs_attribution FROM e GROUP BY feature ORDER BY avg(abs(attribution)) DESC, feature LIMIT 3"""
ORACLE["risk_tiers"] = "WITH d AS (" + ORACLE["churn_training_set"] + """)
SELECT customer_id, CASE WHEN (customer_id * 7) % 101 >= 70 THEN 'High' WHEN (customer_id * 7) % 101 >= 40 THEN 'Medium' ELSE 'Low' END AS risk_segment FROM d"""
ORACLE["published_orders"] = """SELECT CAST(year(o_orderdate) AS INTEGER) AS year, count(*) AS orders, count(*) FILTER (WHERE o_orderdate <= DATE '1997-01-01') AS with_priority,
       CAST(sum(o_orderkey) AS BIGINT) AS keys FROM orders GROUP BY 1"""

ORACLE["bucketed_feature_lookup"] = with_views("transactions", "customers", extra="""f AS (
  SELECT customer_id, min("timestamp") AS first_ts FROM transactions GROUP BY customer_id),
ok AS (SELECT c.*, f.first_ts FROM customers c JOIN f ON c.customer_id = f.customer_id
       WHERE f.first_ts >= (SELECT max(first_ts) FROM f) - INTERVAL 3650 DAY)""") + """
SELECT o.o_orderkey, o.o_custkey * 2 AS customer_id, CAST(ok.age AS BIGINT) AS age, ok.gender, ok.segment, ok.first_ts AS event_timestamp
FROM orders o LEFT JOIN ok ON o.o_custkey * 2 = ok.customer_id"""
