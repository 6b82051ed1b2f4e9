"""The SQL twin of each query, written against the given tables alone.

Change logs are never rebuilt as JSON here: their fixed rules give the expected rows directly.
"""

from __future__ import annotations

from tidelog.quality.expectations import Expectation
from tidelog.quality.suites import LAYERS, SUITES
from workload.domain import AS_OF, RUN_TS
from workload.queries import AS_OF_MS, BATCH_BOUNDS, PARITY_AS_OF


def average(total: str, count: str, precision: int = 18) -> str:
    """Exact half-up quotient of a non-negative amount; decimal division would go through double."""
    return (
        f"CAST(CAST((2 * CAST({total} * 100 AS HUGEINT) + {count}) // (2 * {count}) "
        f"AS DECIMAL(30,0)) * 0.01::DECIMAL(3,2) AS DECIMAL({precision},2))"
    )


def uuid_of(text: str) -> str:
    cuts = ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))
    return " || '-' || ".join(f"substr(md5({text}), {a}, {n})" for a, n in cuts)


def iso(ts: str) -> str:
    return f"strftime({ts}, '%Y-%m-%dT%H:%M:%S.%fZ')"


STATUS = "CASE o_orderstatus WHEN 'F' THEN 'delivered' WHEN 'O' THEN 'confirmed' ELSE 'pending' END"
REVENUE = "status IN ('confirmed', 'shipped', 'delivered', 'completed')"
ITEM_ID = "concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey)"

# Domain tables

S_ORDERS = f"""
SELECT CAST(o_orderkey AS VARCHAR) AS order_id, CAST(o_custkey AS VARCHAR) AS customer_id,
  {STATUS} AS status, CAST(o_totalprice AS DECIMAL(18,2)) AS total_amount,
  CAST(NULL AS VARCHAR) AS currency, o_orderdate AS created_at, o_orderdate AS updated_at,
  'c' AS _source_op, TIMESTAMP '{RUN_TS}' AS _ingested_at
FROM orders"""

EMAIL = "lower(replace(c_name, '#', '.')) || '@example.com'"
CUSTOMER_CREATED = "TIMESTAMP '1995-01-01 00:00:00' + to_minutes(c_custkey)"

S_CUSTOMERS = f"""
SELECT CAST(c_custkey AS VARCHAR) AS customer_id, c_name AS name, {EMAIL} AS email,
  {CUSTOMER_CREATED} AS created_at, {CUSTOMER_CREATED} AS updated_at, 'c' AS _source_op,
  TIMESTAMP '{RUN_TS}' AS _ingested_at
FROM customer"""

ITEMS = f"""
SELECT {ITEM_ID} AS item_id, CAST(l_orderkey AS VARCHAR) AS order_id,
  CAST(l_partkey AS VARCHAR) AS product_id, CAST(l_quantity AS INTEGER) AS quantity,
  CAST(l_extendedprice AS DECIMAL(18,2)) AS unit_price,
  CAST(CAST(l_quantity AS INTEGER) * CAST(l_extendedprice AS DECIMAL(18,2)) AS DECIMAL(18,2))
    AS line_total,
  l_shipdate
FROM lineitem"""

S_ITEMS = f"""
SELECT i.item_id, i.order_id, i.product_id, i.quantity, i.unit_price, i.line_total,
  o.created_at AS order_created_at, TIMESTAMP '{RUN_TS}' AS _ingested_at
FROM ({ITEMS}) i LEFT JOIN ({S_ORDERS}) o ON i.order_id = o.order_id"""

# The log holds one version per line-item row; the last shipped one of an item id is its state.
LATEST_ITEMS = f"""
SELECT * FROM ({ITEMS})
QUALIFY row_number() OVER (PARTITION BY item_id ORDER BY l_shipdate DESC) = 1"""


def rollup(items: str) -> str:
    return f"""
SELECT order_id, count(*) AS item_count, CAST(sum(line_total) AS DECIMAL(18,2)) AS gross_revenue
FROM ({items}) GROUP BY order_id"""


def new_customers(orders: str) -> str:
    return f"""
SELECT report_date, count(*) AS new_customers
FROM (SELECT customer_id, CAST(min(created_at) AS DATE) AS report_date
      FROM ({orders}) WHERE {REVENUE} GROUP BY customer_id)
GROUP BY report_date"""


def daily_revenue(orders: str, items: str = ITEMS) -> str:
    return f"""
SELECT d.report_date, d.currency, d.order_count, d.item_count, d.gross_revenue,
  d.gross_revenue AS net_revenue, {average('d.gross_revenue', 'd.order_count')} AS avg_order_value,
  CAST(coalesce(n.new_customers, 0) AS BIGINT) AS new_customers
FROM (
  SELECT CAST(o.created_at AS DATE) AS report_date, 'USD' AS currency, count(*) AS order_count,
    CAST(coalesce(sum(r.item_count), 0) AS BIGINT) AS item_count,
    CAST(sum(coalesce(r.gross_revenue, o.total_amount)) AS DECIMAL(18,2)) AS gross_revenue
  FROM ({orders}) o LEFT JOIN ({rollup(items)}) r ON o.order_id = r.order_id
  WHERE o.{REVENUE} GROUP BY 1) d
LEFT JOIN ({new_customers(orders)}) n ON d.report_date = n.report_date"""


def order_stats(orders: str) -> str:
    return f"""
SELECT customer_id, count(*) AS total_orders,
  CAST(sum(total_amount) AS DECIMAL(18,2)) AS total_revenue,
  CAST(min(created_at) AS DATE) AS first_order_date, CAST(max(created_at) AS DATE) AS last_order_date
FROM ({orders}) WHERE {REVENUE} GROUP BY customer_id"""


def customer_metrics(orders: str, customers: str, as_of: str = AS_OF) -> str:
    days = f"date_diff('day', s.last_order_date, DATE '{as_of}')"
    return f"""
SELECT c.customer_id, CAST(NULL AS VARCHAR) AS country_code, CAST(NULL AS VARCHAR) AS segment,
  s.first_order_date, s.last_order_date, CAST(coalesce(s.total_orders, 0) AS BIGINT) AS total_orders,
  CAST(coalesce(s.total_revenue, 0) AS DECIMAL(18,2)) AS total_revenue,
  CAST(coalesce({average('s.total_revenue', 's.total_orders')}, 0) AS DECIMAL(18,2))
    AS avg_order_value,
  CAST({days} AS INTEGER) AS days_since_last_order, coalesce({days} > 90, false) AS is_churned
FROM ({customers}) c LEFT JOIN ({order_stats(orders)}) s ON c.customer_id = s.customer_id"""


DAILY = daily_revenue(S_ORDERS)
METRICS = customer_metrics(S_ORDERS, S_CUSTOMERS)
G_DAILY = f"SELECT *, TIMESTAMP '{RUN_TS}' AS computed_at FROM ({DAILY})"
G_METRICS = f"SELECT *, TIMESTAMP '{RUN_TS}' AS computed_at FROM ({METRICS})"

METRIC_COLUMNS = (
    "country_code segment first_order_date last_order_date total_orders total_revenue avg_order_value "
    "days_since_last_order is_churned"
).split()


def parity(first: str, second: str, key: str, columns: list[str]) -> str:
    sides = f"FROM ({first}) a FULL JOIN ({second}) b ON a.{key} = b.{key}"
    counts = {"only in first": f"b.{key} IS NULL", "only in second": f"a.{key} IS NULL"}
    counts |= {c: f"a.{key} IS NOT NULL AND b.{key} IS NOT NULL AND a.{c} IS DISTINCT FROM b.{c}" for c in columns}
    return " UNION ALL ".join(
        f"""SELECT '{name}' AS "column", count(*) FILTER ({where}) AS "rows" {sides}""" for name, where in counts.items()
    )


# Order change log: one row per record, images as text and as values

O_BASE = f"""
SELECT o_orderkey AS k, CAST(o_custkey AS VARCHAR) AS customer, {STATUS} AS final,
  CAST(o_totalprice AS DECIMAL(18,2)) AS amount, o_orderdate AS created,
  epoch_ms(o_orderdate) AS t0
FROM orders"""


def order_image(status: str, amount: str, seconds: int) -> str:
    return (
        f"'{{\"order_id\":' || k || ',\"customer_id\":' || customer || ',\"status\":\"' || {status} || "
        f"'\",\"total_amount\":\"' || {amount} || '\",\"created_at\":\"' || {iso('created')} || "
        f"'\",\"updated_at\":\"' || {iso(f'created + to_seconds({seconds})')} || '\"}}'"
    )


def order_version(i: int, op: str, delay: str, before, after, where: str) -> str:
    """A version; an image is (status, amount, seconds), and NULL amounts are broken ones."""
    cells = []
    for image, tag in ((before, "b"), (after, "a")):
        if image is None:
            cells += [
                f"CAST(NULL AS VARCHAR) AS {tag}_text",
                f"CAST(NULL AS VARCHAR) AS {tag}_status",
                f"CAST(NULL AS DECIMAL(18,2)) AS {tag}_amount",
                f"CAST(NULL AS TIMESTAMP) AS {tag}_updated",
            ]
        else:
            status, amount, seconds = image
            text = "'abc'" if amount is None else f"CAST({amount} AS VARCHAR)"
            value = "CAST(NULL AS DECIMAL(18,2))" if amount is None else f"CAST({amount} AS DECIMAL(18,2))"
            cells += [
                f"{order_image(status, text, seconds)} AS {tag}_text",
                f"{status} AS {tag}_status",
                f"{value} AS {tag}_amount",
                f"created + to_seconds({seconds}) AS {tag}_updated",
            ]
    return (
        f"SELECT k, customer, created, {i} AS i, {op} AS op, {delay} AS ts_ms, {', '.join(cells)} "
        f"FROM base WHERE {where}"
    )


OPENED = ("'pending'", "CAST(0 AS DECIMAL(18,2))", 0)
PRICED = ("'pending'", "amount", 0)
BROKEN = ("'pending'", None, 30)
SETTLED = ("final", "amount", 60)

O_LOG = " UNION ALL ".join(
    [
        order_version(0, "CASE WHEN k % 7 = 0 THEN 'r' ELSE 'c' END", "t0", None, OPENED, "true"),
        order_version(1, "'u'", "t0", OPENED, PRICED, "true"),
        order_version(2, "'u'", "t0 + 30000", PRICED, BROKEN, "k % 101 = 0"),
        order_version(3, "'u'", "t0 + 60000", PRICED, SETTLED, "final <> 'pending' AND k % 101 <> 0"),
        order_version(3, "'u'", "t0 + 60000", BROKEN, SETTLED, "final <> 'pending' AND k % 101 = 0"),
        *(
            order_version(i, op, delay, image, None, f"{often} AND {where}")
            for i, op, delay, often in ((4, "'d'", "t0 + 120000", "k % 10 = 0"), (7, "'u'", "t0 + 90000", "k % 103 = 0"))
            for image, where in (
                (SETTLED, "final <> 'pending'"),
                (PRICED, "final = 'pending' AND k % 101 <> 0"),
                (BROKEN, "final = 'pending' AND k % 101 = 0"),
            )
        ),
        order_version(6, "CAST(NULL AS VARCHAR)", "CAST(NULL AS BIGINT)", None, None, "k % 97 = 0"),
    ]
)
O_COPIES = order_version(1, "'u'", "t0", OPENED, PRICED, "k % 13 = 0")


def order_log(copies: bool = True) -> str:
    log = f"{O_LOG} UNION ALL {O_COPIES}" if copies else O_LOG
    return f"""
SELECT *, 'cdc.orders' AS topic, CAST(k % 3 AS INTEGER) AS "partition", 8 * k + i AS "offset"
FROM (WITH base AS ({O_BASE}) {log})"""


O_BRONZE = f"""
SELECT {uuid_of("topic || ':' || \"partition\" || ':' || \"offset\"")} AS cdc_id, op, ts_ms,
  CASE WHEN op IS NOT NULL THEN 'shop' END AS source_db,
  CASE WHEN op IS NOT NULL THEN 'orders' END AS source_table,
  CASE WHEN op IS NOT NULL THEN k END AS txn_id, b_text AS before, a_text AS after,
  TIMESTAMP '{RUN_TS}' AS ingested_at, topic, "partition", "offset"
FROM ({order_log()})"""


def order_state(where: str, as_of_ms: int | None = None) -> str:
    """Orders as the log leaves them: opened and priced, then settled, then perhaps deleted."""
    limit = "9223372036854775807" if as_of_ms is None else str(as_of_ms)
    moved = f"final <> 'pending' AND t0 + 60000 <= {limit}"
    return f"""
SELECT CAST(k AS VARCHAR) AS order_id, customer AS customer_id,
  CASE WHEN {moved} THEN final ELSE 'pending' END AS status, amount AS total_amount,
  CAST(NULL AS VARCHAR) AS currency, created AS created_at,
  CASE WHEN {moved} THEN created + to_seconds(60) ELSE created END AS updated_at,
  'u' AS _source_op
FROM ({O_BASE}) WHERE t0 <= {limit} AND ({where})"""


LIVE_ORDERS = order_state("k % 10 <> 0")

C_STATE = f"""
SELECT CAST(c_custkey AS VARCHAR) AS customer_id, c_name AS name,
  CASE WHEN c_custkey % 3 = 0 THEN 'new.' ELSE '' END || {EMAIL} AS email,
  {CUSTOMER_CREATED} AS created_at,
  {CUSTOMER_CREATED} + to_days(CASE WHEN c_custkey % 3 = 0 THEN 1 ELSE 0 END) AS updated_at,
  CASE WHEN c_custkey % 3 = 0 THEN 'u' WHEN c_custkey % 7 = 0 THEN 'r' ELSE 'c' END AS _source_op
FROM customer WHERE c_custkey % 20 <> 0"""


def customer_change(i: int, op: str, days: int, after: bool, where: str) -> str:
    return f"""
SELECT 4 * c_custkey + {i} AS "offset", {op} AS op,
  epoch_ms({CUSTOMER_CREATED}) + {days} * 86400000 AS ts_ms, {after} AS has_after
FROM customer WHERE {where}"""


C_LOG = " UNION ALL ".join(
    [
        customer_change(0, "CASE WHEN c_custkey % 7 = 0 THEN 'r' ELSE 'c' END", 0, True, "true"),
        customer_change(1, "'u'", 1, True, "c_custkey % 3 = 0"),
        customer_change(2, "'d'", 2, False, "c_custkey % 20 = 0"),
    ]
)

# Windows


def windows(rows: str, time: str, amount: str) -> str:
    return f"""
SELECT window_start, window_start + to_minutes(1) AS window_end, order_count, total_revenue,
  {average('total_revenue', 'order_count', 12)} AS avg_order_value
FROM (SELECT date_trunc('minute', {time}) AS window_start, count(*) AS order_count,
        CAST(sum({amount}) AS DECIMAL(14,2)) AS total_revenue
      FROM ({rows}) GROUP BY 1)"""


EVENTS = """
SELECT event_id, ts, user_id AS member, event_type AS series,
  CAST("value" AS DECIMAL(18,2)) AS "value" FROM events"""
MINUTE_EVENTS = f"SELECT * REPLACE (date_trunc('minute', ts) AS ts) FROM ({EVENTS})"
EVENT_WINDOWS = windows(EVENTS, "ts", '"value"')
# An order whose last image is broken counts in no window until its next good change.
COUNTED_ORDERS = order_state("k % 10 <> 0 AND NOT (final = 'pending' AND k % 101 = 0)")
ORDER_WINDOWS = windows(COUNTED_ORDERS, "updated_at", "total_amount")

# Metrics


def increase(series: str, every: str, events: str = EVENTS) -> str:
    return f"""
SELECT {series}, time_bucket(INTERVAL '{every}', ts) AS window_start, count(*) AS samples,
  CAST(sum(CASE WHEN prev IS NULL THEN 0 WHEN "value" >= prev THEN "value" - prev ELSE "value" END)
    AS DECIMAL(18,2)) AS increase
FROM (SELECT *, lag("value") OVER (PARTITION BY {series} ORDER BY ts, event_id) AS prev FROM ({events}))
GROUP BY {series}, time_bucket(INTERVAL '{every}', ts)"""


HOURLY = increase("series", "1 hour", MINUTE_EVENTS)
BUSY = f"SELECT series, window_start FROM ({HOURLY}) WHERE samples >= 5"
RISING = f"SELECT series, window_start FROM ({HOURLY}) WHERE increase > 250"

# Expectations

BRONZE_COLUMNS = "cdc_id, op, ts_ms, source_db, source_table, txn_id, before, after, ingested_at"

TABLE_SQL = {
    "raw.kafka_events": f"""
SELECT {uuid_of("'raw.events:' || (event_id % 3) || ':' || (event_id // 3)")} AS event_id,
  'raw.events' AS topic, CAST(event_id % 3 AS INTEGER) AS "partition", event_id // 3 AS "offset",
  ts AS event_ts, TIMESTAMP '{RUN_TS}' AS ingested_at, CAST(user_id AS VARCHAR) AS msg_key,
  props AS payload
FROM events""",
    "raw.cdc_orders": f"SELECT {BRONZE_COLUMNS} FROM ({O_BRONZE})",
    "raw.cdc_customers": f"""
SELECT {uuid_of("CAST(\"offset\" AS VARCHAR)")} AS cdc_id, op, ts_ms, 'shop' AS source_db,
  'customers' AS source_table, "offset" // 4 AS txn_id, CAST(NULL AS VARCHAR) AS before,
  CASE WHEN has_after THEN 'image' END AS after, TIMESTAMP '{RUN_TS}' AS ingested_at
FROM ({C_LOG})""",
    "raw.cdc_order_items": f"""
SELECT {uuid_of("item_id || l_shipdate")} AS cdc_id, 'c' AS op, epoch_ms(l_shipdate) AS ts_ms,
  'shop' AS source_db, 'order_items' AS source_table, 0 AS txn_id, CAST(NULL AS VARCHAR) AS before,
  'image' AS after, TIMESTAMP '{RUN_TS}' AS ingested_at
FROM ({ITEMS})""",
    "silver.orders": S_ORDERS,
    "silver.customers": S_CUSTOMERS,
    "silver.order_items": S_ITEMS,
    "gold.daily_revenue": G_DAILY,
    "gold.customer_metrics": G_METRICS,
}


def literal(value: object) -> str:
    if isinstance(value, bool):
        return str(value).lower()
    return f"'{value}'" if isinstance(value, str) else str(value)


def inside(value: str, e: Expectation) -> str:
    parts = [f"{value} >= {literal(e.low)}"] if e.low is not None else []
    parts += [f"{value} <= {literal(e.high)}"] if e.high is not None else []
    return " AND ".join(parts)


def expectation_sql(e: Expectation, names: list[str]) -> str:
    """``evaluated, unexpected, success`` of one expectation over table ``t``."""
    one = "SELECT 1 AS evaluated, CASE WHEN ok THEN 0 ELSE 1 END AS unexpected, ok AS success FROM "
    cols = [f'"{c}"' for c in e.columns]
    if e.kind == "columns":
        return one + f"(SELECT {literal(tuple(names) == e.columns)} AS ok)"
    if e.kind == "row_count":
        return one + f"(SELECT {inside('count(*)', e)} AS ok FROM t)"
    if e.kind == "max_between":
        return one + f"(SELECT coalesce({inside(f'max({cols[0]})', e)}, false) AS ok FROM t)"
    if e.kind in ("unique", "compound_unique", "unique_share"):
        keys = ", ".join(cols)
        groups = (
            f"(SELECT count(*) AS n FROM t WHERE coalesce({', '.join(f'CAST({c} AS VARCHAR)' for c in cols)}) "
            f"IS NOT NULL GROUP BY {keys})"
        )
        if e.kind == "unique_share":
            return (
                f"SELECT coalesce(sum(n), 0) AS evaluated, coalesce(sum(n), 0) - count(*) AS unexpected, "
                f"{inside('count(*) / sum(n)', e)} AS success FROM {groups}"
            )
        return (
            "SELECT coalesce(sum(n), 0) AS evaluated, coalesce(sum(n) FILTER (n > 1), 0) AS unexpected, "
            f"coalesce(max(n), 0) <= 1 AS success FROM {groups}"
        )
    good = {
        "not_null": f"{cols[0]} IS NOT NULL",
        "matches": f"regexp_matches({cols[0]}, '{e.pattern}')",
        "in_set": f"{cols[0]} IN ({', '.join(map(literal, e.values))})",
        "between": inside(cols[0], e),
        "length_between": inside(f"length({cols[0]})", e),
        "at_least": f"{cols[0]} >= {cols[-1]}",
    }[e.kind]
    return (
        "SELECT evaluated, unexpected, evaluated = 0 OR "
        f"(evaluated - unexpected) / evaluated >= {e.mostly}::DOUBLE AS success FROM "
        f"(SELECT count({good}) AS evaluated, count(*) FILTER (NOT ({good})) AS unexpected FROM t)"
    )


COLUMN_LISTS = {
    name: list(next(e.columns for e in rules if e.kind == "columns")) for name, rules in SUITES.items()
}


def suite_sql(name: str) -> str:
    parts = []
    for position, e in enumerate(SUITES[name]):
        parts.append(
            f"SELECT '{name}' AS suite, {position} AS position, '{e.kind}' AS expectation, "
            f"'{e.label}' AS \"column\", CAST(evaluated AS BIGINT) AS evaluated, "
            f"CAST(unexpected AS BIGINT) AS unexpected, CAST(success AS BOOLEAN) AS success "
            f"FROM ({expectation_sql(e, COLUMN_LISTS[name])})"
        )
    return f"WITH t AS MATERIALIZED ({TABLE_SQL[name]}) " + " UNION ALL ".join(parts)


CHURN_CHECK = f"""
SELECT 'gold.customer_metrics' AS suite, count(*) = 0 AS success, 'churn_consistency' AS expectation,
  'days_since_last_order,is_churned' AS "column"
FROM ({METRICS}) WHERE days_since_last_order > 90 AND NOT is_churned"""


def layer_results(layers) -> str:
    parts = [
        f"SELECT '{layer}' AS layer, suite, success, expectation, \"column\" FROM ({suite_sql(name)})"
        for layer in layers
        for name in LAYERS[layer]
    ]
    parts.append(f"SELECT 'gold' AS layer, suite, success, expectation, \"column\" FROM ({CHURN_CHECK})")
    return " UNION ALL ".join(parts)


STATISTICS = """count(*) AS evaluated, count(*) FILTER (success) AS passed,
  count(*) FILTER (NOT success) AS failed, bool_and(success) AS success"""


def model_test(model: str, test: str, column: str, failures: str) -> str:
    return (
        f"SELECT '{model}' AS model, '{test}' AS test, '{column}' AS \"column\", failures, "
        f"failures = 0 AS success FROM (SELECT count(*) AS failures FROM {failures})"
    )


MODEL_TESTS = " UNION ALL ".join(
    [
        model_test("daily_revenue", "not_null", c, f"({DAILY}) WHERE {c} IS NULL")
        for c in ("report_date", "currency", "order_count", "net_revenue")
    ]
    + [
        model_test("customer_metrics", "not_null", c, f"({METRICS}) WHERE {c} IS NULL")
        for c in ("customer_id", "total_orders", "is_churned")
    ]
    + [
        model_test(
            "customer_metrics",
            "unique",
            "customer_id",
            f"(SELECT customer_id FROM ({METRICS}) GROUP BY 1 HAVING count(*) > 1)",
        ),
        model_test(
            "customer_metrics",
            "relationships",
            "customer_id",
            f"({METRICS}) WHERE customer_id NOT IN (SELECT customer_id FROM ({S_CUSTOMERS}))",
        ),
        model_test(
            "daily_revenue",
            "unique_grain",
            "report_date,currency",
            f"(SELECT 1 FROM ({DAILY}) GROUP BY report_date, currency HAVING count(*) > 1)",
        ),
    ]
)

RATES = """
SELECT 'exchange_rate' AS event_type, n_name AS base, q.currency,
  round((c_custkey * 7 + q.n) / 8.0::DOUBLE, 6) AS rate,
  strftime(DATE '1995-01-01' + CAST(c_custkey AS INTEGER), '%Y-%m-%d') AS rate_date,
  '{run}' AS fetched_at
FROM customer JOIN nation ON c_nationkey = n_nationkey,
  (VALUES ('USD', 1), ('GBP', 2), ('CHF', 3), ('JPY', 4), ('CAD', 5)) q(currency, n)""".replace(
    "{run}", RUN_TS
)

TRANSITIONS = f"""
SELECT CAST(k AS VARCHAR) AS order_id, "partition", "offset", ts_ms, b_status AS previous,
  a_status AS status
FROM ({order_log(copies=False)})
WHERE op = 'u' AND a_amount IS NOT NULL AND b_status <> a_status
  AND (b_status, a_status) NOT IN (('pending', 'confirmed'), ('pending', 'cancelled'),
    ('confirmed', 'shipped'), ('confirmed', 'cancelled'), ('shipped', 'delivered'),
    ('delivered', 'completed'))"""

LOGGED_TRANSITIONS = f"""
SELECT CAST(k AS VARCHAR) AS order_id, "partition", "offset", ts_ms, previous, status
FROM (SELECT *, a_status AS status,
        lag(a_status) OVER (PARTITION BY k ORDER BY ts_ms, "offset") AS previous
      FROM ({order_log(copies=False)}) WHERE op IN ('c', 'r', 'u') AND a_amount IS NOT NULL)
WHERE previous <> status
  AND (previous, status) NOT IN (('pending', 'confirmed'), ('pending', 'cancelled'),
    ('confirmed', 'shipped'), ('confirmed', 'cancelled'), ('shipped', 'delivered'),
    ('delivered', 'completed'))"""

UNFOLDED = " UNION ALL ".join(
    f"""
SELECT "partition", "offset", op, {sign} AS sign, CAST(k AS VARCHAR) AS order_id,
  customer AS customer_id, {tag}_status AS status, {tag}_amount AS total_amount,
  {tag}_updated AS updated_at
FROM ({order_log()}) WHERE {tag}_amount IS NOT NULL AND i <> 7"""
    for sign, tag in ((-1, "b"), (1, "a"))
)

SUSTAINED = f"""
SELECT series, min(ts) AS started_at, max(ts) AS ended_at, count(*) AS samples
FROM (SELECT *, row_number() OVER (PARTITION BY series ORDER BY ts, event_id)
          - row_number() OVER (PARTITION BY series, "value" > 30 ORDER BY ts, event_id) AS stretch
      FROM ({MINUTE_EVENTS}))
WHERE "value" > 30 GROUP BY series, stretch
HAVING max(ts) - min(ts) >= INTERVAL '1 hour'"""


def hourly_sum(series: str) -> str:
    return f"""SELECT date_trunc('hour', ts) AS window_start, CAST(sum("value") AS DECIMAL(18,2)) AS v
FROM ({EVENTS}) WHERE series = '{series}' GROUP BY 1"""


ORACLE: dict[str, str] = {
    "revenue_orders": f"""
SELECT order_id, customer_id, status, total_amount, created_at FROM ({S_ORDERS}) WHERE {REVENUE}""",
    "line_total": f"SELECT item_id, quantity, unit_price, line_total FROM ({ITEMS})",
    "order_item_rollup": rollup(ITEMS),
    "new_customers_per_day": new_customers(S_ORDERS),
    "gold_daily_revenue": DAILY,
    "gold_customer_metrics": METRICS,
    "recency_churn": f"""
SELECT customer_id, last_order_date,
  CAST(date_diff('day', last_order_date, DATE '{AS_OF}') AS INTEGER) AS days_since_last_order,
  date_diff('day', last_order_date, DATE '{AS_OF}') > 90 AS is_churned
FROM ({order_stats(S_ORDERS)})""",
    "latest_per_key": """
SELECT l_orderkey, l_linenumber, l_shipdate, l_partkey, l_suppkey, l_extendedprice
FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
  ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC) = 1""",
    "cdc_envelope_parse": f"SELECT * EXCLUDE (ingested_at) FROM ({O_BRONZE})",
    "cdc_quarantine": f"""
SELECT "partition", "offset", op, ts_ms,
  CASE i WHEN 2 THEN 'bad total_amount' WHEN 6 THEN 'unreadable envelope' ELSE 'missing after' END
    AS reason
FROM ({order_log()}) WHERE i IN (2, 6, 7)""",
    "bronze_redelivery_dedup": f"""
SELECT "partition", "offset", op, ts_ms FROM ({order_log(copies=False)})""",
    "bronze_ingest_resume": f"""
SELECT op, ts_ms, txn_id, "partition", "offset"
FROM (SELECT op, ts_ms, CASE WHEN op IS NOT NULL THEN k END AS txn_id, "partition", "offset"
      FROM ({order_log(copies=False)}))""",
    "bronze_ledger": f"""
SELECT op, ts_ms, CASE WHEN op IS NOT NULL THEN k END AS txn_id, "partition", "offset"
FROM ({order_log(copies=False)})""",
    "bronze_ledger_intervals": f"""
SELECT "partition", min("offset") AS first_offset, max("offset") AS last_offset
FROM (SELECT "partition", "offset", "offset" - row_number() OVER (PARTITION BY "partition" ORDER BY "offset") AS island
      FROM ({order_log(copies=False)}))
GROUP BY "partition", island""",
    "changelog_unfold": UNFOLDED,
    "silver_orders": LIVE_ORDERS,
    "silver_orders_ignore_deletes": order_state("true"),
    "silver_orders_as_of": order_state(
        f"k % 10 <> 0 OR t0 + 120000 > {AS_OF_MS}", AS_OF_MS
    ),
    "silver_orders_history": " UNION ALL ".join(
        f"""
SELECT CAST({t} AS BIGINT) AS as_of, order_id, customer_id, status, total_amount, updated_at
FROM ({order_state(f"k % 10 <> 0 OR t0 + 120000 > {t}", t)})"""
        for t in (*BATCH_BOUNDS, 4102444800000)
    ),
    "items_with_order_status": f"""
SELECT CAST(l_orderkey AS VARCHAR) AS order_id, l_linenumber AS line, epoch_ms(l_shipdate) AS shipped_ms,
  CASE WHEN epoch_ms(l_shipdate) < t0 THEN NULL WHEN epoch_ms(l_shipdate) = t0 THEN 'pending'
    WHEN k % 10 = 0 THEN NULL ELSE final END AS status
FROM lineitem LEFT JOIN ({O_BASE}) o ON l_orderkey = k""",
    "silver_customers": C_STATE,
    "silver_order_items": f"""
SELECT i.item_id, i.order_id, i.product_id, i.quantity, i.unit_price, i.line_total,
  o.created_at AS order_created_at
FROM ({LATEST_ITEMS}) i
LEFT JOIN ({LIVE_ORDERS}) o ON i.order_id = o.order_id""",
    "silver_upsert": f"""
SELECT order_id, customer_id, status, total_amount, updated_at, _source_op AS op
FROM ({LIVE_ORDERS})""",
    "status_transition_audit": LOGGED_TRANSITIONS,
    "status_transition_audit_images": TRANSITIONS,
    "silver_incremental": LIVE_ORDERS,
    "gold_daily_incremental": daily_revenue(LIVE_ORDERS, LATEST_ITEMS),
    "gold_customers_incremental": customer_metrics(LIVE_ORDERS, C_STATE),
    "gold_daily_revenue_from_log": daily_revenue(LIVE_ORDERS, LATEST_ITEMS),
    "gold_customer_metrics_from_log": customer_metrics(LIVE_ORDERS, C_STATE),
    "bronze_kafka_events": f"SELECT * EXCLUDE (ingested_at) FROM ({TABLE_SQL['raw.kafka_events']})",
    "stream_bronze_append": f"SELECT * EXCLUDE (ingested_at) FROM ({TABLE_SQL['raw.kafka_events']})",
    "stream_bronze_cdc": f"""
SELECT cdc_id, op, ts_ms, txn_id, "partition", "offset" FROM ({O_BRONZE})""",
    "partition_layout": """
SELECT CAST(date_trunc('month', ts) AS DATE) AS event_month, CAST(ts AS DATE) AS event_day,
  'raw.events' AS topic, count(*) AS row_count FROM events GROUP BY 1, 2""",
    "fx_rates_to_events": RATES,
    "fx_messages": f"""
SELECT currency AS key, '{{"event_type":"' || event_type || '","base":"' || base
  || '","currency":"' || currency || '","rate":' || rate || ',"rate_date":"' || rate_date
  || '","fetched_at":"' || fetched_at || '"}}' AS value, 'raw.events' AS topic
FROM ({RATES})""",
    "serving_daily_trend": f"""
SELECT report_date, order_count, net_revenue, avg_order_value, new_customers
FROM ({DAILY}) ORDER BY report_date""",
    "serving_top_customers": f"""
SELECT customer_id, total_orders, total_revenue, avg_order_value, days_since_last_order, is_churned
FROM ({METRICS}) ORDER BY total_revenue DESC, customer_id LIMIT 10""",
    "serving_totals": f"""
SELECT CAST(sum(net_revenue) AS DECIMAL(18,2)) AS total_revenue,
  CAST(sum(order_count) AS BIGINT) AS total_orders FROM ({DAILY})""",
    "serving_churn_rate": f"""
SELECT avg(CASE WHEN is_churned THEN 1e0 ELSE 0e0 END) AS rate FROM ({METRICS})""",
    "serving_recent_windows": f"""
SELECT * FROM ({EVENT_WINDOWS})
WHERE window_start >= (SELECT date_trunc('minute', max(ts)) FROM events) - INTERVAL '6 hours'
ORDER BY window_start DESC LIMIT 60""",
    "serving_latest_window": f"SELECT * FROM ({EVENT_WINDOWS}) ORDER BY window_start DESC LIMIT 1",
    "latest_window_emission": f"""
SELECT date_trunc('minute', ts) AS window_start, event_id AS "offset",
  CAST("value" AS DECIMAL(14,2)) AS total_revenue
FROM ({EVENTS})
QUALIFY row_number() OVER (PARTITION BY date_trunc('minute', ts) ORDER BY event_id DESC) = 1""",
    **{
        "dq_suite_" + name.replace("raw.", "bronze_").replace(".", "_"): suite_sql(name)
        for name in SUITES
    },
    "dq_suite_incremental": suite_sql("raw.cdc_orders"),
    "dq_gate_summary": f"""
WITH results AS ({layer_results(LAYERS)})
SELECT layer, {STATISTICS} FROM results GROUP BY layer
UNION ALL SELECT 'all', {STATISTICS} FROM results""",
    "dq_suite_summary": f"""
SELECT suite, {STATISTICS},
  coalesce(string_agg(expectation || ' ' || "column", '; ' ORDER BY expectation || ' ' || "column")
    FILTER (NOT success), '') AS failures
FROM ({layer_results(('silver', 'gold'))}) GROUP BY suite""",
    "dq_unique_grain": """
SELECT l_orderkey, l_linenumber, count(*) AS row_count FROM lineitem GROUP BY 1, 2
HAVING count(*) > 1""",
    "dq_relationships": f"""
SELECT CAST(o_custkey AS VARCHAR) AS customer_id, count(*) AS row_count FROM orders
WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_custkey % 20 <> 0) GROUP BY 1""",
    "dq_churn_consistency": f"""
SELECT count(*) AS violations FROM ({METRICS}) WHERE days_since_last_order BETWEEN 91 AND 120""",
    "dq_model_tests": MODEL_TESTS,
    "gold_parity": parity(
        f"SELECT * FROM ({METRICS}) WHERE CAST(customer_id AS BIGINT) % 50 <> 7",
        f"SELECT * FROM ({customer_metrics(S_ORDERS, S_CUSTOMERS, PARITY_AS_OF)}) WHERE CAST(customer_id AS BIGINT) % 70 <> 3",
        "customer_id",
        METRIC_COLUMNS,
    ),
    "smoke_checks": " UNION ALL ".join(
        f"SELECT '{name} is non-empty' AS \"check\", count(*) AS value, count(*) > 0 AS success FROM ({sql})"
        for name, sql in (("gold.daily_revenue", DAILY), ("gold.customer_metrics", METRICS))
    ),
    "contract_orders": f"""
SELECT "partition", "offset", 'total_amount' AS field, 'type' AS rule
FROM ({order_log(copies=False)}) WHERE i = 2""",
    "contract_customers": """
SELECT CAST(c_custkey % 3 AS INTEGER) AS "partition", 4 * c_custkey + 1 AS "offset",
  'phone' AS field, 'unexpected' AS rule FROM customer WHERE c_custkey % 3 = 0""",
    "contract_order_items": """
SELECT 'item_id' AS field, 'type' AS rule, count(*) AS images FROM lineitem""",
    "schema_evolution": f"""
SELECT f.field, CASE WHEN f.field = 'phone' THEN phones ELSE images END AS records,
  CAST(0 AS BIGINT) AS mistyped,
  CASE WHEN f.field = 'phone' THEN 'added' ELSE 'unchanged' END AS change, true AS compatible
FROM (SELECT count(*) FILTER (has_after) AS images, count(*) FILTER (op = 'u') AS phones
      FROM ({C_LOG})),
  (VALUES ('customer_id'), ('name'), ('email'), ('created_at'), ('updated_at'), ('phone')) f(field)""",
    "freshness": f"""
SELECT count(*) AS windows, count(*) FILTER (us < 120000000) AS in_time,
  count(*) FILTER (us >= 120000000) AS late, max(us) AS longest_us
FROM (SELECT CAST(max("value") * 1000000 AS BIGINT) AS us FROM ({EVENTS})
      GROUP BY date_trunc('minute', ts))""",
    "stream_tumbling_1m": f"""
SELECT * FROM ({EVENT_WINDOWS})
WHERE window_end <= (SELECT max(ts) FROM events) - INTERVAL '5 seconds'""",
    "batch_order_revenue_1m": ORDER_WINDOWS,
    "stream_order_revenue_1m": f"""
SELECT * FROM ({ORDER_WINDOWS})
WHERE window_end <= (SELECT max(updated_at) FROM ({order_state('true')})) - INTERVAL '5 seconds'""",
    "stream_order_revenue_late": f"""
SELECT * FROM ({windows(LIVE_ORDERS, "updated_at", "total_amount")})
WHERE window_end <= (SELECT max(updated_at) FROM ({LIVE_ORDERS})) - INTERVAL '5 seconds'""",
    "metric_rate": f"""
SELECT *, CAST(increase AS DOUBLE) / 3600.0::DOUBLE AS rate FROM ({HOURLY})""",
    "metric_increase_above": f"""
SELECT series, window_start, increase FROM ({HOURLY}) WHERE increase > 250""",
    "metric_sum_by": f"""
SELECT series, window_start, CAST(sum(increase) AS DECIMAL(18,2)) AS increase
FROM ({increase('series, member', '1 day')}) GROUP BY 1, 2""",
    "metric_sustained_alert": SUSTAINED,
    "metric_absent": f"""
SELECT s.series, w.window_start
FROM (SELECT DISTINCT series FROM ({EVENTS})) s,
  (SELECT unnest(generate_series(TIMESTAMP '2024-01-01', TIMESTAMP '2024-01-30 23:00:00',
    INTERVAL '1 hour')) AS window_start) w
WHERE NOT EXISTS (SELECT 1 FROM ({EVENTS}) e
  WHERE e.series = s.series AND date_trunc('hour', e.ts) = w.window_start)""",
    "metric_topk": f"""
SELECT series, member, CAST(sum(increase) AS DECIMAL(18,2)) AS increase
FROM ({increase('series, member', '1 hour')}) GROUP BY 1, 2
ORDER BY increase DESC, series, member LIMIT 10""",
    "metric_ratio": f"""
SELECT p.window_start, p.v AS numerator, v.v AS denominator,
  CAST(p.v AS DOUBLE) / CAST(v.v AS DOUBLE) AS ratio
FROM ({hourly_sum('purchase')}) p JOIN ({hourly_sum('view')}) v ON p.window_start = v.window_start
WHERE v.v <> 0 AND CAST(p.v AS DOUBLE) / CAST(v.v AS DOUBLE) < 0.1""",
    "metric_staleness": f"""
SELECT series, member, max(ts) AS last_ts,
  epoch_us(TIMESTAMP '2024-01-31 00:00:00') - epoch_us(max(ts)) AS idle_us
FROM ({EVENTS}) GROUP BY 1, 2""",
    "metric_both": f"{BUSY} INTERSECT {RISING}",
    "metric_either": f"{BUSY} UNION {RISING}",
}
