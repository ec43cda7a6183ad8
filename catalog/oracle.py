"""The SQL each registered query is compared with, composed of common table expressions.

The SQL states the expected result directly, in its own way: the full mart, a range join
for the lookback, a full outer join for the segment changes, a recursive query for the
cooldown.
"""

from __future__ import annotations

KPIS = ("revenue", "orders", "aov", "payment_fail_rate")
DIMS = ("customer_state", "product_category_name", "payment_type")
EVENTS = (
    (0, "revenue", "1998-06-01", 2, 0.60, "Revenue shock (simulated outage)"),
    (1, "orders", "1998-03-20", 3, 1.35, "Orders spike (simulated promo)"),
)


def r(expr: str, places: int = 6) -> str:
    """Rounded, with no negative zero."""
    return f"CASE WHEN round({expr}, {places}) = 0 THEN 0.0::DOUBLE ELSE round({expr}, {places}) END"


RAW = """
r_orders AS (
  SELECT o_orderkey AS order_id, o_custkey AS customer_id,
         CASE WHEN o_orderstatus = 'P' THEN 'canceled' ELSE 'delivered' END AS order_status,
         o_orderdate AS order_purchase_timestamp
  FROM orders),
r_customers AS (
  SELECT c_custkey AS customer_id, n_name AS customer_state
  FROM customer JOIN nation ON c_nationkey = n_nationkey),
r_items AS (
  SELECT l_orderkey AS order_id, l_partkey AS product_id, l_extendedprice AS price,
         floor(l_extendedprice * l_tax * 100.0::DOUBLE + 0.5::DOUBLE) / 100.0::DOUBLE AS freight_value
  FROM lineitem),
r_products AS (
  SELECT p_partkey AS product_id,
         CASE WHEN p_size <= 2 THEN NULL ELSE p_type END AS product_category_name
  FROM part),
r_payments AS (
  SELECT o_orderkey AS order_id, substr(o_orderpriority, 3) AS payment_type,
         o_totalprice AS payment_value
  FROM orders WHERE o_orderkey % 97 <> 0
  UNION ALL
  SELECT o_orderkey, 'voucher', 10.0::DOUBLE FROM orders WHERE o_orderkey % 10 = 0),
mart AS (
  SELECT o.order_id, CAST(o.order_purchase_timestamp AS TIMESTAMP) AS purchase_ts,
         CAST(o.order_purchase_timestamp AS DATE) AS purchase_date, o.order_status,
         c.customer_state, i.product_id, i.price, i.freight_value,
         p.product_category_name, y.payment_type, y.payment_value
  FROM r_orders o
  JOIN r_customers c ON c.customer_id = o.customer_id
  JOIN r_items i ON i.order_id = o.order_id
  LEFT JOIN r_products p ON p.product_id = i.product_id
  LEFT JOIN r_payments y ON y.order_id = o.order_id)"""


def kpi(series: str = "'all'") -> str:
    return f"""
sums AS (
  SELECT {series} AS series_id, purchase_date AS ds,
         round(sum(CASE WHEN order_status = 'delivered' THEN price + freight_value ELSE 0 END), 2) AS revenue,
         count(DISTINCT CASE WHEN order_status = 'delivered' THEN order_id END) AS orders,
         count(DISTINCT CASE WHEN order_status <> 'delivered' THEN order_id END) AS failed,
         count(DISTINCT order_id) AS total
  FROM mart GROUP BY 1, 2),
series AS (
  SELECT series_id, ds, revenue, orders, revenue / nullif(orders, 0)::DOUBLE AS aov,
         failed::DOUBLE / nullif(total, 0) AS payment_fail_rate
  FROM sums)"""


OVERLAY = """
events(idx, kpi, start, days, multiplier, label) AS (VALUES
  {values}),
hits AS (
  SELECT s.series_id, s.ds, e.*, md5('42|' || e.idx || '|' || s.series_id || '|' || strftime(s.ds, '%Y-%m-%d')) AS h
  FROM series s JOIN events e ON s.ds >= e.start AND s.ds < e.start + e.days),
factors AS (
  SELECT series_id, ds, idx, kpi, label, multiplier * (1 + 0.01
           * sqrt(-2 * ln((('0x' || substr(h, 1, 8))::UBIGINT + 1) / 4294967296.0::DOUBLE))
           * cos(2 * pi() * (('0x' || substr(h, 9, 8))::UBIGINT + 1) / 4294967296.0::DOUBLE)) AS f
  FROM hits),
by_kpi AS (SELECT series_id, ds, kpi, product(f) AS f FROM factors GROUP BY ALL),
labels_of AS (SELECT series_id, ds, arg_max(label, idx) AS injected_label FROM factors GROUP BY ALL),
overlaid AS (
  SELECT s.series_id, s.ds,
         s.revenue * coalesce(a.f, 1) AS revenue, s.orders * coalesce(b.f, 1) AS orders,
         s.aov * coalesce(c.f, 1) AS aov,
         s.payment_fail_rate * coalesce(d.f, 1) AS payment_fail_rate, l.injected_label
  FROM series s
  LEFT JOIN by_kpi a ON (a.series_id, a.ds, a.kpi) = (s.series_id, s.ds, 'revenue')
  LEFT JOIN by_kpi b ON (b.series_id, b.ds, b.kpi) = (s.series_id, s.ds, 'orders')
  LEFT JOIN by_kpi c ON (c.series_id, c.ds, c.kpi) = (s.series_id, s.ds, 'aov')
  LEFT JOIN by_kpi d ON (d.series_id, d.ds, d.kpi) = (s.series_id, s.ds, 'payment_fail_rate')
  LEFT JOIN labels_of l ON (l.series_id, l.ds) = (s.series_id, s.ds))""".format(
    values=",\n  ".join(
        f"({i}, '{k}', DATE '{d}', {n}, {m}::DOUBLE, '{label}')" for i, k, d, n, m, label in EVENTS
    )
)


def long(source: str) -> str:
    label = "injected_label" if source == "overlaid" else "NULL::VARCHAR"
    return "\nlong AS (" + " UNION ALL ".join(
        f"SELECT series_id, ds, '{k}' AS kpi, {i} AS k, {k}::DOUBLE AS v, {label} AS injected_label FROM {source}"
        for i, k in enumerate(KPIS)
    ) + ")"


# The quartiles of 30 sorted values lie at positions 8.25 and 22.75, counted from 1.
ROLL = """
frames AS (
  SELECT *, row_number() OVER (w) - 1 AS row_pos, count(v) OVER w7 AS n7, count(v) OVER w30 AS n30,
         avg(v) OVER w7 AS m7, stddev_pop(v) OVER w7 AS s7, avg(v) OVER w30 AS m30,
         list_sort(list(v) OVER w30) AS l
  FROM long
  WINDOW w AS (PARTITION BY series_id, kpi ORDER BY ds),
         w7 AS (PARTITION BY series_id, kpi ORDER BY ds ROWS BETWEEN 6 PRECEDING AND CURRENT ROW),
         w30 AS (PARTITION BY series_id, kpi ORDER BY ds ROWS BETWEEN 29 PRECEDING AND CURRENT ROW)),
quartiles AS (
  SELECT *, CASE WHEN l[8] = l[9] THEN l[8] ELSE 0.75::DOUBLE * l[8] + 0.25::DOUBLE * l[9] END AS q1,
         CASE WHEN l[22] = l[23] THEN l[22] ELSE 0.25::DOUBLE * l[22] + 0.75::DOUBLE * l[23] END AS q3
  FROM frames),
roll AS (
  SELECT series_id, ds, kpi, k, v, injected_label, row_pos,
         CASE WHEN n7 = 7 THEN m7 END AS rolling_mean, CASE WHEN n7 = 7 THEN s7 END AS rolling_std,
         CASE WHEN n30 = 30 THEN m30 END AS baseline,
         CASE WHEN n7 = 7 THEN (v - m7) / nullif(s7, 0) END AS z,
         CASE WHEN n30 = 30 THEN q1 - 1.5 * (q3 - q1) END AS iqr_lo,
         CASE WHEN n30 = 30 THEN q3 + 1.5 * (q3 - q1) END AS iqr_hi
  FROM quartiles)"""

def flags(with_forest: bool = False) -> str:
    """Detectors, their vote and risk; with the forest's vote after the cold start."""
    vote = "coalesce(iforest_raw, false) AND row_pos >= 35" if with_forest else "false"
    rows = "roll LEFT JOIN forest USING (ds)" if with_forest else "roll"
    return f"""
detectors AS (
  SELECT *, (v - baseline) / nullif(baseline, 0) AS dev,
         coalesce(round(abs((v - baseline) / nullif(baseline, 0)), 12) > 0.2, false) AS anomaly_rule,
         coalesce(round(abs(z), 12) > 2.0, false) AS anomaly_z,
         coalesce(v < iqr_lo OR v > iqr_hi, false) AS anomaly_iqr, {vote} AS anomaly_iforest
  FROM {rows}),
flags AS (
  SELECT *, (anomaly_rule::INT + anomaly_z::INT + anomaly_iqr::INT + anomaly_iforest::INT >= 2) AND row_pos >= 35 AS anomaly_flag
  FROM detectors),
risk AS (
  SELECT *, CASE WHEN NOT anomaly_flag THEN 'NONE'
                 WHEN kpi = 'revenue' AND round(dev, 12) <= -0.3 THEN 'HIGH'
                 WHEN round(abs(z), 12) >= 2.3 THEN 'HIGH' WHEN round(abs(z), 12) >= 2.0 THEN 'MEDIUM'
                 WHEN round(abs(z), 12) >= 1.5 THEN 'LOW' ELSE 'NONE' END AS risk_level
  FROM flags)"""


def forest(source: str, trees: int = 300, seed: int = 42, contamination: float = 0.03) -> str:
    """The isolation forest of one series of at least 256 days: samples and draws by md5,
    one level of all trees after the other, then all days sent down them."""
    xs = [f"x{i}" for i in range(len(KPIS))]
    fills = ", ".join(
        f"coalesce(last_value({k} IGNORE NULLS) OVER (ORDER BY ds ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), "
        f"first_value({k} IGNORE NULLS) OVER (ORDER BY ds ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::DOUBLE AS {x}"
        for k, x in zip(KPIS, xs)
    )
    columns = ", ".join(xs)
    ends = ", ".join(f"min({x}) AS l{i}, max({x}) AS h{i}" for i, x in enumerate(xs))
    varying = [f"(h{i} > l{i})::INT" for i in range(len(xs))]
    before = ["0", *(" + ".join(varying[:i]) for i in range(1, len(xs)))]
    chosen = "CASE " + " ".join(f"WHEN h{i} > l{i} AND {before[i]} = pick THEN {i}" for i in range(len(xs))) + " END"
    of = lambda p, f: "CASE " + f + " " + " ".join(f"WHEN {i} THEN {p}{i}" for i in range(len(xs))) + " END"
    unit = lambda at: f"('0x' || substr(h, {at}, 8))::UBIGINT::DOUBLE / 4294967296.0::DOUBLE"
    ctes = [
        f"filled AS (SELECT series_id, ds, {fills} FROM {source})",
        f"tree_of AS (SELECT t FROM range({trees}) AS r(t))",
        "ordered AS (SELECT t, filled.*, row_number() OVER (PARTITION BY t ORDER BY "
        f"substr(md5('{seed}|' || series_id || '|' || t || '|' || strftime(ds, '%Y-%m-%d')), 1, 16)) AS n FROM filled, tree_of)",
        f"at0 AS (SELECT t, 0 AS node, {columns} FROM ordered WHERE n <= 256)",
    ]
    for k in range(9):
        ctes.append(f"stats{k} AS (SELECT t, node, count(*) AS c, {ends} FROM at{k} GROUP BY t, node)")
        if k == 8:
            break
        ctes += [
            f"drawn{k} AS (SELECT *, md5('{seed}|all|' || t || '|n' || node) AS h FROM stats{k} WHERE {' OR '.join(f'h{i} > l{i}' for i in range(len(xs)))})",
            f"picked{k} AS (SELECT *, floor(({unit(1)}) * ({' + '.join(varying)}))::INT AS pick, {unit(9)} AS u FROM drawn{k})",
            f"fed{k} AS (SELECT *, {chosen} AS f FROM picked{k})",
            f"split{k} AS (SELECT t, node, f, CASE WHEN lo + u * (hi - lo) >= hi THEN lo ELSE lo + u * (hi - lo) END AS cut "
            f"FROM (SELECT t, node, f, u, {of('l', 'f')} AS lo, {of('h', 'f')} AS hi FROM fed{k}))",
            f"at{k + 1} AS (SELECT a.t, 2 * a.node + 1 + ({of('x', 'f')} > cut)::INT AS node, {columns} "
            f"FROM at{k} a JOIN split{k} s ON a.t = s.t AND a.node = s.node)",
        ]
    ctes += [
        "splits AS (" + " UNION ALL ".join(f"SELECT * FROM split{k}" for k in range(8)) + ")",
        "sizes AS (" + " UNION ALL ".join(f"SELECT t, node, c FROM stats{k}" for k in range(9)) + ")",
        f"down0 AS (SELECT t, ds, 0 AS node, {columns} FROM ordered)",
    ]
    for k in range(8):
        ctes.append(
            f"down{k + 1} AS (SELECT d.t, d.ds, CASE WHEN s.t IS NULL THEN d.node ELSE 2 * d.node + 1 + ({of('x', 'f')} > cut)::INT END AS node, "
            f"{columns} FROM down{k} d LEFT JOIN splits s ON d.t = s.t AND d.node = s.node)"
        )
    gamma = "0.5772156649015329::DOUBLE"
    mean = f"CASE WHEN c <= 1 THEN 0.0::DOUBLE WHEN c = 2 THEN 1.0::DOUBLE ELSE 2.0::DOUBLE * (ln(c - 1.0::DOUBLE) + {gamma}) - 2.0::DOUBLE * (c - 1.0::DOUBLE) / c END"
    norm = f"(2.0::DOUBLE * (ln(255.0::DOUBLE) + {gamma}) - 2.0::DOUBLE * 255.0::DOUBLE / 256.0::DOUBLE)"
    ctes += [
        f"lengths AS (SELECT ds, sum(round((floor(log2(d.node + 1)) + {mean}) * 1048576)::BIGINT)::DOUBLE AS path "
        "FROM down8 d JOIN sizes z ON d.t = z.t AND d.node = z.node GROUP BY ds)",
        f"scored AS (SELECT ds, pow(2.0::DOUBLE, -(path / 1048576.0::DOUBLE / {trees}) / {norm}) AS iforest_score FROM lengths)",
        f"forest AS (SELECT ds, iforest_score, iforest_score > (SELECT quantile_cont(iforest_score, {1 - contamination}) FROM scored) AS iforest_raw FROM scored)",
    ]
    return "\n" + ",\n".join(ctes)


SEGMENTS = "\nsegments AS (" + " UNION ALL ".join(
    f"""
  SELECT 'all' AS series_id, purchase_date AS ds, '{d}' AS dimension, {d} AS segment,
         round(sum(price + freight_value), 2) AS revenue, count(DISTINCT order_id) AS orders
  FROM mart WHERE order_status = 'delivered' GROUP BY ALL"""
    for d in DIMS
) + ")"

# Cut i of four bands is the value of rank ceil(n * i / 4).
BANDS = """
order_values AS (SELECT order_id, round(sum(price + freight_value), 6) AS value FROM r_items GROUP BY 1),
by_value AS (SELECT value, row_number() OVER (ORDER BY value) AS n, count(*) OVER () AS total FROM order_values WHERE value IS NOT NULL),
cuts AS (SELECT min(value) FILTER (n = ceil(total / 4)) AS c1, min(value) FILTER (n = ceil(total * 2 / 4)) AS c2,
                min(value) FILTER (n = ceil(total * 3 / 4)) AS c3 FROM by_value),
banded AS (
  SELECT order_id, value, CASE WHEN value <= c1 THEN '1 of 4' WHEN value <= c2 THEN '2 of 4' WHEN value <= c3 THEN '3 of 4'
                               WHEN value IS NOT NULL THEN '4 of 4' END AS order_segment
  FROM order_values, cuts)"""

ORDER_SEGMENTS = """
order_segments AS (
  SELECT 'all' AS series_id, purchase_date AS ds, 'order_segment' AS dimension, order_segment AS segment,
         round(sum(price + freight_value), 2) AS revenue, count(DISTINCT order_id) AS orders
  FROM mart JOIN banded USING (order_id) WHERE order_status = 'delivered' GROUP BY ALL)"""

FOUR = """
three AS (SELECT * FROM segments_of_three UNION ALL SELECT * FROM order_segments),
segments AS (SELECT * FROM three)"""

PRIMARY = """
ranked_kpis AS (
  SELECT ds, kpi, max(anomaly_flag) OVER (PARTITION BY ds) AS flagged,
         row_number() OVER (PARTITION BY ds ORDER BY
           CASE risk_level WHEN 'HIGH' THEN 3 WHEN 'MEDIUM' THEN 2 WHEN 'LOW' THEN 1 ELSE 0 END DESC,
           coalesce(abs(z), -1) DESC, k) AS n
  FROM risk),
days AS (SELECT ds, kpi AS primary_kpi FROM ranked_kpis WHERE flagged AND n = 1)"""

def changes(places: int | None = None) -> str:
    """Segment changes and drivers. Values are compared in millionths; so is the order of
    changes, where rounding is asked for."""

    def of(x: str) -> str:
        return x if places is None else f"round({x}, {places})"

    return f"""
before AS (
  SELECT d.ds AS anomaly_ds, s.dimension, s.segment,
         avg(CASE WHEN d.primary_kpi = 'revenue' THEN s.revenue ELSE s.orders END) AS base_metric
  FROM days d JOIN segments s ON s.ds < d.ds AND s.ds >= d.ds - 30 GROUP BY ALL),
today AS (
  SELECT d.ds AS anomaly_ds, s.dimension, s.segment,
         CASE WHEN d.primary_kpi = 'revenue' THEN s.revenue ELSE s.orders END AS today_metric
  FROM days d JOIN segments s ON s.ds = d.ds),
changes AS (
  SELECT anomaly_ds, dimension, segment, coalesce(today_metric, 0)::DOUBLE AS today,
         coalesce(base_metric, 0)::DOUBLE AS baseline,
         (coalesce(today_metric, 0) - coalesce(base_metric, 0))::DOUBLE AS delta,
         today_metric IS NOT NULL AS has_today
  FROM today FULL OUTER JOIN before USING (anomaly_ds, dimension, segment)),
cut AS (
  SELECT anomaly_ds, dimension, segment, {of('today')} AS today, {of('baseline')} AS baseline,
         {of('delta')} AS delta, has_today, row_number() OVER (PARTITION BY anomaly_ds, dimension
           ORDER BY abs({of('delta')}) DESC, segment NULLS LAST, has_today DESC) AS rank
  FROM changes),
shares AS (
  SELECT *, sum(delta) OVER (PARTITION BY anomaly_ds, dimension ORDER BY rank
              ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS total
  FROM cut WHERE rank <= 50),
drivers AS (
  SELECT anomaly_ds, dimension, rank, segment, today, baseline, delta,
         delta / CASE WHEN total = 0 THEN 1e-9::DOUBLE ELSE total END AS pct_contrib
  FROM shares WHERE rank <= 5)"""


def report(source: str) -> str:
    """Issues of each series. A duplicate date counts once per repetition."""
    stats = ", ".join(f"avg(({k} IS NULL)::INT)::DOUBLE AS null_{k}" for k in KPIS)
    parts = [
        "SELECT series_id, 'ds_nulls' AS \"check\", 'FAIL' AS severity, 'ds contains nulls' AS detail FROM stats WHERE null_ds > 0",
        "SELECT series_id, 'ds_duplicates', 'FAIL', dup_ds || ' duplicate dates' FROM stats WHERE dup_ds > 0",
        "SELECT series_id, 'revenue_negative', 'FAIL', neg_revenue || ' days with revenue < 0' FROM stats WHERE neg_revenue > 0",
        "SELECT series_id, 'orders_negative', 'FAIL', neg_orders || ' days with orders < 0' FROM stats WHERE neg_orders > 0",
        *[
            f"SELECT series_id, 'null_rate_{k}', 'WARN', '{k} null rate = ' || format('{{:.2f}}', 100 * null_{k}) || '%' FROM stats WHERE null_{k} > 0.02"
            for k in KPIS
        ],
        "SELECT series_id, 'date_gaps', 'WARN', 'Max gap between dates = ' || gap || ' days' FROM gaps WHERE gap > 2",
    ]
    return f"""
stats AS (
  SELECT series_id, count(*) - count(ds) AS null_ds,
         count(*) - count(DISTINCT ds) - (count(*) > count(ds))::INT AS dup_ds,
         count(*) FILTER (revenue < 0) AS neg_revenue, count(*) FILTER (orders < 0) AS neg_orders, {stats}
  FROM {source} GROUP BY 1),
gaps AS (
  SELECT series_id, max(ds - before) AS gap
  FROM (SELECT series_id, ds, lag(ds) OVER (PARTITION BY series_id ORDER BY ds) AS before
        FROM (SELECT DISTINCT series_id, ds FROM {source} WHERE ds IS NOT NULL)) GROUP BY 1),
issues AS ({" UNION ALL ".join(parts)}),
report AS (
  SELECT * FROM issues UNION ALL
  SELECT series_id, 'all', 'PASS', 'No issues detected' FROM stats
  WHERE series_id NOT IN (SELECT series_id FROM issues)),
status AS (
  SELECT series_id, CASE max(CASE severity WHEN 'FAIL' THEN 2 WHEN 'WARN' THEN 1 ELSE 0 END)
           WHEN 2 THEN 'FAIL' WHEN 1 THEN 'WARN' ELSE 'PASS' END AS validation_status
  FROM report GROUP BY 1)"""


DAMAGED = """
damaged AS (
  SELECT 'worst' AS series_id, CASE day(ds) WHEN 1 THEN NULL WHEN 2 THEN ds + 1 ELSE ds END AS ds,
         CASE WHEN day(ds) = 3 THEN -revenue ELSE revenue END AS revenue,
         CASE WHEN day(ds) = 4 THEN -orders ELSE orders END AS orders,
         CASE WHEN day(ds) < 20 THEN NULL ELSE aov END AS aov, payment_fail_rate FROM series
  UNION ALL SELECT 'gaps', ds, revenue, orders, aov, payment_fail_rate FROM series WHERE day(ds) < 20
  UNION ALL SELECT '', ds, revenue, orders, aov, payment_fail_rate FROM series)"""

ALERTS = """
alerts AS (
  SELECT k.ds, k.kpi, round(k.v, 6) AS value, round(k.baseline, 6) AS baseline, round(k.z, 6) AS z_score, k.risk_level, k.anomaly_rule AS rule,
         k.anomaly_z AS z, k.anomaly_iqr AS iqr, k.anomaly_iforest AS iforest, s.validation_status, k.injected_label,
         CASE risk_level WHEN 'HIGH' THEN 3 WHEN 'MEDIUM' THEN 2 WHEN 'LOW' THEN 1 ELSE 0 END AS risk_rank,
         k.anomaly_rule::INT + k.anomaly_z::INT + k.anomaly_iqr::INT AS detector_count
  FROM risk k JOIN status s USING (series_id) WHERE k.anomaly_flag),
meaningful AS (
  SELECT * FROM alerts
  WHERE validation_status <> 'FAIL' AND (risk_level IN ('HIGH', 'MEDIUM') OR abs(z_score) >= 2.5)
    AND detector_count >= 2),
sent_days AS (
  SELECT kpi, min(ds) AS ds FROM meaningful GROUP BY kpi
  UNION ALL
  SELECT s.kpi, (SELECT min(m.ds) FROM meaningful m WHERE m.kpi = s.kpi AND m.ds >= s.ds + 3) AS ds
  FROM sent_days s WHERE s.ds IS NOT NULL),
sent AS (SELECT m.* FROM meaningful m JOIN sent_days USING (kpi, ds))"""

TEXT = """'{' || concat_ws(', ', """ + ", ".join(
    f"""'''{d}'': ' || CASE WHEN {d} THEN 'True' ELSE 'False' END""" for d in ("rule", "z", "iqr", "iforest")
) + """) || '}'"""

MESSAGES = f"""
lines AS (
  SELECT anomaly_ds AS ds, dimension,
         dimension || ': top driver = ' || coalesce(segment, 'None') || ' (delta=' || format('{{:,.2f}}', delta)
           || ', contribution=' || format('{{:.1f}}', pct_contrib * 100) || '%)' AS line
  FROM drivers WHERE rank = 1 AND dimension IN ('customer_state', 'product_category_name')),
summaries AS (
  SELECT d.ds, 'Primary KPI: ' || primary_kpi || '. ' || coalesce(string_agg(line, ' | ' ORDER BY dimension),
           'Root cause evidence present but not easily summarized.') AS summary
  FROM days d LEFT JOIN lines USING (ds) GROUP BY d.ds, primary_kpi),
messages AS (
  SELECT ds, kpi,
    CASE risk_level WHEN 'HIGH' THEN '🔴' WHEN 'MEDIUM' THEN '🟠' WHEN 'LOW' THEN '🟡' ELSE '⚪' END
    || ' *' || risk_level || ' KPI Alert*' || chr(10)
    || '*Date:* ' || strftime(ds, '%Y-%m-%d') || ' 00:00:00' || chr(10)
    || '*KPI:* ' || CASE kpi WHEN 'revenue' THEN 'Revenue' WHEN 'orders' THEN 'Orders' WHEN 'aov' THEN 'Aov'
                    ELSE 'Payment Fail Rate' END || chr(10)
    || '*Observed Value:* ' || coalesce(CASE WHEN kpi = 'revenue' THEN '$' ELSE '' END || format('{{:,.2f}}', value), 'N/A') || chr(10)
    || '*Baseline:* ' || coalesce(CASE WHEN kpi = 'revenue' THEN '$' ELSE '' END || format('{{:,.2f}}', baseline), 'N/A') || chr(10)
    || '*Z-Score:* ' || coalesce(format('{{:.2f}}', z_score), 'N/A') || chr(10)
    || '*Validation Status:* ' || validation_status || chr(10)
    || '*Detectors Fired:* ' || {TEXT} || chr(10)
    || '*Root Cause Summary:* ' || summary
    || coalesce(chr(10) || 'Simulation Tag: ' || injected_label, '') AS message
  FROM sent JOIN summaries USING (ds))"""


RAW_NAMES = {
    "orders": ("order_id", "customer_id", "order_status", "order_purchase_timestamp"),
    "customers": ("customer_id", "customer_state"),
    "items": ("order_id", "product_id", "price", "freight_value"),
    "products": ("product_id", "product_category_name"),
    "payments": ("order_id", "payment_type", "payment_value"),
}


def csv_types() -> str:
    """The type of each raw column, from the texts of its values."""
    number, day = "[-+]?[0-9]+", "[0-9]{4}-[0-9]{2}-[0-9]{2}"
    parts = []
    for table, columns in RAW_NAMES.items():
        for c in columns:
            x = f"CAST({c} AS VARCHAR)"
            like = lambda pattern: f"bool_and(regexp_full_match({x}, '{pattern}'))"
            parts.append(
                f"SELECT '{table}' AS table_name, '{c}' AS column_name, CASE "
                f"WHEN {like(number)} AND bool_and(TRY_CAST({x} AS BIGINT) IS NOT NULL) THEN 'bigint' "
                f"WHEN bool_and(TRY_CAST({x} AS DOUBLE) IS NOT NULL) FILTER ({c} IS NOT NULL) THEN 'double' "
                f"WHEN {like(day)} THEN 'date' "
                f"WHEN bool_and(TRY_CAST({x} AS TIMESTAMP) IS NOT NULL) FILTER ({c} IS NOT NULL) THEN 'timestamp_ntz' "
                f"ELSE 'string' END AS column_type, count({c}) AS n_values FROM r_{table}"
            )
    return " UNION ALL ".join(parts)


def _sql(select: str, *ctes: str) -> str:
    recursive = "RECURSIVE " if any("sent_days" in c for c in ctes) else ""
    return f"WITH {recursive}{', '.join(c.strip() for c in ctes)}\n{select}"


def oracle_sql() -> dict[str, str]:
    plain = (RAW, kpi())
    rolled = (*plain, long("series"), ROLL)
    risky = (*rolled, flags())
    caused = (*risky, SEGMENTS, PRIMARY, changes(6))
    caused_exact = (*risky, SEGMENTS, PRIMARY, changes())
    over = (*plain, OVERLAY, long("overlaid"), ROLL, flags(), report("overlaid"), ALERTS)
    four = (BANDS, ORDER_SEGMENTS, SEGMENTS.replace("segments AS (", "segments_of_three AS ("), FOUR)
    by_state = (RAW, kpi("customer_state"))
    flag_columns = "anomaly_rule, anomaly_z, anomaly_iqr, anomaly_iforest, anomaly_flag"
    daily = f"SELECT ds, {r('revenue')} AS revenue, orders, {r('aov')} AS aov, {r('payment_fail_rate')} AS payment_fail_rate FROM series"
    wide = []
    for k in KPIS:
        pick = f"FILTER (kpi = '{k}')"
        for column, name in (
            ("v", k), ("rolling_mean", f"{k}_rm7"), ("rolling_std", f"{k}_rs7"), ("baseline", f"{k}_base30"),
            ("z", f"{k}_z"), ("iqr_lo", f"{k}_iqr_lo"), ("iqr_hi", f"{k}_iqr_hi"),
        ):
            value = f"any_value({column}) {pick}"
            wide.append(f"CAST(CAST(round({value}, 8) AS DECIMAL(30, 8)) AS VARCHAR) AS {name}" if "_iqr_" in name else f"{r(value)} AS {name}")
        for column in (*flag_columns.split(", "), "risk_level"):
            wide.append(f"any_value({column}) {pick} AS {k}_{column}")
    alert_columns = (
        f"ds, kpi, {r('value')} AS value, {r('baseline')} AS baseline, {r('z_score')} AS z_score, risk_level, "
        f"{TEXT} AS detectors, validation_status, injected_label"
    )
    fills = ", ".join(
        r(
            f"coalesce(last_value({k} IGNORE NULLS) OVER (ORDER BY ds ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), "
            f"first_value({k} IGNORE NULLS) OVER (ORDER BY ds ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))"
        )
        + f" AS {k}"
        for k in ("revenue", "aov", "payment_fail_rate")
    )
    return {
        "order_facts": _sql("SELECT * REPLACE (strftime(purchase_ts, '%Y-%m-%d %H:%M:%S') AS purchase_ts) FROM mart", RAW),
        "order_facts_by_status": _sql(
            "SELECT order_status, payment_type, count(*) AS n_rows, count(*) FILTER (product_category_name IS NULL) AS no_category, "
            "round(sum(price + freight_value), 2) AS amount FROM mart GROUP BY ALL",
            RAW,
        ),
        "kpi_daily": _sql(daily, *plain),
        "kpi_daily_rollup": _sql(daily, *plain),
        "kpi_daily_from_mart": _sql(daily, *plain),
        "kpi_daily_stream": _sql(daily, *plain),
        "raw_csv_to_kpi": _sql(daily, *plain),
        "raw_csv_types": _sql(csv_types(), RAW),
        "kpi_daily_by_state": _sql(daily.replace("SELECT ds", "SELECT series_id, ds"), *by_state),
        "kpi_long": _sql(f"SELECT ds, kpi, {r('v')} AS value FROM long", *plain, long("series")),
        "rolling_stats": _sql(
            f"SELECT ds, kpi, {r('rolling_mean')} AS rolling_mean, {r('rolling_std')} AS rolling_std, {r('baseline')} AS baseline FROM roll",
            *rolled,
        ),
        "zscore": _sql(f"SELECT ds, kpi, row_pos, {r('z')} AS z FROM roll", *rolled),
        "iqr_bounds": _sql(f"SELECT ds, kpi, {r('iqr_lo', 8)} AS iqr_lo, {r('iqr_hi', 8)} AS iqr_hi FROM roll", *rolled),
        "rolling_stats_by_state": _sql(
            f"SELECT series_id, ds, kpi, {r('rolling_mean')} AS rolling_mean, {r('baseline')} AS baseline, {r('z')} AS z FROM roll",
            *by_state, long("series"), ROLL,
        ),
        "detect_flags": _sql(f"SELECT ds, kpi, {flag_columns} FROM flags", *risky),
        "risk_levels": _sql("SELECT ds, kpi, anomaly_flag, risk_level FROM risk", *risky),
        "wide_features": _sql(f"SELECT ds, {', '.join(wide)} FROM risk GROUP BY ds", *risky),
        "ffill_bfill": _sql(f"SELECT ds, orders, {fills} FROM series", *plain),
        "quality_report": _sql('SELECT "check", severity, detail FROM report', *plain, report("series")),
        "quality_report_by_state": _sql('SELECT series_id, "check", severity, detail FROM report', *by_state, report("series")),
        "quality_status_by_state": _sql("SELECT * FROM status", *by_state, report("series")),
        "scenario_overlay": _sql(
            f"SELECT ds, {', '.join(r(k) + ' AS ' + k for k in KPIS)}, injected_label FROM overlaid", *plain, OVERLAY
        ),
        "segment_daily": _sql("SELECT ds, dimension, segment, revenue, orders FROM segments", RAW, SEGMENTS),
        "segment_daily_rollup": _sql("SELECT ds, dimension, segment, revenue, orders FROM segments", RAW, SEGMENTS),
        "rollup_incremental": _sql("SELECT ds, dimension, segment, revenue, orders FROM segments", RAW, SEGMENTS),
        "order_bands": _sql(
            "SELECT order_segment AS band, count(*) AS orders, min(value) AS least, max(value) AS most, round(sum(value), 2) AS amount "
            "FROM banded GROUP BY 1",
            RAW, BANDS,
        ),
        "order_segment_daily": _sql("SELECT ds, segment, revenue, orders FROM order_segments", RAW, BANDS, ORDER_SEGMENTS),
        "order_segment_from_mart": _sql("SELECT ds, segment, revenue, orders FROM order_segments", RAW, BANDS, ORDER_SEGMENTS),
        "order_segment_drivers": _sql(
            f"SELECT anomaly_ds, dimension, rank::INTEGER AS rank, segment, {r('today')} AS today, {r('baseline')} AS baseline, "
            f"{r('delta')} AS delta, {r('pct_contrib')} AS pct_contrib FROM drivers",
            *risky, *four, PRIMARY, changes(6),
        ),
        "order_segment_breakdown": _sql(
            "SELECT date_trunc('month', ds)::DATE AS month, dimension, segment, round(sum(revenue), 2) AS revenue, "
            "sum(orders)::BIGINT AS orders FROM segments GROUP BY ALL",
            RAW, *four,
        ),
        "pipeline_order_segment": _sql(
            "SELECT a.ds, a.kpi, count(v.rank) AS listed FROM alerts a JOIN days d USING (ds) "
            "LEFT JOIN drivers v ON v.anomaly_ds = a.ds AND v.dimension = 'order_segment' GROUP BY ALL",
            *over, *four, PRIMARY, changes(),
        ),
        "primary_kpi": _sql("SELECT * FROM days", *risky, PRIMARY),
        "segment_changes": _sql(
            f"SELECT anomaly_ds, dimension, segment, {r('today')} AS today, {r('baseline')} AS baseline, {r('delta')} AS delta FROM changes",
            *caused,
        ),
        "root_cause_top": _sql(
            f"SELECT anomaly_ds, dimension, rank::INTEGER AS rank, segment, {r('today')} AS today, {r('baseline')} AS baseline, "
            f"{r('delta')} AS delta, {r('pct_contrib')} AS pct_contrib FROM drivers",
            *caused,
        ),
        "root_cause_json": _sql(
            "SELECT k.ds, k.kpi, d.primary_kpi, m.dimension, v.rank::INTEGER AS rank, v.segment, "
            + ", ".join(f"{r('v.' + c)} AS {c}" for c in ("today", "baseline", "delta", "pct_contrib"))
            + " FROM risk k JOIN days d USING (ds) CROSS JOIN "
            f"(VALUES {', '.join(f'({chr(39)}{d}{chr(39)})' for d in DIMS)}) AS m(dimension) "
            "LEFT JOIN drivers v ON v.anomaly_ds = k.ds AND v.dimension = m.dimension",
            *caused_exact,
        ),
        "pipeline_evidence": _sql(
            "SELECT a.ds, a.kpi, d.primary_kpi, m.dimension, count(v.rank) AS listed, round(max(abs(v.delta)), 6) AS largest "
            "FROM alerts a JOIN days d USING (ds) CROSS JOIN "
            f"(VALUES {', '.join(f'({chr(39)}{d}{chr(39)})' for d in DIMS)}) AS m(dimension) "
            "LEFT JOIN drivers v ON v.anomaly_ds = a.ds AND v.dimension = m.dimension GROUP BY ALL",
            *over, SEGMENTS, PRIMARY, changes(),
        ),
        "pipeline_kpi_daily": _sql(
            "SELECT ds, round(revenue, 2) AS revenue, round(orders, 2) AS orders, injected_label FROM overlaid", *plain, OVERLAY
        ),
        "pipeline_quality": _sql('SELECT "check", severity, detail FROM report', *plain, OVERLAY, report("overlaid")),
        "pipeline_alerts_unnamed_series": _sql(
            f"SELECT nullif(series_id, '') AS series_id, ds, kpi, {r('v')} AS value, risk_level, validation_status, true AS explained "
            "FROM risk JOIN status USING (series_id) WHERE anomaly_flag AND validation_status <> 'FAIL'",
            RAW, kpi("CASE WHEN customer_state > 'M' THEN '' ELSE 'A to M' END"), OVERLAY, long("overlaid"), ROLL, flags(), report("overlaid"),
        ),
        "quality_report_damaged": _sql(
            """SELECT nullif(series_id, '') AS series_id, "check", severity, detail FROM report""", *plain, DAMAGED, report("damaged")
        ),
        "quality_status_damaged": _sql(
            "SELECT nullif(series_id, '') AS series_id, validation_status FROM status", *plain, DAMAGED, report("damaged")
        ),
        "summaries_of_partial_evidence": _sql(
            "SELECT ds, CASE day(ds) % 6 "
            "WHEN 0 THEN 'Primary KPI: unknown. unknown_dimension: top driver = unknown (delta=' || format('{:,.2f}', round(revenue, 2)) || ', contribution=0.0%)' "
            "WHEN 1 THEN 'Primary KPI: aov. d: top driver = None (delta=' || format('{:,.2f}', round(revenue, 2)) || ', contribution=N/A)' "
            "WHEN 2 THEN 'Primary KPI: None. Root cause evidence present but not easily summarized.' "
            "WHEN 3 THEN 'Primary KPI: aov. Root cause evidence present but not easily summarized.' "
            "WHEN 4 THEN 'Root cause evidence present but could not be parsed.' "
            "ELSE 'No root cause evidence available.' END AS summary FROM series",
            *plain,
        ),
        "orchestration_messages": _sql(
            "SELECT ds, kpi, risk_level, message FROM messages JOIN sent USING (ds, kpi)", *over, SEGMENTS, PRIMARY, changes(6), MESSAGES
        ),
        **{
            name: _sql(
                f"SELECT 'all' AS series_id, ds, {r('iforest_score')} AS iforest_score, iforest_raw FROM forest", *plain, forest("series")
            )
            for name in ("iforest_scores", "iforest_fit_and_score")
        },
        "detect_flags_with_forest": _sql(
            f"SELECT ds, kpi, {flag_columns} FROM flags", *rolled, forest("series"), flags(True)
        ),
        "pipeline_alerts_with_forest": _sql(
            f"SELECT {alert_columns} FROM alerts",
            *plain, OVERLAY, long("overlaid"), ROLL, forest("overlaid"), flags(True), report("overlaid"), ALERTS,
        ),
        "alert_table": _sql(f"SELECT {alert_columns} FROM alerts", *over),
        "alerts_csv_roundtrip": _sql(f"SELECT {alert_columns} FROM alerts", *over),
        "pipeline_alerts": _sql(f"SELECT {alert_columns} FROM alerts", *over),
        "meaningful_alerts": _sql(
            f"SELECT ds, kpi, risk_level, {r('z_score')} AS z_score, detector_count FROM meaningful", *over
        ),
        "cooldown": _sql(f"SELECT ds, kpi, risk_level, {r('z_score')} AS z_score FROM sent", *over),
        "cooldown_long": _sql(f"SELECT ds, kpi, risk_level, {r('z_score')} AS z_score FROM sent", *over),
        "cooldown_stream": _sql(f"SELECT ds, kpi, risk_level, {r('z_score')} AS z_score FROM sent", *over),
        "notifications_ranked": _sql(
            f"SELECT ds, kpi, risk_rank, {r('abs(z_score)')} AS abs_z, detector_count FROM sent", *over
        ),
        "messages": _sql("SELECT ds, kpi, message FROM messages", *over, SEGMENTS, PRIMARY, changes(6), MESSAGES),
        "detectors_text": _sql(f"SELECT ds, kpi, {TEXT} AS text, rule, z, iqr, iforest FROM alerts", *over),
        "orchestration_counts": _sql(
            "SELECT (SELECT count(*) FROM alerts) AS input_alerts, (SELECT count(*) FROM meaningful) AS meaningful_alerts, "
            "(SELECT count(*) FROM sent) AS notifications",
            *over,
        ),
        "feed_trends": _sql(
            f"SELECT kpi, ds, {r('v')} AS value, {r('rolling_mean')} AS rolling_mean, {r('baseline')} AS baseline FROM roll "
            "WHERE kpi IN ('revenue', 'orders')",
            *rolled,
        ),
        "feed_anomaly_distribution": _sql(
            "SELECT kpi, count(*) AS days, count(*) FILTER (anomaly_flag) AS anomalies FROM flags GROUP BY kpi", *risky
        ),
        "feed_severity": _sql("SELECT kpi, risk_level, count(*) AS alerts FROM alerts GROUP BY ALL", *over),
        "feed_alert_frequency": _sql(
            "SELECT date_trunc('month', ds)::DATE AS month, risk_level, count(*) AS alerts FROM alerts GROUP BY ALL", *over
        ),
        "feed_incident_log": _sql(
            f"SELECT ds, kpi, risk_level, {r('value')} AS value, {r('baseline')} AS baseline, {r('z_score')} AS z_score, "
            "validation_status, injected_label FROM alerts",
            *over,
        ),
        "feed_root_cause_signals": _sql(
            f"SELECT anomaly_ds AS ds, primary_kpi, dimension, rank::INTEGER AS rank, segment, {r('today')} AS today, "
            f"{r('baseline')} AS baseline, {r('delta')} AS delta, {r('pct_contrib')} AS pct_contrib "
            "FROM drivers JOIN days ON days.ds = anomaly_ds",
            *caused,
        ),
        "feed_breakdown": _sql(
            "SELECT date_trunc('month', ds)::DATE AS month, dimension, segment, round(sum(revenue), 2) AS revenue, "
            "sum(orders)::BIGINT AS orders FROM segments GROUP BY ALL",
            RAW, SEGMENTS,
        ),
    }
