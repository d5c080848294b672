"""DuckDB oracle SQL for every query in ``testbed.QUERIES`` (same column names).

Plain ANSI SQL over the pre-registered views.  Tie-breaks are spelled out
exactly as in the Spark plans; datetimes are cast to dates where the rule is
date-based.
"""

def full_months(a: str, b: str) -> str:
    """Complete months from date ``a`` to date ``b`` with the source database's
    rule: calendar month difference, minus one when the day of month has not
    been reached (mirrored for negative spans).  DuckDB's own ``date_sub``
    rounds month ends up (Oct 31 -> Jun 30 counts 8), which the source does not."""
    return (f"(CASE WHEN {b} >= {a} THEN (year({b}) - year({a})) * 12 + month({b}) - month({a})"
            f" - CASE WHEN day({b}) < day({a}) THEN 1 ELSE 0 END"
            f" ELSE -((year({a}) - year({b})) * 12 + month({a}) - month({b})"
            f" - CASE WHEN day({a}) < day({b}) THEN 1 ELSE 0 END) END)")


def full_years(a: str, b: str) -> str:
    m = full_months(a, b)
    return f"(CASE WHEN {m} >= 0 THEN {m} // 12 ELSE -((-{m}) // 12) END)"



QUARTERS = """q AS (
  SELECT CAST(i AS INTEGER) AS period_id,
         CAST(DATE '1995-01-01' + to_months(CAST(3 * i AS INTEGER)) AS DATE) AS start_date,
         CAST(CAST(DATE '1995-01-01' + to_months(CAST(3 * i + 3 AS INTEGER)) AS DATE) - 1 AS DATE) AS end_date
  FROM range(28) t(i))"""

ORDERS = "o AS (SELECT *, CAST(o_orderdate AS DATE) AS order_date FROM orders)"
INTERVALS = """ls AS (SELECT l_orderkey, CAST(max(l_shipdate) AS DATE) AS last_ship FROM lineitem GROUP BY l_orderkey),
iv AS (SELECT o.o_orderkey, o.o_custkey, o.o_orderstatus, o.o_totalprice, CAST(o.o_orderdate AS DATE) AS order_date,
              ls.last_ship FROM orders o LEFT JOIN ls ON ls.l_orderkey = o.o_orderkey)"""

T_ORDER = "DATE '1998-06-30'"
T_EVENT = "TIMESTAMP '2024-01-20 00:00:00'"

REGISTER = f"""{ORDERS},
{INTERVALS},
first_o AS (SELECT o_custkey, min(order_date) AS enrollment_date FROM o GROUP BY o_custkey),
latest_o AS (SELECT o_custkey, CASE WHEN o_orderstatus = 'F' THEN order_date END AS completion_date FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY order_date DESC, o_orderkey DESC) AS rn FROM o) x
  WHERE rn = 1),
reg AS (SELECT f.o_custkey, f.enrollment_date, l.completion_date FROM first_o f JOIN latest_o l USING (o_custkey)),
lastv AS (SELECT o_custkey, order_date AS last_visit_date, last_ship AS next_appt_date FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY order_date DESC, o_orderkey DESC) AS rn
  FROM iv WHERE order_date <= {T_ORDER}) x WHERE rn = 1),
active AS (
  SELECT c.c_custkey, c.c_mktsegment, r.enrollment_date, v.last_visit_date, v.next_appt_date,
         CASE WHEN v.next_appt_date < {T_ORDER} THEN CAST(datediff('day', v.next_appt_date, {T_ORDER}) AS INTEGER) END AS days_late,
         CASE WHEN NOT (v.next_appt_date < {T_ORDER}) THEN CAST(datediff('day', {T_ORDER}, v.next_appt_date) AS INTEGER) END AS days_to_next
  FROM reg r LEFT JOIN lastv v USING (o_custkey) JOIN customer c ON r.o_custkey = c.c_custkey
  WHERE (r.completion_date IS NULL OR r.completion_date > {T_ORDER}) AND r.enrollment_date <= {T_ORDER})"""

SQL = {
    "a1": f"""WITH {ORDERS}
SELECT o_custkey, o_orderkey, o_orderstatus, order_date, o_totalprice FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS rn FROM o) x WHERE rn = 1""",

    "a2": f"""WITH {ORDERS}
SELECT o_custkey, o_orderkey, o_orderstatus, order_date FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey
     ORDER BY CASE WHEN o_orderstatus = 'F' THEN 0 ELSE 1 END, order_date DESC, o_orderkey DESC) AS rn FROM o) x
WHERE rn = 1""",

    "a3": f"""WITH {ORDERS}
SELECT o_custkey, o_orderpriority, o_orderkey, order_date FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey, o_orderpriority ORDER BY order_date DESC, o_orderkey DESC) AS rn
  FROM o) x WHERE rn = 1""",

    "a4": """SELECT user_id,
  max(CASE WHEN event_type = 'click' THEN value END) AS click,
  max(CASE WHEN event_type = 'error' THEN value END) AS error,
  max(CASE WHEN event_type = 'purchase' THEN value END) AS purchase,
  max(CASE WHEN event_type = 'signup' THEN value END) AS signup,
  max(CASE WHEN event_type = 'view' THEN value END) AS view
FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS rn
      FROM events WHERE event_type IN ('click', 'error', 'purchase', 'signup', 'view')) x
WHERE rn = 1 GROUP BY user_id""",

    "a5": """SELECT o.o_orderkey, o.o_custkey, CAST(o.o_orderdate AS DATE) AS order_date,
       p.min_price_a, p.min_price_n, p.min_price_r
FROM orders o LEFT JOIN (
  SELECT l_orderkey,
    min(CASE WHEN l_returnflag = 'A' THEN l_extendedprice END) AS min_price_a,
    min(CASE WHEN l_returnflag = 'N' THEN l_extendedprice END) AS min_price_n,
    min(CASE WHEN l_returnflag = 'R' THEN l_extendedprice END) AS min_price_r
  FROM lineitem WHERE l_returnflag IN ('A', 'N', 'R') GROUP BY l_orderkey) p ON p.l_orderkey = o.o_orderkey
WHERE o.o_orderpriority = '1-URGENT'""",

    "a6": """SELECT l.l_orderkey AS o_orderkey, l.l_linenumber,
    min(CASE WHEN l_returnflag = 'A' THEN l_extendedprice END) AS min_price_a,
    min(CASE WHEN l_returnflag = 'N' THEN l_extendedprice END) AS min_price_n,
    min(CASE WHEN l_returnflag = 'R' THEN l_extendedprice END) AS min_price_r,
    CAST(count(l.l_linenumber) AS BIGINT) AS n_lines
FROM lineitem l WHERE l.l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderpriority = '1-URGENT')
GROUP BY l.l_orderkey, l.l_linenumber""",

    "a7": """SELECT user_id,
  max(CASE WHEN event_type = 'purchase' THEN value END) AS max_purchase,
  max(CASE WHEN event_type = 'click' THEN value END) AS max_click,
  CAST(sum(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) AS BIGINT) AS n_errors
FROM events GROUP BY user_id""",

    "a8": """SELECT s.c_mktsegment, CAST(coalesce(x.n_f, 0) AS BIGINT) AS n_f, CAST(coalesce(x.n_o, 0) AS BIGINT) AS n_o,
       CAST(coalesce(x.n_p, 0) AS BIGINT) AS n_p
FROM (SELECT DISTINCT c_mktsegment FROM customer) s LEFT JOIN (
  SELECT c.c_mktsegment,
    sum(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END) AS n_f,
    sum(CASE WHEN o_orderstatus = 'O' THEN 1 ELSE 0 END) AS n_o,
    sum(CASE WHEN o_orderstatus = 'P' THEN 1 ELSE 0 END) AS n_p
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
  GROUP BY c.c_mktsegment) x ON x.c_mktsegment = s.c_mktsegment""",

    "a9": """SELECT l_orderkey, CAST(min(l_shipdate) AS DATE) AS first_ship, CAST(max(l_shipdate) AS DATE) AS last_ship,
       CAST(CAST(min(l_shipdate) AS DATE) + INTERVAL 30 DAY AS DATE) AS planned_end
FROM lineitem GROUP BY l_orderkey""",

    "a10": """SELECT user_id, string_agg(event_type, ',' ORDER BY event_type) AS event_types FROM events GROUP BY user_id""",

    "a11": """SELECT user_id, string_agg(DISTINCT event_type, ', ' ORDER BY event_type) AS event_types
FROM events GROUP BY user_id""",

    "a12": """SELECT user_id,
  bool_or(event_type = 'click') AS has_click, bool_or(event_type = 'error') AS has_error,
  bool_or(event_type = 'purchase') AS has_purchase, bool_or(event_type = 'signup') AS has_signup,
  bool_or(event_type = 'view') AS has_view
FROM events GROUP BY user_id""",

    "a13": """SELECT user_id,
  count(DISTINCT CASE WHEN event_type IN ('click', 'error', 'purchase', 'signup', 'view') THEN event_type END) = 5
    AS all_five
FROM events GROUP BY user_id""",

    "a14": """SELECT user_id, bool_or(event_type = 'purchase' AND value > 400) AS has_big_purchase
FROM events GROUP BY user_id""",

    "a15": """SELECT l_partkey, l_returnflag, CAST(min(l_shipdate) AS DATE) AS first_ship
FROM lineitem GROUP BY l_partkey, l_returnflag""",

    "a16": """SELECT user_id, CAST(ts AS DATE) AS event_date, max(value) AS max_value, max(event_type) AS max_type,
       min(event_id) AS first_event_id
FROM events GROUP BY user_id, CAST(ts AS DATE)""",

    "a19": f"""WITH {ORDERS},
lo AS (SELECT o_custkey, max(order_date) AS last_other FROM o WHERE o_orderstatus <> 'F' GROUP BY o_custkey)
SELECT o.o_custkey, min(o.order_date) AS first_f_date
FROM o LEFT JOIN lo ON lo.o_custkey = o.o_custkey
WHERE o.o_orderstatus = 'F' AND (lo.last_other IS NULL OR o.order_date >= lo.last_other)
GROUP BY o.o_custkey""",

    "w1": f"""SELECT user_id, nth, event_id, event_type, value FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS BIGINT) AS nth
  FROM events WHERE ts <= {T_EVENT}) x WHERE nth <= 3""",

    "w1_offset": f"""SELECT user_id, event_id, event_type, value FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn
  FROM events WHERE ts <= {T_EVENT}) x WHERE rn = 2""",

    "w2": f"""WITH {ORDERS}
SELECT o_custkey, o_orderkey, o_orderstatus, order_date FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY order_date DESC, o_orderkey DESC) AS rn FROM o) x
WHERE rn = 1""",

    "w3": f"""WITH {ORDERS},
latest AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY order_date DESC, o_orderkey DESC) AS rn
  FROM o) x WHERE rn = 1)
SELECT c_custkey, c_name FROM customer
WHERE c_custkey NOT IN (SELECT o_custkey FROM latest WHERE o_orderstatus <> 'F' OR o_orderstatus IS NULL)""",

    "w4": """SELECT order_date, CAST(row_number() OVER (ORDER BY order_date) AS BIGINT) AS date_id
FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS order_date FROM orders) d""",

    "w5": f"""WITH {QUARTERS}, {ORDERS},
m AS (SELECT o.o_custkey, o.o_orderstatus, q.end_date, max(o.order_date) AS md
      FROM o JOIN q ON o.order_date <= q.end_date GROUP BY o.o_custkey, o.o_orderstatus, q.end_date)
SELECT m.o_custkey, m.o_orderstatus, m.end_date, o.o_orderkey, o.order_date
FROM m JOIN o ON o.o_custkey = m.o_custkey AND o.o_orderstatus = m.o_orderstatus AND o.order_date = m.md""",

    "w6": f"""WITH {QUARTERS}, {ORDERS},
j AS (SELECT c.c_custkey, q.end_date, o.order_date, o.o_orderkey, o.o_orderstatus,
        row_number() OVER (PARTITION BY c.c_custkey, q.end_date ORDER BY o.order_date DESC NULLS LAST, o.o_orderkey ASC) AS rn
      FROM customer c CROSS JOIN q LEFT JOIN o ON o.o_custkey = c.c_custkey AND o.order_date <= q.end_date
      WHERE c.c_mktsegment = 'BUILDING')
SELECT c_custkey AS o_custkey, end_date, order_date, o_orderkey, o_orderstatus FROM j WHERE rn = 1""",

    "w7": f"""WITH {ORDERS}
SELECT o_custkey, min(order_date) AS first_o_date, arg_min(o_orderkey, (order_date, o_orderkey)) AS first_o_key,
       arg_min(o_orderpriority, (order_date, o_orderkey)) AS first_o_priority
FROM o WHERE o_orderstatus = 'O' GROUP BY o_custkey""",

    "w8": f"""WITH {INTERVALS}
SELECT o_custkey, o_orderkey, order_date, last_ship FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY order_date DESC, o_orderkey DESC) AS rn FROM iv
  WHERE order_date <= {T_ORDER} AND (last_ship IS NULL OR last_ship > {T_ORDER})) x WHERE rn = 1""",

    "j1": """SELECT c.c_custkey, c.c_name, n.n_name, r.r_name
FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey LEFT JOIN region r ON n.n_regionkey = r.r_regionkey""",

    "j2": """SELECT s.s_suppkey, s.s_name, n.n_name FROM supplier s LEFT JOIN nation n ON s.s_nationkey = n.n_nationkey""",

    "j4": """SELECT c.c_custkey, c.c_name, o.n_orders, o.last_order_date, e.n_events, e.max_event_value
FROM customer c
LEFT JOIN (SELECT o_custkey, count(*) AS n_orders, CAST(max(o_orderdate) AS DATE) AS last_order_date
           FROM orders GROUP BY o_custkey) o ON o.o_custkey = c.c_custkey
LEFT JOIN (SELECT user_id, count(*) AS n_events, max(value) AS max_event_value FROM events GROUP BY user_id) e
  ON e.user_id = c.c_custkey""",

    "j5": """SELECT coalesce(p.user_id, r.user_id) AS user_id, p.n_purchase, r.n_error
FROM (SELECT user_id, count(*) AS n_purchase FROM events WHERE event_type = 'purchase' GROUP BY user_id) p
FULL OUTER JOIN (SELECT user_id, count(*) AS n_error FROM events WHERE event_type = 'error' GROUP BY user_id) r
  ON p.user_id = r.user_id""",

    "j7": f"""WITH {QUARTERS} SELECT c.c_custkey, q.end_date FROM customer c CROSS JOIN q""",

    "j8": f"""WITH {QUARTERS}, {ORDERS}
SELECT c.c_custkey, q.end_date, CAST(count(o.o_orderkey) AS BIGINT) AS n_orders
FROM customer c CROSS JOIN q LEFT JOIN o ON o.o_custkey = c.c_custkey AND o.order_date <= q.end_date
GROUP BY c.c_custkey, q.end_date""",

    "j9": """SELECT c_custkey, c_name FROM customer
WHERE c_custkey IN (SELECT user_id FROM events WHERE event_type = 'purchase' AND value > 300)""",

    "j9_not_in": """SELECT c_custkey, c_name FROM customer
WHERE c_custkey NOT IN (SELECT user_id FROM events WHERE event_type = 'purchase' AND value > 300)""",

    "j10": """SELECT l_orderkey, l_linenumber, l_partkey, ship_date, l_extendedprice FROM (
  SELECT *, CAST(l_shipdate AS DATE) AS ship_date,
         rank() OVER (PARTITION BY l_orderkey ORDER BY CAST(l_shipdate AS DATE) DESC) AS rk FROM lineitem) x
WHERE rk = 1""",

    "j11": """WITH c AS (SELECT event_id, user_id, ts FROM events WHERE event_type = 'click'),
p AS (SELECT event_id, user_id, ts, value FROM events WHERE event_type = 'purchase'),
m AS (SELECT c.event_id, c.user_id, p.event_id AS next_purchase_id, p.value AS next_purchase_value,
        row_number() OVER (PARTITION BY c.event_id ORDER BY p.ts ASC NULLS LAST, p.event_id ASC) AS rn
      FROM c LEFT JOIN p ON p.user_id = c.user_id AND p.ts >= c.ts)
SELECT event_id, user_id, next_purchase_id, next_purchase_value FROM m WHERE rn = 1""",

    "j11_orders": f"""WITH {ORDERS},
m AS (SELECT a.o_orderkey, b.o_orderkey AS next_orderkey, b.o_orderstatus AS next_status, b.order_date AS next_date,
        row_number() OVER (PARTITION BY a.o_orderkey ORDER BY b.order_date ASC NULLS LAST, b.o_orderkey ASC) AS rn
      FROM o a LEFT JOIN o b ON b.o_custkey = a.o_custkey AND b.order_date > a.order_date)
SELECT o_orderkey, next_orderkey, next_status, next_date FROM m WHERE rn = 1""",

    "j12": f"""SELECT user_id, event_id, value FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn
  FROM events WHERE event_type = 'purchase' AND ts <= {T_EVENT}) x WHERE rn = 1""",

    "j12_asof": """WITH b AS (SELECT event_id, user_id, ts FROM events WHERE event_type = 'purchase'),
v AS (SELECT event_id, user_id, ts, value FROM events WHERE event_type = 'view'),
m AS (SELECT b.event_id, b.user_id, v.event_id AS prev_view_id, v.value AS prev_view_value,
        row_number() OVER (PARTITION BY b.event_id ORDER BY v.ts DESC NULLS LAST, v.event_id DESC) AS rn
      FROM b LEFT JOIN v ON v.user_id = b.user_id AND v.ts <= b.ts)
SELECT event_id, user_id, prev_view_id, prev_view_value FROM m WHERE rn = 1""",

    "j13": f"""SELECT user_id, event_id, value FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts ASC, event_id ASC) AS rn
  FROM events WHERE event_type = 'purchase' AND ts <= {T_EVENT}) x WHERE rn = 1""",

    "j14": """SELECT o.o_orderkey,
  (SELECT count(*) FROM lineitem l WHERE l.l_orderkey = o.o_orderkey) AS n_lines,
  (SELECT max(l_partkey) FROM lineitem l WHERE l.l_orderkey = o.o_orderkey) AS max_partkey
FROM orders o""",

    "j15": """SELECT l_partkey AS patient_id, l_suppkey AS related_person_id, 'supplier' AS role, l_orderkey, l_linenumber
FROM lineitem WHERE l_partkey IN (SELECT c_custkey FROM customer)
UNION ALL
SELECT l_suppkey AS patient_id, l_partkey AS related_person_id, 'part' AS role, l_orderkey, l_linenumber
FROM lineitem WHERE l_suppkey IN (SELECT c_custkey FROM customer)""",

    "j17": """SELECT l.l_orderkey, l.l_linenumber, l.l_extendedprice, r.m AS min_r_price
FROM lineitem l LEFT JOIN (SELECT l_orderkey, min(l_extendedprice) AS m FROM lineitem WHERE l_returnflag = 'R'
                           GROUP BY l_orderkey) r ON r.l_orderkey = l.l_orderkey""",

    "j18": """SELECT user_id, max(CASE WHEN rn = 1 THEN value END) AS last_value,
       max(CASE WHEN rn = 2 THEN value END) AS previous_value
FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) x
WHERE rn <= 2 GROUP BY user_id""",

    "u1": """SELECT CAST(o_orderdate AS DATE) AS d FROM orders UNION SELECT CAST(l_shipdate AS DATE) AS d FROM lineitem""",

    "u2": """SELECT o_custkey AS customer, CAST(o_orderdate AS DATE) AS d, 'finished' AS tag FROM orders WHERE o_orderstatus = 'F'
UNION ALL SELECT o_custkey, CAST(o_orderdate AS DATE), 'open' FROM orders WHERE o_orderstatus = 'O'
UNION ALL SELECT user_id, CAST(ts AS DATE), 'purchase' FROM events WHERE event_type = 'purchase'""",

    "u3": """WITH a AS (SELECT o_custkey AS customer, count(*) AS n_finished FROM orders WHERE o_orderstatus = 'F' GROUP BY 1),
b AS (SELECT o_custkey AS customer, CAST(max(o_orderdate) AS DATE) AS last_open_date FROM orders WHERE o_orderstatus = 'O' GROUP BY 1),
c AS (SELECT user_id AS customer, count(*) AS n_errors FROM events WHERE event_type = 'error' GROUP BY 1),
ab AS (SELECT coalesce(a.customer, b.customer) AS customer, a.n_finished, b.last_open_date
       FROM a FULL OUTER JOIN b ON a.customer = b.customer)
SELECT coalesce(ab.customer, c.customer) AS customer, ab.n_finished, ab.last_open_date, c.n_errors
FROM ab FULL OUTER JOIN c ON ab.customer = c.customer""",

    "u4": """SELECT o_custkey AS customer, 'BIG_ORDER' AS label FROM orders WHERE o_totalprice > 400000
UNION ALL SELECT o_custkey, 'URGENT_OPEN' FROM orders WHERE o_orderstatus = 'O' AND o_orderpriority = '1-URGENT'
UNION ALL SELECT user_id, 'ERROR_EVENT' FROM events WHERE event_type = 'error'""",

    "d_date": """WITH d AS (SELECT CAST(o_orderdate AS DATE) AS full_date FROM orders
  UNION SELECT CAST(l_shipdate AS DATE) FROM lineitem UNION SELECT CAST(ts AS DATE) FROM events)
SELECT CAST(row_number() OVER (ORDER BY full_date NULLS FIRST) AS BIGINT) AS date_id, full_date,
       CAST(year(full_date) AS INTEGER) AS year, CAST(month(full_date) AS INTEGER) AS month,
       CAST(day(full_date) AS INTEGER) AS day FROM d""",

    "x_event": """WITH e AS (SELECT *, CAST(ts AS DATE) AS event_date FROM events),
dd AS (SELECT event_date, CAST(row_number() OVER (ORDER BY event_date) AS BIGINT) AS date_id
       FROM (SELECT DISTINCT event_date FROM e) x),
dt AS (SELECT event_type, CAST(row_number() OVER (ORDER BY event_type) AS BIGINT) AS event_type_id
       FROM (SELECT DISTINCT event_type FROM e) x)
SELECT e.event_id, e.user_id AS patient_id, dd.date_id, dt.event_type_id, c.c_nationkey AS location_id, e.value
FROM e LEFT JOIN dd ON dd.event_date = e.event_date LEFT JOIN dt ON dt.event_type = e.event_type
LEFT JOIN customer c ON c.c_custkey = e.user_id""",

    "p3": """SELECT o_orderkey, o_orderstatus, o_orderpriority FROM orders
WHERE NOT coalesce(CASE WHEN o_orderstatus = 'O' THEN NULL ELSE o_orderpriority = '1-URGENT' END, false)""",

    "p6": """SELECT o_orderkey, CASE WHEN coalesce(o_totalprice > 300000, false) THEN 'big' ELSE 'rest' END AS branch
FROM orders""",

    "p7": """SELECT o_orderkey, o_custkey, o_orderpriority FROM orders
WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')
   OR o_orderpriority IN ('1-URGENT', '2-HIGH') OR o_orderpriority IS NULL""",

    "p8": """SELECT event_id, user_id, event_type FROM events WHERE event_type NOT IN ('error', 'signup') OR event_type IS NULL""",

    "p11": f"""WITH {ORDERS},
latest AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY order_date DESC, o_orderkey DESC) AS rn
  FROM o) x WHERE rn = 1)
SELECT c_custkey FROM customer
WHERE c_custkey NOT IN (SELECT o_custkey FROM latest WHERE o_orderstatus <> 'O' OR o_orderstatus IS NULL)""",

    "p12": f"""WITH {INTERVALS}
SELECT iv.o_orderkey, iv.o_custkey FROM iv JOIN customer c ON iv.o_custkey = c.c_custkey
WHERE (iv.last_ship IS NULL OR iv.last_ship > {T_ORDER}) AND iv.order_date <= {T_ORDER} AND c.c_nationkey = 7""",

    "f1": f"""SELECT l.l_orderkey, l.l_linenumber,
  CAST({full_months("CAST(o.o_orderdate AS DATE)", "CAST(l.l_shipdate AS DATE)")} AS BIGINT) AS months_to_ship,
  CAST({full_years("CAST(o.o_orderdate AS DATE)", "CAST(l.l_shipdate AS DATE)")} AS BIGINT) AS years_to_ship
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey""",

    "f2": """SELECT l.l_orderkey, l.l_linenumber,
  CAST(datediff('day', CAST(o.o_orderdate AS DATE), CAST(l.l_shipdate AS DATE)) AS INTEGER) AS days_to_ship
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey""",

    "f3": """SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) + INTERVAL 3 MONTH AS DATE) AS plus_3_months,
  CAST(CAST(o_orderdate AS DATE) + INTERVAL 45 DAY AS DATE) AS plus_45_days,
  CAST(CAST(o_orderdate AS DATE) - INTERVAL 1 MONTH AS DATE) AS minus_1_month
FROM orders""",

    "f6": """SELECT o_orderkey, CAST(date_trunc('quarter', CAST(o_orderdate AS DATE)) AS DATE) AS quarter_start,
  CAST(CAST(date_trunc('quarter', CAST(o_orderdate AS DATE)) + INTERVAL 3 MONTH AS DATE) - 1 AS DATE) AS quarter_end
FROM orders""",

    "f7": f"""SELECT o_orderkey, CAST(m AS BIGINT) AS age_months, CAST(1 + 3 * floor((m - 1) / 3) AS BIGINT) AS age_bucket
FROM (SELECT o_orderkey, {full_months("CAST(o_orderdate AS DATE)", "DATE '2002-01-01'")} AS m FROM orders) x""",

    "f12": """SELECT c_custkey, md5(CAST(c_custkey AS VARCHAR)) AS hashed_id FROM customer""",

    "f19": """SELECT c_custkey, array_to_string(list_transform(string_split(
    concat_ws(' ', substr(c_mktsegment, 1, 3), CAST(c_nationkey AS VARCHAR), CAST(c_custkey AS VARCHAR)), ' '),
    lambda p: CASE WHEN regexp_matches(p, '^\\s*[+-]?[0-9]') AND length(p) < 4 THEN lpad(p, 4, '0') ELSE p END), '-')
  AS formatted_id FROM customer""",

    "f20": """SELECT c_custkey, CAST('100' || CAST(c_custkey AS VARCHAR) AS BIGINT) AS prefixed_id FROM customer""",

    "x1": """SELECT md5(CAST(o_orderkey AS VARCHAR)) AS o_orderkey, md5(CAST(o_custkey AS VARCHAR)) AS o_custkey,
  CAST(date_trunc('quarter', CAST(o_orderdate AS DATE)) AS DATE) AS order_date, o_orderstatus FROM orders""",

    "rp2": f"""WITH {REGISTER}
SELECT c_custkey, c_mktsegment, enrollment_date, last_visit_date, next_appt_date, days_late, days_to_next FROM active""",

    "rp6": f"""WITH {REGISTER},
lo AS (SELECT o_custkey, max(CASE WHEN rn = 1 THEN o_totalprice END) AS last_value,
              max(CASE WHEN rn = 2 THEN o_totalprice END) AS previous_value
       FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY order_date DESC, o_orderkey DESC) AS rn
             FROM o WHERE order_date <= {T_ORDER}) x WHERE rn <= 2 GROUP BY o_custkey)
SELECT c_custkey, 'LATE_2_WEEKS' AS criteria FROM active WHERE days_late >= 14
UNION ALL SELECT c_custkey, 'LATE_6_WEEKS' FROM active WHERE days_late >= 42
UNION ALL SELECT c_custkey, 'NO_VISIT' FROM active WHERE last_visit_date IS NULL
UNION ALL SELECT c_custkey, 'VALUE_DOUBLED' FROM active
  WHERE c_custkey IN (SELECT o_custkey FROM lo WHERE last_value > previous_value * 2)""",

    "rp7": f"""WITH {REGISTER},
lu AS (SELECT o_custkey, order_date AS last_urgent FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY order_date DESC, o_orderkey DESC) AS rn
  FROM o WHERE order_date <= {T_ORDER} AND o_orderpriority = '1-URGENT') x WHERE rn = 1),
a AS (SELECT active.*, lu.last_urgent FROM active LEFT JOIN lu ON lu.o_custkey = active.c_custkey)
SELECT c_custkey, 'REVIEW_DUE' AS alert FROM a WHERE last_visit_date < CAST({T_ORDER} - INTERVAL 12 MONTH AS DATE)
UNION ALL SELECT c_custkey, 'URGENT_FOLLOWUP' FROM a WHERE last_urgent >= CAST({T_ORDER} - INTERVAL 3 MONTH AS DATE)
UNION ALL SELECT c_custkey, 'NO_URGENT_EVER' FROM a WHERE last_urgent IS NULL
UNION ALL SELECT c_custkey, 'APPT_THIS_MONTH' FROM a WHERE days_to_next <= 30""",

    "rp8": f"""WITH {INTERVALS}
SELECT o_custkey AS c_custkey, order_date AS last_visit_date, last_ship AS next_appt_date FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY order_date DESC, o_orderkey DESC) AS rn FROM iv) x
WHERE rn = 1""",
}

SQL.update({
    "p1": """SELECT o.o_orderkey, o.o_custkey FROM orders o
WHERE NOT (o.o_orderstatus = 'P')
  AND o.o_custkey IN (SELECT c_custkey FROM customer WHERE NOT (c_acctbal < 0))""",

    "p2": """SELECT o_orderkey, prio, status FROM (
  SELECT o_orderkey, CASE WHEN o_orderpriority <> '5-LOW' THEN o_orderpriority END AS prio,
         CASE WHEN o_orderstatus = 'P' THEN ' ' ELSE o_orderstatus END AS status FROM orders) x
WHERE prio IS NOT NULL AND status IS NOT NULL AND trim(status) <> ''""",

    "p9": """SELECT c_custkey FROM customer WHERE NOT starts_with(CAST(c_custkey AS VARCHAR), '1')""",

    "p10": """SELECT event_id, value_numeric FROM (
  SELECT event_id, CASE WHEN event_type <> 'click' THEN value END AS value_numeric FROM events) x
WHERE value_numeric IS NOT NULL""",

    "p13": """SELECT o_orderkey FROM orders WHERE lower(trim(o_orderpriority)) = '2-high'""",

    "p13_unset": """SELECT o_orderkey FROM orders""",

    "p14": """SELECT event_id FROM events WHERE lower(trim(event_type)) IN ('click', 'view')""",

    "j3": """SELECT l.l_orderkey, l.l_linenumber, coalesce(p.p_name, s.s_name) AS label
FROM lineitem l LEFT JOIN (SELECT * FROM part WHERE p_size > 25) p ON p.p_partkey = l.l_partkey
LEFT JOIN supplier s ON s.s_suppkey = l.l_suppkey""",

    "j6": """WITH d AS (SELECT order_date, CAST(row_number() OVER (ORDER BY order_date) AS BIGINT) AS date_id
           FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS order_date FROM orders) x)
SELECT o.o_orderkey, c.c_custkey, n.n_name, d.date_id
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey LEFT JOIN nation n ON n.n_nationkey = c.c_nationkey
LEFT JOIN d ON d.order_date = CAST(o.o_orderdate AS DATE)""",

    "j16": """SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem
WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE lower(trim(o_orderpriority)) = '1-urgent')""",

    "j19": """SELECT o_custkey, max(CAST(o_orderdate AS DATE)) AS last_date,
  arg_max(o_orderkey, (CAST(o_orderdate AS DATE), o_orderkey)) AS last_orderkey,
  arg_max(o_orderstatus, (CAST(o_orderdate AS DATE), o_orderkey)) AS last_status,
  arg_max(o_totalprice, (CAST(o_orderdate AS DATE), o_orderkey)) AS last_price
FROM orders GROUP BY o_custkey""",

    "a18": """SELECT DISTINCT o_custkey, o_orderstatus FROM orders""",

    "a20": """SELECT count(*) AS n_rows FROM lineitem""",

    "f4": """SELECT event_id, CAST(ts AS DATE) AS event_date, strftime(ts, '%H:%M:%S') AS event_time FROM events""",

    "f5": """SELECT event_id, CAST(year(ts) AS INTEGER) AS y, CAST(month(ts) AS INTEGER) AS m,
  CAST(day(ts) AS INTEGER) AS d, CAST(hour(ts) AS INTEGER) AS hh, CAST(minute(ts) AS INTEGER) AS mi,
  CAST(second(ts) AS INTEGER) AS ss FROM events""",

    "f10": """SELECT c_custkey,
  concat_ws(' ', c_name, CASE WHEN c_mktsegment <> 'BUILDING' THEN c_mktsegment END) AS joined,
  c_name || '-' || CASE WHEN c_mktsegment <> 'BUILDING' THEN c_mktsegment END AS strict FROM customer""",

    "f13": """SELECT c_custkey, substr(c_name, 2, 4) AS cut FROM customer""",

    "f14": f"""WITH {INTERVALS}
SELECT o_orderkey, CASE WHEN last_ship IS NULL THEN order_date ELSE greatest(order_date, last_ship) END AS latest_date
FROM iv""",

    "f16": f"""WITH {INTERVALS}
SELECT o_orderkey, CAST(datediff('day', order_date, last_ship) % 7 AS INTEGER) AS weekday_gap
FROM iv""",

    "f17": """SELECT l_orderkey, l_linenumber,
  l_extendedprice + l_tax + CASE WHEN l_discount <> 0 THEN l_discount END AS total FROM lineitem""",

    "f18": """SELECT event_id, '<' || CASE WHEN value = floor(value) THEN CAST(CAST(value AS DECIMAL(38, 0)) AS VARCHAR)
  ELSE CAST(value AS VARCHAR) END AS below FROM events""",

    "f22": """SELECT c.c_custkey, coalesce(
    CASE WHEN trim(CASE WHEN c.c_acctbal > 0 THEN c.c_name END) = '' THEN NULL
         ELSE CASE WHEN c.c_acctbal > 0 THEN c.c_name END END,
    CASE WHEN trim(CASE WHEN c.c_nationkey < 5 THEN n.n_name END) = '' THEN NULL
         ELSE CASE WHEN c.c_nationkey < 5 THEN n.n_name END END,
    'Unknown') AS display
FROM customer c LEFT JOIN nation n ON n.n_nationkey = c.c_nationkey""",

    "s11": """SELECT o_orderkey FROM orders
WHERE CAST(o_orderdate AS DATE) >= DATE '1998-01-01' AND CAST(o_orderdate AS DATE) < DATE '1999-01-01'""",

    "d_time": """SELECT CAST(row_number() OVER (ORDER BY full_time) AS BIGINT) AS time_id, full_time,
  CAST(substr(full_time, 1, 2) AS INTEGER) AS hour, CAST(substr(full_time, 4, 2) AS INTEGER) AS minute,
  CAST(substr(full_time, 7, 2) AS INTEGER) AS second
FROM (SELECT DISTINCT strftime(ts, '%H:%M:%S') AS full_time FROM events) x""",

    "d_age": f"""WITH a AS (SELECT DISTINCT
    CAST({full_years("CAST(o.o_orderdate AS DATE)", "CAST(l.l_shipdate AS DATE)")} AS BIGINT) AS full_years,
    CAST({full_months("CAST(o.o_orderdate AS DATE)", "CAST(l.l_shipdate AS DATE)")} AS BIGINT) AS full_months
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey)
SELECT full_years, full_months,
  CAST(row_number() OVER (ORDER BY full_years NULLS FIRST, full_months NULLS FIRST) AS BIGINT) AS age_id FROM a""",

    "d_loc": """SELECT CAST(row_number() OVER (ORDER BY name) AS BIGINT) AS location_id, name
FROM (SELECT min(n_name) AS name FROM nation GROUP BY lower(trim(n_name))) x""",

    "d_etype": """SELECT CAST(row_number() OVER (ORDER BY name) AS BIGINT) AS encounter_type_id, name
FROM (SELECT min(o_orderpriority) AS name FROM orders GROUP BY lower(trim(o_orderpriority))) x""",

    "r_cvis": """SELECT patient_id, encounter_date, CAST(patient_id AS VARCHAR) || '-' || strftime(encounter_date, '%Y-%m-%d') AS visit_id
FROM (SELECT DISTINCT user_id AS patient_id, CAST(ts AS DATE) AS encounter_date FROM events) x""",

    "r_east": """SELECT o.o_orderkey, coalesce(m.target, o.o_orderpriority) AS o_orderpriority
FROM orders o LEFT JOIN (VALUES ('1-urgent', 'URGENT'), ('2-high', 'HIGH'), ('5-low', 'LOW')) m(source, target)
  ON lower(trim(o.o_orderpriority)) = m.source""",

    "x2": """SELECT md5(CAST(o_orderkey AS VARCHAR)) AS o_orderkey, md5(CAST(o_custkey AS VARCHAR)) AS o_custkey,
  CAST(o_orderdate AS DATE) AS order_date, o_orderstatus FROM orders""",

    "x5": """SELECT DISTINCT o.o_custkey AS patient_id, l.l_suppkey AS fosa_id
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey""",
})

# Warehouse jobs over the EMR source derived from the test tables (testbed_emr).
EMR_BIRTH = "CAST(DATE '1940-01-01' + to_months(CAST(c.c_nationkey * 13 AS INTEGER)) AS DATE)"

SQL.update({
    "emr_patient": f"""SELECT c.c_custkey AS patient_id, md5(CAST(c.c_custkey AS VARCHAR)) AS patient_uuid,
  CAST(NULL AS VARCHAR) AS identifier, c.c_name AS first_name, CAST(NULL AS VARCHAR) AS middle_name,
  c.c_mktsegment AS last_name, CASE WHEN c.c_acctbal >= 0 THEN 'F' ELSE 'M' END AS gender, {EMR_BIRTH} AS birthdate,
  false AS birthdate_estimated, CAST(NULL AS VARCHAR) AS phone_number, CAST(NULL AS VARCHAR) AS country,
  CAST(NULL AS VARCHAR) AS state_province, CAST(NULL AS VARCHAR) AS county_district,
  CAST(NULL AS VARCHAR) AS city_village, CAST(NULL AS VARCHAR) AS postal_code, CAST(NULL AS VARCHAR) AS address1,
  CAST(NULL AS VARCHAR) AS address2, CAST(NULL AS VARCHAR) AS address3, CAST(NULL AS VARCHAR) AS address4,
  CAST(NULL AS VARCHAR) AS address5, CAST(NULL AS VARCHAR) AS address6, CAST(NULL AS VARCHAR) AS latitude,
  CAST(NULL AS VARCHAR) AS longitude, false AS dead, CAST(NULL AS DATE) AS death_date,
  CAST(NULL AS BIGINT) AS age_years_at_death, CAST(NULL AS BIGINT) AS age_months_at_death,
  CAST(NULL AS VARCHAR) AS cause_of_death, CAST(NULL AS VARCHAR) AS mothers_name,
  CAST(NULL AS VARCHAR) AS fathers_name, CAST(NULL AS VARCHAR) AS health_center, DATE '2000-01-01' AS date_created
FROM customer c""",

    "emr_encounter": f"""SELECT o.o_orderkey AS encounter_id, md5('e' || CAST(o.o_orderkey AS VARCHAR)) AS uuid,
  o.o_custkey AS patient_id, o.o_orderpriority AS encounter_type, CAST(NULL AS VARCHAR) AS form,
  n.n_name AS location, CAST(o.o_orderdate AS DATE) AS encounter_date, strftime(o.o_orderdate, '%H:%M:%S') AS encounter_time,
  CAST(NULL AS VARCHAR) AS provider, CAST(NULL AS VARCHAR) AS provider_role, CAST(NULL AS BIGINT) AS visit_id,
  CAST({full_years(EMR_BIRTH, "CAST(o.o_orderdate AS DATE)")} AS BIGINT) AS age_years_at_encounter,
  CAST({full_months(EMR_BIRTH, "CAST(o.o_orderdate AS DATE)")} AS BIGINT) AS age_months_at_encounter,
  CAST(o.o_orderdate AS DATE) AS date_created, CAST(NULL AS VARCHAR) AS created_by
FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey LEFT JOIN nation n ON n.n_nationkey = c.c_nationkey""",

    "emr_urgent_visits": """WITH e AS (
  SELECT o.o_orderkey, o.o_custkey AS patient_id, CAST(o.o_orderdate AS DATE) AS visit_date, n.n_name AS location,
         o.o_orderstatus, o.o_orderpriority
  FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey LEFT JOIN nation n ON n.n_nationkey = c.c_nationkey),
sp AS (SELECT DISTINCT patient_id, visit_date, location FROM e WHERE o_orderpriority = '1-URGENT'),
lv AS (SELECT e.patient_id, e.visit_date, e.location,
         min(CASE WHEN l.l_returnflag = 'A' THEN l.l_extendedprice END) AS min_price_a,
         min(CASE WHEN l.l_returnflag = 'N' THEN l.l_extendedprice END) AS min_price_n,
         min(CASE WHEN l.l_returnflag = 'R' THEN l.l_extendedprice END) AS min_price_r,
         count(l.l_extendedprice) AS n_lines
       FROM lineitem l JOIN e ON e.o_orderkey = l.l_orderkey WHERE e.o_orderpriority = '1-URGENT'
       GROUP BY e.patient_id, e.visit_date, e.location),
st AS (SELECT patient_id, visit_date, location, arg_min(o_orderstatus, o_orderkey) AS status
       FROM e WHERE o_orderpriority = '1-URGENT' GROUP BY patient_id, visit_date, location)
SELECT CAST(row_number() OVER (ORDER BY sp.patient_id, sp.visit_date, sp.location) AS BIGINT) AS urgent_visit_id,
  sp.patient_id, sp.visit_date, sp.location, lv.min_price_a, lv.min_price_n, lv.min_price_r, st.status,
  CAST(coalesce(lv.n_lines, 0) AS BIGINT) AS n_lines
FROM sp LEFT JOIN lv ON lv.patient_id = sp.patient_id AND lv.visit_date = sp.visit_date AND lv.location = sp.location
LEFT JOIN st ON st.patient_id = sp.patient_id AND st.visit_date = sp.visit_date AND st.location = sp.location""",
})

SQL.update({
    "rp9": f"""WITH {INTERVALS},
o AS (SELECT *, CAST(o_orderdate AS DATE) AS order_date FROM orders),
latest_o AS (SELECT o_custkey, CASE WHEN o_orderstatus = 'F' THEN order_date END AS completion_date FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY order_date DESC, o_orderkey DESC) AS rn FROM o) x
  WHERE rn = 1),
act AS (SELECT o_custkey FROM latest_o WHERE completion_date IS NULL OR completion_date > DATE '1998-09-30'),
lastv AS (SELECT * FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY order_date DESC, o_orderkey DESC) AS rn
  FROM iv WHERE last_ship IS NOT NULL) x WHERE rn = 1)
SELECT o_custkey AS c_custkey, order_date AS last_visit_date, last_ship AS last_appt_date FROM lastv
WHERE o_custkey IN (SELECT o_custkey FROM act) AND last_ship >= DATE '1998-07-01' AND last_ship <= DATE '1998-09-30'""",

    "rp10": f"""WITH o AS (SELECT *, CAST(o_orderdate AS DATE) AS order_date FROM orders),
p AS (SELECT o_custkey,
  min(CASE WHEN o_orderstatus = 'F' AND order_date <= {T_ORDER} THEN order_date END) AS first_finished,
  max(CASE WHEN o_orderstatus = 'O' AND order_date <= {T_ORDER} THEN order_date END) AS last_open,
  max(CASE WHEN o_orderpriority = '1-URGENT' AND order_date <= {T_ORDER} THEN order_date END) AS last_urgent_date,
  arg_max(CASE WHEN o_orderpriority = '1-URGENT' AND order_date <= {T_ORDER} THEN o_totalprice END,
          CASE WHEN o_orderpriority = '1-URGENT' AND order_date <= {T_ORDER} THEN (order_date, o_orderkey) END)
    AS last_urgent_price
  FROM o GROUP BY o_custkey)
SELECT o_custkey AS c_custkey, first_finished, last_open, last_urgent_date, last_urgent_price,
  CASE WHEN last_open IS NULL THEN last_urgent_date WHEN last_urgent_date IS NULL THEN last_open
       ELSE greatest(last_open, last_urgent_date) END AS latest_activity
FROM p""",
})

EMR_STATES = f"""od AS (SELECT ox.*, CAST(ox.o_orderdate AS DATE) AS d, cx.c_mktsegment, cx.c_nationkey,
         CAST(DATE '1940-01-01' + to_months(CAST(cx.c_nationkey * 13 AS INTEGER)) AS DATE) AS bd
       FROM orders ox JOIN customer cx ON cx.c_custkey = ox.o_custkey),
st AS (SELECT a.*, (SELECT min(b.d) FROM od b WHERE b.o_custkey = a.o_custkey AND b.d > a.d) AS nd FROM od a)"""

SQL.update({
    "emr_state": f"""WITH {EMR_STATES}
SELECT st.o_orderkey AS program_state_id, md5('ps' || CAST(st.o_orderkey AS VARCHAR)) AS uuid,
  st.o_custkey AS program_enrollment_id, st.o_custkey AS patient_id, st.c_mktsegment AS program,
  'order status' AS workflow, st.o_orderstatus AS state, st.d AS start_date,
  CAST({full_years("st.bd", "st.d")} AS BIGINT) AS age_years_at_start,
  CAST({full_months("st.bd", "st.d")} AS BIGINT) AS age_months_at_start, st.nd AS end_date,
  CAST(CASE WHEN st.nd IS NULL THEN NULL ELSE {full_years("st.bd", "st.nd")} END AS BIGINT) AS age_years_at_end,
  CAST(CASE WHEN st.nd IS NULL THEN NULL ELSE {full_months("st.bd", "st.nd")} END AS BIGINT) AS age_months_at_end,
  n.n_name AS location
FROM st LEFT JOIN nation n ON n.n_nationkey = st.c_nationkey""",

    "emr_register": f"""WITH {EMR_STATES},
done AS (SELECT o_custkey, CAST(max(CASE WHEN o_orderstatus = 'F' THEN o_orderdate END) AS DATE) AS completion
         FROM orders GROUP BY o_custkey)
SELECT st.o_orderkey AS episode_id, st.o_custkey AS program_enrollment_id, st.o_custkey AS patient_id,
  n.n_name AS location, st.d AS start_date, coalesce(st.nd, done.completion) AS end_date,
  (SELECT arg_min(c.o_orderstatus, c.o_orderkey) FROM od c WHERE c.o_custkey = st.o_custkey AND c.d = st.nd) AS outcome
FROM st JOIN done ON done.o_custkey = st.o_custkey LEFT JOIN nation n ON n.n_nationkey = st.c_nationkey
WHERE st.o_orderstatus = 'O'""",
})

SQL.update({
    "emr_dim_date": """WITH d AS (
  SELECT CAST(DATE '1940-01-01' + to_months(CAST(c_nationkey * 13 AS INTEGER)) AS DATE) AS full_date FROM customer
  UNION SELECT CAST(o_orderdate AS DATE) FROM orders
  UNION SELECT CAST(l_shipdate AS DATE) FROM lineitem
  UNION SELECT CAST(ts AS DATE) FROM events
  UNION SELECT CAST(max(CASE WHEN o_orderstatus = 'F' THEN o_orderdate END) AS DATE) FROM orders GROUP BY o_custkey
  UNION SELECT CAST(NULL AS DATE))
SELECT CAST(row_number() OVER (ORDER BY full_date NULLS FIRST) AS BIGINT) AS date_id, full_date,
  CAST(year(full_date) AS INTEGER) AS year, CAST(month(full_date) AS INTEGER) AS month,
  CAST(day(full_date) AS INTEGER) AS day FROM d""",
})

SQL.update({
    "emr_latest_per_period": """WITH w AS (SELECT CAST(DATE '2024-01-01' + INTERVAL (7 * i + 6) DAY AS DATE) AS end_date
                                FROM range(5) t(i)),
coh AS (SELECT c_custkey AS patient_id FROM customer
        WHERE c_mktsegment = 'BUILDING' AND c_custkey IN (SELECT o_custkey FROM orders)),
p AS (SELECT user_id AS patient_id, event_id AS obs_id, CAST(ts AS DATE) AS d, value FROM events
      WHERE event_type = 'purchase' AND user_id IN (SELECT c_custkey FROM customer)),
j AS (SELECT coh.patient_id, w.end_date, p.obs_id, p.d, p.value,
        row_number() OVER (PARTITION BY coh.patient_id, w.end_date ORDER BY p.d DESC NULLS LAST, p.obs_id ASC) AS rn
      FROM coh CROSS JOIN w LEFT JOIN p ON p.patient_id = coh.patient_id AND p.d <= w.end_date)
SELECT patient_id, CASE WHEN obs_id IS NULL THEN NULL ELSE 'purchase' END AS concept, obs_id, end_date,
  d AS last_obs_date, CAST(NULL AS VARCHAR) AS encounter_type, CAST(NULL AS VARCHAR) AS location,
  CAST(NULL AS VARCHAR) AS value_coded, CAST(NULL AS DATE) AS value_date, value AS value_numeric,
  CAST(NULL AS VARCHAR) AS value_text, CAST(NULL AS BIGINT) AS obs_group_id
FROM j WHERE rn = 1""",
})

SQL.update({
    "emr_calculated_visit": """SELECT DISTINCT o_custkey AS patient_id, CAST(o_orderdate AS DATE) AS encounter_date,
  CAST(o_custkey AS VARCHAR) || '-' || strftime(CAST(o_orderdate AS DATE), '%Y-%m-%d') AS visit_id
FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer)""",

    "emr_mw_patient": f"""SELECT c.c_custkey AS patient_id, CAST(NULL AS VARCHAR) AS identifier, c.c_name AS first_name,
  c.c_mktsegment AS last_name, CASE WHEN c.c_acctbal >= 0 THEN 'F' ELSE 'M' END AS gender, {EMR_BIRTH} AS birthdate,
  false AS birthdate_estimated, CAST(NULL AS VARCHAR) AS phone_number, CAST(NULL AS VARCHAR) AS district,
  CAST(NULL AS VARCHAR) AS traditional_authority, CAST(NULL AS VARCHAR) AS village, CAST(NULL AS VARCHAR) AS chw,
  false AS dead, CAST(NULL AS DATE) AS death_date, md5(CAST(c.c_custkey AS VARCHAR)) AS patient_uuid
FROM customer c""",

    "emr_anonymised_encounter": f"""SELECT md5(CAST(o.o_orderkey AS VARCHAR)) AS encounter_id,
  md5(md5('e' || CAST(o.o_orderkey AS VARCHAR))) AS uuid, md5(CAST(o.o_custkey AS VARCHAR)) AS patient_id,
  o.o_orderpriority AS encounter_type, CAST(NULL AS VARCHAR) AS form, n.n_name AS location,
  CAST(date_trunc('quarter', CAST(o.o_orderdate AS DATE)) AS DATE) AS encounter_date,
  strftime(o.o_orderdate, '%H:%M:%S') AS encounter_time, CAST(NULL AS VARCHAR) AS provider_role,
  CAST(NULL AS VARCHAR) AS visit_id,
  CAST({full_years(EMR_BIRTH, "CAST(o.o_orderdate AS DATE)")} AS BIGINT) AS age_years_at_encounter,
  CAST(1 + 3 * floor(({full_months(EMR_BIRTH, "CAST(o.o_orderdate AS DATE)")} - 1) / 3) AS BIGINT) AS age_months_at_encounter,
  CAST(date_trunc('quarter', CAST(o.o_orderdate AS DATE)) AS DATE) AS date_created
FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey LEFT JOIN nation n ON n.n_nationkey = c.c_nationkey""",
})


def _emr_age(at: str) -> str:
    return (f"CAST({full_years('bd', at)} AS BIGINT) AS full_years, "
            f"CAST({full_months('bd', at)} AS BIGINT) AS full_months")


EMR_STAR = f"""pc AS (SELECT c.c_custkey AS patient_id, c.c_mktsegment AS program, n.n_name AS location,
         CASE WHEN c.c_acctbal >= 0 THEN 'F' ELSE 'M' END AS gender, {EMR_BIRTH} AS bd
       FROM customer c LEFT JOIN nation n ON n.n_nationkey = c.c_nationkey),
oc AS (SELECT o.o_orderkey, o.o_orderpriority, o.o_orderstatus, CAST(o.o_orderdate AS DATE) AS d, pc.*
       FROM orders o JOIN pc ON pc.patient_id = o.o_custkey),
enr AS (SELECT patient_id, program, location, gender, bd, min(d) AS enrolled,
               max(CASE WHEN o_orderstatus = 'F' THEN d END) AS completed FROM oc
        GROUP BY patient_id, program, location, gender, bd),
nxt AS (SELECT a.*, (SELECT min(b.d) FROM oc b WHERE b.patient_id = a.patient_id AND b.d > a.d) AS nd FROM oc a),
lines AS (SELECT CAST(l.l_shipdate AS DATE) AS d, oc.bd FROM lineitem l JOIN oc ON oc.o_orderkey = l.l_orderkey),
evs AS (SELECT CAST(e.ts AS DATE) AS d, strftime(e.ts, '%H:%M:%S') AS t, pc.bd
        FROM events e JOIN pc ON pc.patient_id = e.user_id),
ages AS (SELECT {_emr_age('enrolled')} FROM enr
         UNION SELECT {_emr_age('completed')} FROM enr WHERE completed IS NOT NULL
         UNION SELECT {_emr_age('d')} FROM oc
         UNION SELECT {_emr_age('nd')} FROM nxt WHERE nd IS NOT NULL
         UNION SELECT {_emr_age('d')} FROM lines
         UNION SELECT {_emr_age('d')} FROM evs),
dim_age AS (SELECT *, CAST(row_number() OVER (ORDER BY full_years NULLS FIRST, full_months NULLS FIRST) AS BIGINT) AS age_id
            FROM ages),
dates AS (SELECT bd AS full_date FROM pc UNION SELECT d FROM oc UNION SELECT completed FROM enr
          UNION SELECT d FROM lines UNION SELECT d FROM evs UNION SELECT CAST(NULL AS DATE)),
dim_date AS (SELECT full_date, CAST(row_number() OVER (ORDER BY full_date NULLS FIRST) AS BIGINT) AS date_id FROM dates),
times AS (SELECT '00:00:00' AS full_time UNION SELECT t FROM evs),
dim_time AS (SELECT full_time, CAST(row_number() OVER (ORDER BY full_time) AS BIGINT) AS time_id FROM times),
dim_loc AS (SELECT name, CAST(row_number() OVER (ORDER BY name) AS BIGINT) AS location_id FROM (
            SELECT min(n_name) AS name FROM nation GROUP BY lower(trim(n_name))) x),
dim_prog AS (SELECT name, CAST(row_number() OVER (ORDER BY name) AS BIGINT) AS program_id FROM (
             SELECT min(program) AS name FROM enr GROUP BY lower(trim(program))) x),
dim_et AS (SELECT name, CAST(row_number() OVER (ORDER BY name) AS BIGINT) AS encounter_type_id FROM (
           SELECT min(o_orderpriority) AS name FROM oc GROUP BY lower(trim(o_orderpriority))) x),
g AS (SELECT * FROM (VALUES ('M', 1), ('F', 2)) t(code, gender_id))"""

SQL.update({
    "emr_fact_event": f"""WITH {EMR_STAR}
SELECT pc.patient_id, CAST(g.gender_id AS BIGINT) AS gender_id, CAST(NULL AS BIGINT) AS age_id, dd.date_id,
  CAST(NULL AS BIGINT) AS time_id, CAST(NULL AS BIGINT) AS location_id, CAST(NULL AS BIGINT) AS program_id,
  CAST(NULL AS BIGINT) AS encounter_type_id, CAST(4 AS BIGINT) AS event_id
FROM pc LEFT JOIN g ON g.code = pc.gender LEFT JOIN dim_date dd ON dd.full_date = pc.bd
UNION ALL
SELECT oc.patient_id, g.gender_id, a.age_id, dd.date_id, t.time_id, l.location_id, NULL, et.encounter_type_id, 3
FROM oc JOIN dim_et et ON lower(trim(et.name)) = lower(trim(oc.o_orderpriority))
LEFT JOIN g ON g.code = oc.gender
LEFT JOIN dim_age a ON a.full_years = {full_years('oc.bd', 'oc.d')} AND a.full_months = {full_months('oc.bd', 'oc.d')}
LEFT JOIN dim_date dd ON dd.full_date = oc.d LEFT JOIN dim_time t ON t.full_time = '00:00:00'
LEFT JOIN dim_loc l ON lower(trim(l.name)) = lower(trim(oc.location))
UNION ALL
SELECT e.patient_id, g.gender_id, a.age_id, dd.date_id, NULL, l.location_id, p.program_id, NULL, 1
FROM enr e JOIN dim_prog p ON lower(trim(p.name)) = lower(trim(e.program))
LEFT JOIN g ON g.code = e.gender
LEFT JOIN dim_age a ON a.full_years = {full_years('e.bd', 'e.enrolled')} AND a.full_months = {full_months('e.bd', 'e.enrolled')}
LEFT JOIN dim_date dd ON dd.full_date = e.enrolled LEFT JOIN dim_loc l ON lower(trim(l.name)) = lower(trim(e.location))
UNION ALL
SELECT e.patient_id, g.gender_id, a.age_id, dd.date_id, NULL, l.location_id, p.program_id, NULL, 2
FROM enr e JOIN dim_prog p ON lower(trim(p.name)) = lower(trim(e.program))
LEFT JOIN g ON g.code = e.gender
LEFT JOIN dim_age a ON a.full_years = {full_years('e.bd', 'e.completed')} AND a.full_months = {full_months('e.bd', 'e.completed')}
LEFT JOIN dim_date dd ON dd.full_date = e.completed LEFT JOIN dim_loc l ON lower(trim(l.name)) = lower(trim(e.location))
WHERE e.completed IS NOT NULL""",
})

SQL.update({
    "emr_fact_numeric": f"""WITH {EMR_STAR},
nq AS (SELECT name, CAST(row_number() OVER (ORDER BY name) AS BIGINT) AS numeric_question_id FROM (
         SELECT min(v) AS name FROM (SELECT l_returnflag AS v FROM lineitem UNION ALL SELECT event_type FROM events) x
         GROUP BY lower(trim(v))) y),
obs AS (SELECT oc.patient_id, oc.gender, oc.bd, CAST(l.l_shipdate AS DATE) AS d, '00:00:00' AS t, oc.location,
               oc.o_orderpriority AS etype, l.l_returnflag AS concept, l.l_extendedprice AS v
        FROM lineitem l JOIN oc ON oc.o_orderkey = l.l_orderkey
        UNION ALL
        SELECT pc.patient_id, pc.gender, pc.bd, CAST(e.ts AS DATE), strftime(e.ts, '%H:%M:%S'), CAST(NULL AS VARCHAR),
               CAST(NULL AS VARCHAR), e.event_type, e.value
        FROM events e JOIN pc ON pc.patient_id = e.user_id)
SELECT obs.patient_id, CAST(g.gender_id AS BIGINT) AS gender_id, a.age_id, dd.date_id, t.time_id, l.location_id,
  CAST(NULL AS BIGINT) AS program_id, et.encounter_type_id, nq.numeric_question_id, obs.v AS numeric_value
FROM obs JOIN nq ON lower(trim(nq.name)) = lower(trim(obs.concept))
LEFT JOIN g ON g.code = obs.gender
LEFT JOIN dim_age a ON a.full_years = {full_years('obs.bd', 'obs.d')} AND a.full_months = {full_months('obs.bd', 'obs.d')}
LEFT JOIN dim_date dd ON dd.full_date = obs.d LEFT JOIN dim_time t ON t.full_time = obs.t
LEFT JOIN dim_loc l ON lower(trim(l.name)) = lower(trim(obs.location))
LEFT JOIN dim_et et ON lower(trim(et.name)) = lower(trim(obs.etype))""",
})

SQL.update({
    "emr_active_cohort": f"""WITH {EMR_STATES},
done AS (SELECT o_custkey, CAST(max(CASE WHEN o_orderstatus = 'F' THEN o_orderdate END) AS DATE) AS completion
         FROM orders GROUP BY o_custkey),
reg AS (SELECT st.o_custkey AS patient_id, coalesce(st.nd, done.completion) AS end_date
        FROM st JOIN done ON done.o_custkey = st.o_custkey WHERE st.o_orderstatus = 'O'),
act AS (SELECT DISTINCT patient_id FROM reg WHERE end_date IS NULL OR end_date > {T_ORDER}),
appt AS (SELECT l_orderkey, CAST(max(l_shipdate) AS DATE) AS a FROM lineitem GROUP BY l_orderkey),
vis AS (SELECT o.o_custkey AS patient_id, CAST(o.o_orderdate AS DATE) AS visit_date, min(appt.a) AS next_appt
        FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey LEFT JOIN appt ON appt.l_orderkey = o.o_orderkey
        GROUP BY o.o_custkey, CAST(o.o_orderdate AS DATE)),
lastv AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY patient_id ORDER BY visit_date DESC) AS rn
                         FROM vis WHERE visit_date <= {T_ORDER}) x WHERE rn = 1)
SELECT act.patient_id, lastv.visit_date AS last_visit_date,
  CAST(datediff('day', lastv.visit_date, {T_ORDER}) AS INTEGER) AS last_visit_days, lastv.next_appt AS last_appt_date,
  CASE WHEN lastv.next_appt < {T_ORDER} THEN CAST(datediff('day', lastv.next_appt, {T_ORDER}) AS INTEGER) END AS days_late_appt,
  CASE WHEN lastv.next_appt >= {T_ORDER} THEN CAST(datediff('day', {T_ORDER}, lastv.next_appt) AS INTEGER) END AS days_to_next_appt
FROM act LEFT JOIN lastv ON lastv.patient_id = act.patient_id""",
})

# The derived observations: order lines, events, one status and one appointment an order.
EMR_OBS = f"""obs AS (
  SELECT 1152921504606846976 + CAST('0x' || substr(md5(concat_ws('|', l_orderkey, l_linenumber, l_partkey, l_suppkey,
           strftime(l_shipdate, '%Y-%m-%d'), l_returnflag, l_linestatus)), 1, 15) AS BIGINT) AS obs_id,
         o.o_custkey AS person_id, l_orderkey AS encounter_id, l_returnflag AS concept, l_shipdate AS at,
         l_extendedprice AS num, CAST(NULL AS VARCHAR) AS coded, CAST(NULL AS DATE) AS day, l_shipdate AS made
  FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey
  UNION ALL SELECT event_id, user_id, NULL, event_type, ts, value, NULL, NULL, ts FROM events
  UNION ALL SELECT 2000000000000 + o_orderkey, o_custkey, o_orderkey, 'order status', o_orderdate, NULL, o_orderstatus, NULL,
         o_orderdate FROM orders
  UNION ALL SELECT 3000000000000 + o.o_orderkey, o.o_custkey, o.o_orderkey, 'Appointment date', o.o_orderdate, NULL, NULL,
         CAST(x.last AS DATE), o.o_orderdate
  FROM orders o JOIN (SELECT l_orderkey, max(l_shipdate) AS last FROM lineitem GROUP BY l_orderkey) x ON x.l_orderkey = o.o_orderkey),
eo AS (SELECT obs.obs_id, CAST(NULL AS VARCHAR) AS uuid, obs.person_id AS patient_id, obs.encounter_id,
  CAST(obs.at AS DATE) AS obs_date, strftime(obs.at, '%H:%M:%S') AS obs_time,
  CAST({full_years(EMR_BIRTH, "CAST(obs.at AS DATE)")} AS BIGINT) AS age_years_at_obs,
  CAST({full_months(EMR_BIRTH, "CAST(obs.at AS DATE)")} AS BIGINT) AS age_months_at_obs,
  e.o_orderpriority AS encounter_type, CAST(NULL AS VARCHAR) AS form, n.n_name AS location, obs.concept,
  obs.coded AS value_coded, obs.day AS value_date, obs.num AS value_numeric, CAST(NULL AS VARCHAR) AS value_text,
  CAST(NULL AS VARCHAR) AS comments, CAST(NULL AS BIGINT) AS obs_group_id, CAST(obs.made AS DATE) AS date_created
  FROM obs JOIN customer c ON c.c_custkey = obs.person_id LEFT JOIN orders e ON e.o_orderkey = obs.encounter_id
  LEFT JOIN customer ec ON ec.c_custkey = e.o_custkey LEFT JOIN nation n ON n.n_nationkey = ec.c_nationkey)"""

SQL.update({
    "emr_obs": f"WITH {EMR_OBS} SELECT * FROM eo",

    # a row counts from its own quarter's end (rows before the first quarter from the first) until the next quarter that has rows
    "emr_last_obs": f"""WITH {QUARTERS}, {EMR_OBS},
s AS MATERIALIZED (SELECT *, greatest(CAST(date_trunc('quarter', obs_date) + to_months(3) AS DATE) - 1, (SELECT min(end_date) FROM q)) AS own
  FROM eo WHERE concept IN ('purchase', 'R')),
l AS (SELECT patient_id, concept, own, max(obs_date) AS last FROM s GROUP BY patient_id, concept, own),
n AS (SELECT *, lead(own) OVER (PARTITION BY patient_id, concept ORDER BY own) AS nxt FROM l)
SELECT n.patient_id, n.concept, s.obs_id, q.end_date, s.obs_date AS last_obs_date, s.encounter_type, s.location,
  s.value_coded, s.value_date, s.value_numeric, s.value_text, s.obs_group_id
FROM n JOIN s ON s.patient_id = n.patient_id AND s.concept = n.concept AND s.own = n.own AND s.obs_date = n.last
JOIN q ON q.end_date >= n.own AND (n.nxt IS NULL OR q.end_date < n.nxt)""",
})
