"""The catalogue's queries as DuckDB SQL, written against the same tables and independently of them.

Money is exact until the last step: averages are rounded half up over whole cents.
"""

from __future__ import annotations

SEP, NULL_MARK = "chr(31)", "chr(30)"
DAY1, DAY2 = "2025-01-01 00:00:00", "2025-01-02 00:00:00"


def cents(expr: str) -> str:
    return f"CAST({expr} * 100 AS HUGEINT)"


def average(total: str, n: str) -> str:
    return f"CAST((2 * {cents(total)} + {n}) // (2 * {n}) AS DOUBLE) / 100"


def row_hash(*exprs: str) -> str:
    parts = ", ".join(f"coalesce(CAST({e} AS VARCHAR), {NULL_MARK})" for e in exprs)
    return f"sha1(concat_ws({SEP}, {parts}))"


def text(expr: str) -> str:
    return f"CAST({expr} AS VARCHAR)"


# -- facts and KPI marts ---------------------------------------------------------------------------

STATUS = "CASE o_orderstatus WHEN 'F' THEN 'Delivered' WHEN 'O' THEN 'Pending' WHEN 'P' THEN 'Processing' END"

FACT = """
    SELECT l_orderkey * 10 + l_linenumber AS item, l_orderkey AS ord, l_partkey AS part_id, l_suppkey AS supp_id,
           o_custkey AS cust_id, CAST(o_orderdate AS DATE) AS d, o_orderstatus AS status,
           CAST(l_extendedprice AS DECIMAL(18,2)) AS subtotal
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey
"""

KPIS = f"""
    CAST(sum(subtotal) AS DOUBLE) AS total_revenue,
    count(DISTINCT ord) AS total_orders,
    {average('sum(subtotal)', 'count(DISTINCT ord)')} AS avg_revenue_per_order,
    {average('sum(subtotal)', 'count(item)')} AS avg_revenue_per_item,
    CAST(max(subtotal) AS DOUBLE) AS max_order_value
"""

Y = "CAST(year(d) AS INTEGER)"
M = "CAST(month(d) AS INTEGER)"


def mart(by: dict[str, str], where: str = "true", fact: str = FACT, joins: str = "") -> str:
    keys = ", ".join(f"{e} AS {n}" for n, e in by.items())
    return f"SELECT {keys}, {KPIS} FROM ({fact}) f {joins} WHERE {where} GROUP BY {', '.join(by.values())}"


DELIVERED = "status = 'F'"
YEARLY = mart({"year": Y}, DELIVERED)
MONTHLY = mart({"year": Y, "month": M}, DELIVERED)
BY_SUPPLIER = mart(
    {"year": Y, "month": M, "delivery_status": "status", "restaurant_name": "s_name"},
    joins="JOIN supplier ON s_suppkey = supp_id",
)
DEDUPED = f"SELECT item, ord, d, max(subtotal) AS subtotal FROM ({FACT}) WHERE {DELIVERED} GROUP BY item, ord, d"

DATE_COLUMNS = f"""
    {row_hash('d')} AS date_dim_hk, {text('d')} AS calendar_date, CAST(year(d) AS INTEGER) AS year,
    CAST(quarter(d) AS INTEGER) AS quarter, CAST(month(d) AS INTEGER) AS month, CAST(week(d) AS INTEGER) AS week,
    CAST(dayofyear(d) AS INTEGER) AS day_of_year, CAST(dayofweek(d) + 1 AS INTEGER) AS day_of_week,
    CAST(day(d) AS INTEGER) AS day_of_the_month, strftime(d, '%a') AS day_name
"""
DAYS = """
    SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS d
    FROM (SELECT CAST(min(o_orderdate) AS DATE) AS lo, CAST(max(o_orderdate) AS DATE) AS hi FROM orders)
"""
DATE_DIM = f"SELECT {DATE_COLUMNS} FROM ({DAYS})"

KPI_NAMES = ["total_revenue", "total_orders", "avg_revenue_per_order", "avg_revenue_per_item", "max_order_value"]
EXACT_YEARLY = f"""
    SELECT {Y} AS year, sum(subtotal) AS total_revenue, count(DISTINCT ord) AS total_orders,
           CAST({average('sum(subtotal)', 'count(DISTINCT ord)')} AS DECIMAL(18,2)) AS avg_revenue_per_order,
           CAST({average('sum(subtotal)', 'count(item)')} AS DECIMAL(18,2)) AS avg_revenue_per_item,
           max(subtotal) AS max_order_value
    FROM ({FACT}) WHERE {DELIVERED} GROUP BY {Y}
"""


def _shown(name: str, expr: str) -> str:
    kind = "BIGINT" if name == "total_orders" else "DOUBLE"
    return f"CAST({expr} AS {kind})"


YOY = f"""
    SELECT a.year, {', '.join(f"{_shown(k, f'a.{k}')} AS {k}" for k in KPI_NAMES)},
           {', '.join(f"{_shown(k, f'a.{k} - b.{k}')} AS {k}_diff" for k in KPI_NAMES)}
    FROM ({EXACT_YEARLY}) a LEFT JOIN ({EXACT_YEARLY}) b ON b.year = a.year - 1
"""

MARTS = {
    "date_dim": DATE_DIM,
    "kpi_yearly": YEARLY,
    "kpi_yearly_dedup": mart({"year": Y}, fact=DEDUPED),
    "kpi_monthly": MONTHLY,
    "kpi_daily": mart({"year": Y, "month": M, "day": "CAST(day(d) AS INTEGER)"}, DELIVERED),
    "kpi_dayname": mart({"year": Y, "month": M, "day_name": "strftime(d, '%a')"}),
    "kpi_monthly_by_supplier": BY_SUPPLIER,
    "kpi_by_nation_year": mart(
        {"nation": "n_name", "year": Y},
        joins="JOIN customer ON c_custkey = cust_id JOIN nation ON n_nationkey = c_nationkey",
    ),
    "kpi_by_part_type": f"""
        SELECT p_type AS category, count(DISTINCT ord) AS order_count, CAST(sum(subtotal) AS DOUBLE) AS total_revenue
        FROM ({FACT}) JOIN part ON p_partkey = part_id WHERE {DELIVERED} GROUP BY p_type
    """,
    "kpi_by_part_type_order_totals": f"""
        SELECT p_type AS category, count(DISTINCT ord) AS order_count, CAST(sum(total) AS DOUBLE) AS total_revenue
        FROM (SELECT ord, part_id, sum(subtotal) AS total FROM ({FACT}) WHERE {DELIVERED} GROUP BY ord, part_id)
        JOIN part ON p_partkey = part_id GROUP BY p_type
    """,
    "delivered_rows": f"""
        SELECT item AS order_item_id, ord AS order_id, {text('d')} AS order_date, status AS delivery_status,
               CAST(subtotal AS DOUBLE) AS subtotal
        FROM ({FACT}) WHERE {DELIVERED}
    """,
    "dash_yearly": YEARLY + " ORDER BY year",
    "dash_month_revenue": f"""
        SELECT {M} AS month, CAST(CAST(round(sum(subtotal), 0) AS DECIMAL(20,0)) AS DOUBLE) AS total_revenue
        FROM ({FACT}) WHERE {DELIVERED} AND year(d) = 1998 GROUP BY {M} ORDER BY month
    """,
    "dash_months": f"SELECT DISTINCT month FROM ({BY_SUPPLIER}) WHERE year = 1998 ORDER BY month",
    "dash_top10": f"""
        SELECT restaurant_name, delivery_status, {', '.join(KPI_NAMES)} FROM ({BY_SUPPLIER})
        WHERE year = 1998 AND month = 3
        ORDER BY total_revenue DESC, restaurant_name, delivery_status LIMIT 10
    """,
    "dash_yoy": YOY,
    "dash_totals": f"""
        SELECT CAST(sum(total_revenue) AS DOUBLE) AS total_revenue, CAST(sum(total_orders) AS BIGINT) AS total_orders,
               CAST(max(max_order_value) AS DOUBLE) AS max_order_value
        FROM ({EXACT_YEARLY})
    """,
    "dash_latest_period": f"SELECT year, month FROM ({MONTHLY}) ORDER BY year DESC, month DESC LIMIT 1",
    "dash_month_labels": f"""
        SELECT DISTINCT {M} AS month, strftime(d, '%b') AS label FROM ({FACT})
        WHERE {DELIVERED} AND year(d) = 1998 ORDER BY month
    """,
}

# -- merging ---------------------------------------------------------------------------------------

NOW = """
    SELECT o_orderkey, o_custkey, o_orderstatus, CAST(o_totalprice AS DECIMAL(18,2)) AS o_totalprice, o_orderpriority
    FROM orders
"""
BATCH = f"""
    SELECT o_orderkey, o_custkey + 1 AS o_custkey,
           CASE WHEN o_orderstatus = 'O' THEN 'F' ELSE o_orderstatus END AS o_orderstatus, o_totalprice,
           nullif(o_orderpriority, '5-LOW') AS o_orderpriority
    FROM ({NOW})
    UNION ALL
    SELECT -o_orderkey - 1, o_custkey, o_orderstatus, o_totalprice, o_orderpriority FROM ({NOW}) WHERE o_orderstatus = 'P'
"""
# Price and key never differ for an order present on both sides.
MERGED = f"""
    SELECT coalesce(t.o_orderkey, s.o_orderkey) AS o_orderkey, coalesce(t.o_custkey, s.o_custkey) AS o_custkey,
           s.o_orderstatus, s.o_totalprice, coalesce(s.o_orderpriority, t.o_orderpriority) AS o_orderpriority
    FROM ({NOW}) t FULL JOIN ({BATCH}) s ON t.o_orderkey = s.o_orderkey
"""
AFTER = f"SELECT * FROM ({MERGED}) WHERE o_orderpriority IS DISTINCT FROM '1-URGENT'"


def diff(old: str, new: str) -> str:
    columns = ["o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority"]
    differs = " OR ".join(f"o.{c} IS DISTINCT FROM n.{c}" for c in columns)
    return f"""
        SELECT o.*, 'DELETE' AS _action, n.o_orderkey IS NOT NULL AS _is_update
        FROM ({old}) o LEFT JOIN ({new}) n ON o.o_orderkey = n.o_orderkey WHERE n.o_orderkey IS NULL OR {differs}
        UNION ALL
        SELECT n.*, 'INSERT', o.o_orderkey IS NOT NULL
        FROM ({new}) n LEFT JOIN ({old}) o ON o.o_orderkey = n.o_orderkey WHERE o.o_orderkey IS NULL OR {differs}
    """


def orders_plain(sql: str, more: str = "") -> str:
    return f"""
        SELECT o_orderkey, o_custkey, o_orderstatus, CAST(o_totalprice AS DOUBLE) AS o_totalprice, o_orderpriority{more}
        FROM ({sql})
    """


FEED = ", _action, _is_update"
LINE_COLUMNS = """
    l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag,
    l_linestatus, CAST(l_shipdate AS VARCHAR) AS l_shipdate
"""

MERGES = {
    "dedup_latest": f"""
        SELECT {LINE_COLUMNS} FROM (
            SELECT *, row_number() OVER (
                PARTITION BY l_orderkey, l_linenumber
                ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC, l_extendedprice DESC,
                         l_discount DESC, l_tax DESC, l_returnflag DESC, l_linestatus DESC) AS rn
            FROM lineitem) WHERE rn = 1
    """,
    "upsert_orders": orders_plain(MERGED),
    "upsert_nulls": orders_plain(f"""
        SELECT s.* FROM ({NOW}) t FULL JOIN ({BATCH}) s ON t.o_orderkey = s.o_orderkey
    """),
    "table_upsert": orders_plain(MERGED),
    "table_changes": orders_plain(diff(NOW, MERGED), FEED),
    "delete_where_lines": f"""
        SELECT {LINE_COLUMNS} FROM lineitem
        WHERE NOT coalesce(l_returnflag = 'R' AND nullif(l_linestatus, 'F') = 'O', false)
    """,
    "truncate_table": "SELECT 1 AS version, count(*) AS n FROM orders UNION ALL SELECT 2, 0",
    "snapshot_diff_orders": orders_plain(diff(NOW, AFTER), FEED),
    "snapshot_diff_two": orders_plain(diff(NOW, AFTER), FEED),
    "snapshot_diff_applied": orders_plain(AFTER),
}

# -- versions --------------------------------------------------------------------------------------


def versions(log: str, key: str, ts: str, order: str) -> str:
    """Versions of event_type per key of a log."""
    return f"""
        SELECT {key}, event_type, {row_hash(key, 'event_type', ts)} AS hk, {row_hash('event_type')} AS attr_hash,
               {ts} AS eff_start, lead({ts}) OVER w AS eff_end, lead({ts}) OVER w IS NULL AS is_current
        FROM (SELECT *, lag(event_type) OVER (PARTITION BY {key} ORDER BY {order}) AS before FROM ({log}))
        WHERE before IS DISTINCT FROM event_type
        WINDOW w AS (PARTITION BY {key} ORDER BY {order})
    """


def versions_plain(sql: str) -> str:
    return f"""
        SELECT user_id, event_type, hk, attr_hash, {text('eff_start')} AS eff_start, {text('eff_end')} AS eff_end, is_current
        FROM ({sql})
    """


LOG = versions("SELECT * FROM events", "user_id", "ts", "ts, event_id")
WEEKLY = """
    SELECT user_id, week, event_type FROM (
        SELECT *, CAST(date_trunc('week', ts) AS TIMESTAMP) AS week,
               row_number() OVER (PARTITION BY user_id, date_trunc('week', ts) ORDER BY ts DESC, event_id DESC) AS rn
        FROM events) WHERE rn = 1
"""
ORDER_TRACKED = ["o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority"]


def order_version(start: str, end: str | None, where: str) -> str:
    stop = f"'{end}'" if end else "NULL"
    return f"""
        SELECT o_orderkey, o_custkey, o_orderstatus, CAST(o_totalprice AS DOUBLE) AS o_totalprice, o_orderpriority,
               {row_hash('o_orderkey', *ORDER_TRACKED, f"'{start}'")} AS hk, {row_hash(*ORDER_TRACKED)} AS attr_hash,
               '{start}' AS eff_start, CAST({stop} AS VARCHAR) AS eff_end, {'false' if end else 'true'} AS is_current
        FROM {where}
    """


OLD_IMAGES = f"(SELECT * FROM ({diff(NOW, AFTER)}) WHERE _action = 'DELETE')"
NEW_IMAGES = f"(SELECT * FROM ({diff(NOW, AFTER)}) WHERE _action = 'INSERT')"

VERSIONS = {
    "scd2_log_events": versions_plain(LOG),
    "scd2_log_hot_users": versions_plain(LOG),
    "scd2_current": versions_plain(f"SELECT * FROM ({LOG}) WHERE is_current"),
    "scd2_as_of": versions_plain(f"""
        SELECT * FROM ({LOG}) WHERE eff_start <= TIMESTAMP '2024-01-15 12:00:00'
        AND (eff_end IS NULL OR eff_end > TIMESTAMP '2024-01-15 12:00:00')
    """),
    "scd2_weekly_batches": versions_plain(versions(WEEKLY, "user_id", "week", "week")),
    "scd2_late_batch": versions_plain(versions(WEEKLY, "user_id", "week", "week")),
    "scd2_log_unplaced": """
        SELECT CASE event_type WHEN 'click' THEN 'key' WHEN 'error' THEN 'time' ELSE 'nothing' END AS lacks, count(*) AS rows
        FROM events GROUP BY 1
    """,
    "scd2_close_deleted": f"""
        {order_version(DAY1, None, f"({NOW}) WHERE o_orderkey NOT IN (SELECT o_orderkey FROM {OLD_IMAGES})")}
        UNION ALL {order_version(DAY1, DAY2, OLD_IMAGES)}
        UNION ALL {order_version(DAY2, None, NEW_IMAGES)}
    """,
}

# -- clean entities --------------------------------------------------------------------------------

CITY = "['Mumbai','Delhi','Jaipur','Chennai','Kochi','Shimla','Patna','Imphal']"
STATE = "['Maharashtra','Delhi','Rajasthan','Tamil Nadu','Kerala','Himachal Pradesh','Bihar','Manipur']"
CODE = "['MH','DL','RJ','TN','KL','HP','BR','MN']"


def later(start: str, key: str, step: int) -> str:
    return f"(TIMESTAMP '{start}' + to_minutes(({key} * {step}) % 1000000))"


def day_of(moment: str) -> str:
    return f"date_trunc('day', {moment})"


def pick(values: str, key: str) -> str:
    return f"{values}[CAST({key} % 8 AS INTEGER) + 1]"


NO_TIME = "CAST(NULL AS TIMESTAMP)"

# Per entity: its table and (column, kind, value); kinds: m money, t time, s as is.
CLEAN: dict[str, tuple[str, list[tuple[str, str, str]]]] = {
    "location": ("supplier", [
        ("location_id", "s", "s_suppkey"),
        ("city", "s", pick(CITY, "s_suppkey")),
        ("state", "s", f"replace({pick(STATE, 's_suppkey')}, 'Delhi', 'New Delhi')"),
        ("state_code", "s", pick(CODE, "s_suppkey")),
        ("is_union_territory", "s", "s_suppkey % 8 = 1"),
        ("capital_city_flag", "s", "s_suppkey % 8 IN (0, 1)"),
        ("city_tier", "s", "CASE WHEN s_suppkey % 8 IN (0, 1, 2, 3, 6) THEN 'Tier-1' ELSE 'Tier-3' END"),
        ("zip_code", "s", "lpad(CAST(s_suppkey AS VARCHAR), 6, '1')"),
        ("active_flag", "s", "CASE WHEN s_suppkey % 3 = 0 THEN 'No' ELSE 'Yes' END"),
        ("created_ts", "t", later("2021-05-09 04:44:00", "s_suppkey", 997)),
        ("modified_ts", "t", f"CASE WHEN s_suppkey % 5 <> 0 THEN {later('2023-01-01 00:00:00', 's_suppkey', 31)} END"),
    ]),
    "restaurant": ("supplier", [
        ("restaurant_id", "s", "s_suppkey"),
        ("name", "s", "s_name"),
        ("cuisine_type", "s", "'Indian, Thai'"),
        ("pricing_for_two", "m", "CAST(s_acctbal AS DECIMAL(10,2))"),
        ("restaurant_phone", "s", "'9' || lpad(CAST(s_suppkey AS VARCHAR), 9, '0')"),
        ("operating_hours", "s", "'09:00 AM - 22:00 PM'"),
        ("location_id_fk", "s", "s_suppkey"),
        ("active_flag", "s", "'Yes'"),
        ("open_status", "s", "CASE WHEN s_suppkey % 4 = 0 THEN 'Closed' ELSE 'Open' END"),
        ("locality", "s", "'Quarter ' || s_nationkey"),
        ("restaurant_address", "s", f"s_suppkey || ', ' || {pick(CITY, 's_suppkey')}"),
        ("latitude", "m", "CASE WHEN s_suppkey % 11 <> 10 THEN CAST(s_suppkey % 80 AS DECIMAL(9,6)) + 0.123457 END"),
        ("longitude", "m", "CAST(s_suppkey % 170 AS DECIMAL(9,6)) + 0.765432"),
        ("created_dt", "t", day_of(later("2019-03-15 00:00:00", "s_suppkey", 1440))),
        ("modified_dt", "t", later("2020-06-20 10:30:00", "s_suppkey", 61)),
    ]),
    "customer": ("customer", [
        ("customer_id", "s", "c_custkey"),
        ("first_name", "s", "split_part(c_name, '#', 1)"),
        ("last_name", "s", "split_part(c_name, '#', 2)"),
        ("mobile", "s", "'8' || lpad(CAST(c_custkey AS VARCHAR), 9, '0')"),
        ("email", "s", "'c' || c_custkey || '@example.com'"),
        ("login_by_using", "s", "'GMail_Account'"),
        ("gender", "s", "CASE WHEN c_custkey % 2 = 0 THEN 'Female' ELSE 'Male' END"),
        ("dob", "t", "DATE '1960-01-01' + CAST((c_custkey * 37) % 15000 AS INTEGER)"),
        ("anniversary", "t", "CASE WHEN c_custkey % 7 <> 0 THEN DATE '2015-06-18' END"),
        ("preferences", "s", "CASE WHEN c_custkey % 10 <> 3 THEN c_mktsegment END"),
        ("cuisine_types", "s", "CASE WHEN c_custkey % 10 <> 3 THEN 'Thai, Nation ' || c_nationkey END"),
        ("created_dt", "t", later("2019-01-15 10:12:00", "c_custkey", 13)),
        ("modified_dt", "t", later("2020-02-20 12:15:00", "c_custkey", 17)),
    ]),
    "customer_address": ("customer", [
        ("address_id", "s", "c_custkey"),
        ("customer_id_fk", "s", "c_custkey"),
        ("flat_no", "s", text("c_custkey % 100")),
        ("house_no", "s", text("c_custkey % 50")),
        ("floor", "s", text("c_custkey % 9")),
        ("building", "s", "'Mehta Towers'"),
        ("landmark", "s", "CASE WHEN c_custkey % 6 <> 0 THEN 'Near Market' END"),
        ("locality", "s", "'Quarter ' || c_nationkey"),
        ("city", "s", pick(CITY, "c_custkey")),
        ("state", "s", pick(STATE, "c_custkey")),
        ("pincode", "s", "lpad(CAST(c_custkey AS VARCHAR), 6, '1')"),
        ("coordinates", "s", "'28.56789,77.2'"),
        ("primary_flag", "s", "CASE WHEN c_custkey % 8 = 0 THEN 'No' ELSE 'Yes' END"),
        ("address_type", "s", "'Home'"),
        ("created_date", "t", later("2019-01-15 10:15:00", "c_custkey", 11)),
        ("modified_date", "t", later("2020-02-20 12:20:00", "c_custkey", 19)),
    ]),
    "menu": ("part", [
        ("menu_id", "s", "p_partkey"),
        ("restaurant_id_fk", "s", "p_partkey % (SELECT count(*) FROM supplier)"),
        ("item_name", "s", "p_name"),
        ("description", "s", "p_brand || ' ' || p_name"),
        ("price", "m", "CAST(p_retailprice AS DECIMAL(10,2))"),
        ("category", "s", "p_type"),
        ("availability", "s", "CASE p_partkey % 4 WHEN 0 THEN true WHEN 1 THEN true WHEN 2 THEN false END"),
        ("item_type", "s", "'Veg'"),
        ("created_dt", "t", later("2019-03-15 10:00:00", "p_partkey", 7)),
        ("modified_dt", "t", NO_TIME),
    ]),
    "delivery_agent": ("supplier", [
        ("delivery_agent_id", "s", "s_suppkey"),
        ("name", "s", "'Agent ' || s_suppkey"),
        ("phone", "s", "'7' || lpad(CAST(s_suppkey AS VARCHAR), 9, '0')"),
        ("vehicle_type", "s", "CASE WHEN s_suppkey % 2 = 0 THEN 'Bicycle' ELSE 'Motorbike' END"),
        ("location_id_fk", "s", "CASE WHEN s_suppkey % 9 <> 8 THEN s_suppkey END"),
        ("status", "s", "'Active'"),
        ("gender", "s", "CASE WHEN s_suppkey % 2 = 0 THEN 'Female' ELSE 'Male' END"),
        ("rating", "m", "CASE WHEN s_suppkey % 6 <> 5 THEN CAST(s_suppkey % 5 + 0.25 AS DECIMAL(4,2)) END"),
        ("created_dt", "t", later("2019-03-15 10:00:00", "s_suppkey", 23)),
        ("modified_dt", "t", later("2020-06-20 12:00:00", "s_suppkey", 29)),
    ]),
    "orders": ("orders", [
        ("order_id", "s", "o_orderkey"),
        ("customer_id_fk", "s", "o_custkey"),
        ("restaurant_id_fk", "s", "o_orderkey % (SELECT count(*) FROM supplier)"),
        ("order_date", "t", "CAST(o_orderdate AS TIMESTAMP)"),
        ("total_amount", "m", "CAST(o_totalprice AS DECIMAL(10,2))"),
        ("status", "s", STATUS),
        ("payment_method", "s", "CASE WHEN o_orderkey % 3 = 0 THEN 'Cash' ELSE 'UPI' END"),
        ("created_dt", "t", NO_TIME),
        ("modified_dt", "t", "CAST(o_orderdate AS TIMESTAMP)"),
    ]),
    "order_item": ("lineitem", [
        ("order_item_id", "s", "l_orderkey * 10 + l_linenumber"),
        ("order_id_fk", "s", "l_orderkey"),
        ("menu_id_fk", "s", "l_partkey"),
        ("quantity", "m", "CAST(l_quantity AS DECIMAL(10,2))"),
        ("price", "m", "CAST(l_extendedprice AS DECIMAL(10,2))"),
        ("subtotal", "m", "CAST(l_extendedprice AS DECIMAL(10,2))"),
        ("created_dt", "t", NO_TIME),
        ("modified_dt", "t", "CAST(l_shipdate AS TIMESTAMP)"),
    ]),
    "delivery": ("orders", [
        ("delivery_id", "s", "o_orderkey"),
        ("order_id_fk", "s", "o_orderkey"),
        ("delivery_agent_id_fk", "s", "o_orderkey % (SELECT count(*) FROM supplier)"),
        ("delivery_status", "s", STATUS),
        ("estimated_time", "s", "o_orderkey % 60 || ' minutes'"),
        ("customer_address_id_fk", "s", "o_custkey"),
        ("delivery_date", "t", "CAST(o_orderdate AS TIMESTAMP)"),
        ("created_date", "t", NO_TIME),
        ("modified_date", "t", NO_TIME),
    ]),
}


def typed_rows(name: str) -> str:
    table, columns = CLEAN[name]
    return f"SELECT {', '.join(f'{e} AS {c}' for c, _, e in columns)} FROM {table}"


def clean_plain(name: str, replace: dict[str, str] | None = None) -> str:
    shape = {"m": "CAST({0} AS DOUBLE)", "t": "CAST({0} AS VARCHAR)", "s": "{0}"}
    columns = [f"{(replace or {}).get(c, shape[k].format(c))} AS {c}" for c, k, _ in CLEAN[name][1]]
    return f"SELECT {', '.join(columns)} FROM ({typed_rows(name)})"


def hidden(column: str, shown: str) -> str:
    return f"CASE WHEN {column} IS NOT NULL THEN '{shown}' END"


def dimension(name: str, start: str = DAY1) -> str:
    """Key and version key of every row."""
    names = [c for c, _, _ in CLEAN[name][1]]
    return f"""
        SELECT {names[0]}, {row_hash(*names, f"'{start}'")} AS hk, {row_hash(*names[1:])} AS attr_hash,
               '{start}' AS eff_start, CAST(NULL AS VARCHAR) AS eff_end, true AS is_current
        FROM ({typed_rows(name)})
    """


CLEANING = {f"clean_{n}": clean_plain(n) for n in CLEAN}
CLEANING |= {f"dim_{n}": dimension(n) for n in list(CLEAN)[:6]}
CLEANING |= {
    "masked_customers": clean_plain("customer", {
        "mobile": hidden("mobile", "**PII**"),
        "email": hidden("email", "** EMAIL**"),
        "gender": hidden("gender", "**PII**"),
        "dob": hidden("dob", "**PII**"),
    }),
    "masked_restaurants": clean_plain("restaurant", {"restaurant_phone": hidden("restaurant_phone", "**Phone**")}),
    "parse_dates": f"""
        WITH o AS (SELECT o_orderkey, CAST(o_orderdate AS TIMESTAMP) + to_seconds(36307) AS moment FROM orders)
        SELECT o_orderkey, {text('moment')} AS iso_t, {text('moment')} AS iso_micros,
               {text("date_trunc('minute', moment)")} AS us_minute, {text(day_of('moment') + '::TIMESTAMP')} AS us_date,
               {text(day_of('moment') + '::TIMESTAMP')} AS iso_date, CAST(NULL AS VARCHAR) AS time_only,
               CAST(NULL AS VARCHAR) AS wrong_order, CAST(NULL AS VARCHAR) AS no_such_day,
               {text('CAST(moment AS DATE)')} AS as_date
        FROM o
    """,
    "lenient_casts": """
        WITH l AS (SELECT *, CAST(l_extendedprice AS DECIMAL(18,2)) AS p FROM lineitem)
        SELECT l_orderkey, l_linenumber, l_partkey AS whole, CAST(NULL AS BIGINT) AS fraction_as_whole,
               CAST(p AS DOUBLE) AS price, CASE WHEN p < 10000 THEN CAST(p AS DOUBLE) END AS small_price,
               CAST(NULL AS BIGINT) AS letter, l_linestatus AS trimmed,
               CASE WHEN l_linestatus = 'O' THEN true WHEN l_returnflag = 'R' THEN false END AS flag
        FROM l
    """,
    "json_props": """
        SELECT event_id, CASE WHEN event_type <> 'error' THEN CAST(json_extract_string(props, '$.k') AS BIGINT) END AS k
        FROM events
    """,
    "split_names": """
        SELECT p_partkey, split_part(p_name, ' ', 1) AS word1, split_part(p_name, ' ', 2) AS word2,
               split_part(p_name, ' ', 3) AS word3
        FROM part
    """,
    "month_names": """
        SELECT CAST(month(o_orderdate) AS INTEGER) AS month, min(strftime(o_orderdate, '%b')) AS label, count(*) AS orders
        FROM orders GROUP BY 1
    """,
    "hash_keys": f"""
        SELECT o_orderkey, {row_hash('o_orderkey', *ORDER_TRACKED)} AS row_key, {row_hash('o_orderkey')} AS sk,
               CAST('0x' || substr({row_hash('o_orderkey', *ORDER_TRACKED)}, 1, 15) AS BIGINT) AS short_key
        FROM ({NOW})
    """,
    "unique_check": """
        SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1
    """,
    "fk_check": """
        SELECT 'l_orderkey' AS "constraint", count(*) AS "rows", count(*) FILTER (o_orderkey IS NULL) AS orphans
        FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey
        UNION ALL
        SELECT 'l_partkey', count(*), count(*) FILTER (p_partkey IS NULL)
        FROM lineitem LEFT JOIN (SELECT * FROM part WHERE p_size <= 40) ON l_partkey = p_partkey
        UNION ALL
        SELECT 'l_suppkey', count(*), count(*) FILTER (s_suppkey IS NULL)
        FROM lineitem LEFT JOIN supplier ON l_suppkey = s_suppkey
    """,
}

CHECKED = """
    SELECT o_orderkey, nullif(o_orderstatus, 'P') AS o_clerk, o_orderpriority,
           CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) AS o_total_text,
           concat_ws('; ', CASE WHEN o_orderstatus = 'P' THEN 'o_clerk missing' END,
                     CASE WHEN length(o_orderpriority) > 8 THEN 'o_orderpriority longer than 8' END,
                     CASE WHEN CAST(o_totalprice AS DECIMAL(18,2)) >= 100000 THEN 'o_total_text not decimal(7,2)' END) AS reasons
    FROM orders
"""
CLEANING |= {
    "quality_bad_rows": f"SELECT o_orderkey, reasons FROM ({CHECKED}) WHERE reasons <> ''",
    "quality_good_rows": f"SELECT o_orderkey, o_clerk, o_orderpriority, o_total_text FROM ({CHECKED}) WHERE reasons = ''",
}

# -- star schema -----------------------------------------------------------------------------------


def since(name: str, late: str) -> str:
    """Keys and version keys of a dimension whose ``late`` rows came a day later than the others."""
    names = [c for c, _, _ in CLEAN[name][1]]
    start = f"CASE WHEN {late} THEN '{DAY2}' ELSE '{DAY1}' END"
    return f"SELECT {names[0]}, {row_hash(*names, start)} AS hk FROM ({typed_rows(name)})"


def history(name: str, moved: str = "false", new: dict[str, str] | None = None) -> str:
    """Versions with their start and end: from 1990 on, and for ``moved`` rows another one from spring 1998."""
    names = [c for c, _, _ in CLEAN[name][1]]
    place = [c for c in names if c == "location_id_fk"]
    first, then = "1990-01-01 00:00:00", "1998-03-01 00:00:00"
    values = [(new or {}).get(c, c) for c in names]
    where = [(new or {}).get(c, c) for c in place]
    return f"""
        SELECT {', '.join([names[0], *place])}, {row_hash(*names, f"'{first}'")} AS hk, TIMESTAMP '{first}' AS a,
               CASE WHEN {moved} THEN TIMESTAMP '{then}' ELSE TIMESTAMP '9999-01-01' END AS b
        FROM ({typed_rows(name)})
        UNION ALL
        SELECT {', '.join([names[0], *where])}, {row_hash(*values, f"'{then}'")}, TIMESTAMP '{then}', TIMESTAMP '9999-01-01'
        FROM ({typed_rows(name)}) WHERE {moved}
    """


def star(
    order_by: str,
    dims: dict[str, str] | None = None,
    menu: str = "i.menu_id_fk",
    agent: str = "d.delivery_agent_id_fk",
    location: str = "o.restaurant_id_fk",
    at: str = "",
) -> str:
    """The fact with typed money; ``order_by`` picks one of several rows of an item."""
    def dim(name: str, alias: str) -> str:
        valid = f"AND {at} >= {alias}.a AND {at} < {alias}.b" if at else ""
        return f"({(dims or {}).get(name) or dimension(name)}) {alias} ON true {valid}"

    return f"""
        SELECT i.order_item_id, i.order_id_fk AS order_id, c.hk AS customer_dim_key, a.hk AS customer_address_dim_key,
               r.hk AS restaurant_dim_key, l.hk AS restaurant_location_dim_key, m.hk AS menu_dim_key,
               g.hk AS delivery_agent_dim_key, {row_hash('CAST(o.order_date AS DATE)')} AS order_date_dim_key,
               i.quantity, i.price, i.subtotal, d.delivery_status, d.estimated_time, o.order_date,
               o.restaurant_id_fk, d.customer_address_id_fk, i.menu_id_fk
        FROM (SELECT *, row_number() OVER (PARTITION BY order_item_id, order_id_fk ORDER BY {order_by}) AS rn
              FROM ({typed_rows('order_item')})) i
        JOIN ({typed_rows('orders')}) o ON i.order_id_fk = o.order_id
        JOIN ({typed_rows('delivery')}) d ON d.order_id_fk = o.order_id
        JOIN {dim('customer', 'c')} AND c.customer_id = o.customer_id_fk
        JOIN {dim('customer_address', 'a')} AND a.address_id = d.customer_address_id_fk
        JOIN {dim('restaurant', 'r')} AND r.restaurant_id = o.restaurant_id_fk
        JOIN {dim('location', 'l')} AND l.location_id = {location}
        JOIN {dim('menu', 'm')} AND m.menu_id = {menu}
        JOIN {dim('delivery_agent', 'g')} AND g.delivery_agent_id = {agent}
        WHERE rn = 1
    """


STAR = star("modified_dt DESC, menu_id_fk DESC, quantity DESC, price DESC, subtotal DESC")
# Text sorts differently from numbers: this one picks among raw rows.
AS_TEXT = (
    "modified_dt DESC, CAST(menu_id_fk AS VARCHAR) DESC, CAST(CAST(quantity AS DECIMAL(10,1)) AS VARCHAR) DESC,"
    " CAST(price AS VARCHAR) DESC"
)
STAR_TEXT = star(AS_TEXT)

# Entity -> column that changes on the second day, and what to.
UPDATES = {
    "location": ("zip_code", "'999999'"),
    "restaurant": ("open_status", "'Moved'"),
    "customer": ("mobile", "'1'"),
    "customer_address": ("locality", "'Quarter 99'"),
    "menu": ("item_name", "'renamed'"),
    "delivery_agent": ("phone", "'1'"),
    "orders": ("payment_method", "'Card'"),
    "order_item": ("quantity", "7"),
    "delivery": ("estimated_time", "'late'"),
}


def update_plain(name: str) -> str:
    """All rows, a third of them with the new value; an item once."""
    column, value = UPDATES[name]
    number = CLEAN[name][1][0][0]
    one = f"QUALIFY row_number() OVER (PARTITION BY order_item_id, order_id_fk ORDER BY {AS_TEXT}) = 1" if name == "order_item" else ""
    new = f"CASE WHEN {number} % 3 = 1 THEN {value} ELSE {column} END"
    shape = {"m": "CAST({0} AS DOUBLE)", "t": "CAST({0} AS VARCHAR)", "s": "{0}"}
    columns = [f"{shape[k].format(new if c == column else c)} AS {c}" for c, k, _ in CLEAN[name][1]]
    return f"SELECT {', '.join(columns)} FROM (SELECT * FROM ({typed_rows(name)}) {one})"


def update_dim(name: str) -> str:
    """The versions of the first day, closed where a new value came, and those of the second."""
    column, value = UPDATES[name]
    names = [c for c, _, _ in CLEAN[name][1]]
    late, moved = f"{names[0]} % 5 = 4", f"{names[0]} % 3 = 1"
    new = [f"CASE WHEN {moved} THEN {value} ELSE {c} END" if c == column else c for c in names]
    day1, day2 = f"'{DAY1}'", f"'{DAY2}'"
    return f"""
        SELECT {names[0]}, {row_hash(*names, day1)} AS hk, {row_hash(*names[1:])} AS attr_hash, {day1} AS eff_start,
               CASE WHEN {moved} THEN {day2} END AS eff_end, NOT ({moved}) AS is_current
        FROM ({typed_rows(name)}) WHERE NOT ({late})
        UNION ALL
        SELECT {names[0]}, {row_hash(*new, day2)}, {row_hash(*new[1:])}, {day2}, NULL, true
        FROM ({typed_rows(name)}) WHERE {late} OR {moved}
    """


LATE_CUSTOMER = {"customer": since("customer", "customer_id % 5 = 2")}
LATE_MENU = {"menu": since("menu", "category LIKE 'PROMO%'")}
AT_ORDER = {n: history(n) for n in list(CLEAN)[:6]} | {
    "customer": history("customer", "customer_id % 3 = 0", {"mobile": "'1'"}),
    "menu": history("menu", "category = 'ECONOMY'", {"price": "CAST(price + 1 AS DECIMAL(10,2))"}),
    # Restaurant 0 is there already.
    "restaurant": history("restaurant", "restaurant_id % 2 = 0 AND restaurant_id <> 0", {"location_id_fk": "0"}),
}


def star_plain(sql: str, status: str = "delivery_status") -> str:
    return f"""
        SELECT order_item_id, order_id, customer_dim_key, customer_address_dim_key, restaurant_dim_key,
               restaurant_location_dim_key, menu_dim_key, delivery_agent_dim_key, order_date_dim_key,
               CAST(quantity AS DOUBLE) AS quantity, CAST(price AS DOUBLE) AS price, CAST(subtotal AS DOUBLE) AS subtotal,
               {status} AS delivery_status, estimated_time
        FROM ({sql})
    """


STAR_FACT = f"""
    SELECT order_item_id AS item, order_id AS ord, CAST(order_date AS DATE) AS d, delivery_status AS status, subtotal,
           restaurant_id_fk, customer_address_id_fk, menu_id_fk
    FROM ({STAR})
"""

STARS = {
    "star_date_dim": DATE_DIM,
    "star_fact": star_plain(STAR),
    "star_fact_merge": star_plain(STAR),
    "star_fact_incremental": star_plain(
        STAR_TEXT, "CASE WHEN delivery_status = 'Processing' THEN 'Pending' ELSE delivery_status END"
    ),
    "star_fact_late_customer": star_plain(star(AS_TEXT, LATE_CUSTOMER)),
    "star_fact_late_menu": star_plain(star(AS_TEXT, LATE_MENU)),
    "star_pending": """
        SELECT DISTINCT o_orderkey AS order_id, 'location' AS dimension, 1 AS day,
               o_orderkey % (SELECT count(*) FROM supplier) AS key
        FROM orders JOIN lineitem ON l_orderkey = o_orderkey WHERE o_orderkey % (SELECT count(*) FROM supplier) % 3 = 1
    """,
    "star_fact_reassigned": star_plain(
        star(
            AS_TEXT,
            menu="CASE WHEN i.order_item_id % 10 = 1 THEN 0 ELSE i.menu_id_fk END",
            agent="CASE WHEN d.delivery_status = 'Processing' THEN abs(d.delivery_agent_id_fk - 1) ELSE d.delivery_agent_id_fk END",
        )
    ),
    "star_fact_as_of_order": star_plain(
        star(
            "modified_dt DESC, menu_id_fk DESC, quantity DESC, price DESC, subtotal DESC",
            AT_ORDER, location="r.location_id_fk", at="o.order_date",
        )
    ),
    "star_kpi_yearly": mart({"year": Y}, "status = 'Delivered'", STAR_FACT),
    "star_views": f"""
        SELECT year, month, total_revenue, total_orders
        FROM ({mart({"year": Y, "month": M}, "status = 'Delivered'", STAR_FACT)}) WHERE total_orders > 1
    """,
    "star_kpi_by_restaurant": mart(
        {"year": Y, "month": M, "delivery_status": "status", "restaurant_name": "s_name"},
        fact=STAR_FACT,
        joins="JOIN supplier ON s_suppkey = restaurant_id_fk",
    ),
    "star_kpi_by_city": mart(
        {"city": pick(CITY, "customer_address_id_fk"), "year": Y}, fact=STAR_FACT
    ),
    "star_kpi_by_category": f"""
        SELECT p_type AS category, count(DISTINCT ord) AS order_count, CAST(sum(subtotal) AS DOUBLE) AS total_revenue
        FROM ({STAR_FACT}) JOIN part ON p_partkey = menu_id_fk WHERE status = 'Delivered' GROUP BY p_type
    """,
}

# -- files and streams -----------------------------------------------------------------------------

FILES = {
    "csv_roundtrip": clean_plain("customer"),
    "csv_header_binding": clean_plain("delivery"),
    "csv_quarantine": """
        SELECT CASE WHEN p_type = 'ECONOMY' THEN 'junk' ELSE '' END || p_partkey AS menu,
               CASE p_type WHEN 'ECONOMY' THEN 'menu_id missing or unreadable'
                           WHEN 'PROMO' THEN 'item_name missing or unreadable' ELSE '' END AS reasons
        FROM part
    """,
    "csv_unknown_header": f"""
        SELECT CAST(o_orderkey AS VARCHAR) AS id, CASE o_orderstatus WHEN 'P' THEN 'unknown header' ELSE {STATUS} END AS reasons
        FROM orders
    """,
    "csv_abort": """
        SELECT CAST(p_partkey AS VARCHAR) AS menuid, '' AS problem FROM part WHERE p_type <> 'ECONOMY'
        UNION ALL SELECT DISTINCT '1', 'menu_id missing or unreadable' FROM part WHERE p_type = 'ECONOMY'
    """,
    "stage_delete": """
        SELECT 'stage' AS layer, p_partkey AS menu_id FROM part WHERE p_type NOT LIKE '%ECONOMY%'
        UNION ALL SELECT 'clean', p_partkey FROM part
    """,
    # The query writes its table as four files.
    "list_files": "SELECT 4 AS files, count(*) > 0 AS filled FROM orders",
    "load_once": f"SELECT {STATUS} AS status, count(*) AS orders FROM orders GROUP BY 1",
    "stream_ingest": clean_plain("orders"),
    "stream_to_scd2": f"""
        SELECT c_custkey AS customer_id, '8' || lpad(CAST(c_custkey AS VARCHAR), 9, '0') AS mobile, '{DAY1}' AS eff_start,
               CASE WHEN moved THEN '{DAY2}' END AS eff_end, NOT moved AS is_current
        FROM (SELECT *, c_mktsegment = 'BUILDING' AND c_custkey % 10 <> 3 AS moved FROM customer)
        UNION ALL
        SELECT c_custkey, '1234567890', '{DAY2}', NULL, true FROM customer
        WHERE c_mktsegment = 'BUILDING' AND c_custkey % 10 <> 3
    """,
    "stream_two_batches": f"""
        SELECT s_suppkey AS delivery_agent_id, '7' || lpad(CAST(s_suppkey AS VARCHAR), 9, '0') AS phone, '{DAY1}' AS eff_start,
               CASE WHEN s_suppkey % 3 = 0 THEN '{DAY2}' END AS eff_end, s_suppkey % 3 <> 0 AS is_current
        FROM supplier
        UNION ALL SELECT s_suppkey, '1', '{DAY2}', NULL, true FROM supplier WHERE s_suppkey % 3 = 0
    """,
    "feed_reset": f"""
        SELECT c_custkey AS customer_id, split_part(c_name, '#', 1) AS first_name, 'Male' AS gender, '{DAY2}' AS eff_start
        FROM customer WHERE c_custkey % 2 = 1
    """,
}

CLEANING |= {
    "clean_min_item_id": clean_plain("order_item") + " WHERE order_item_id >= 1000",
    "strict_casts": f"""
        SELECT o_orderkey, o_orderkey AS whole, CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE) AS price,
               {text('CAST(o_orderdate AS DATE)')} AS day,
               CASE WHEN o_orderkey % 5 <> 0 THEN {text('CAST(o_orderdate AS TIMESTAMP)')} END AS moment, o_orderkey % 2 = 0 AS flag
        FROM orders
    """,
}
CLEANING |= {f"update_{n}": update_plain(n) for n in CLEAN}
CLEANING |= {f"update_dim_{n}": update_dim(n) for n in list(CLEAN)[:6]}
STARS["feed_reset_fact"] = f"""
    SELECT * REPLACE (CASE WHEN delivery_status = 'Delivered' AND order_id % 3 = 1 THEN 'late' ELSE estimated_time END AS estimated_time)
    FROM ({star_plain(STAR_TEXT)})
"""

ORACLE: dict[str, str] = MARTS | MERGES | VERSIONS | CLEANING | STARS | FILES
