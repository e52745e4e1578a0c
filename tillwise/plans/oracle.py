"""The registered queries as DuckDB SQL over the star-schema tables.

Written from the meaning of each query, not from its Spark plan: plain joins, no copies, no slices.
"""

from __future__ import annotations

AS_OF = "TIMESTAMP '2001-08-02 00:00:00'"


def _total(x: str) -> str:
    # Six places: finer than the amounts, and not the places the engine counts in.
    return f"CAST(sum(CAST({x} AS DECIMAL(38,6))) AS DOUBLE)"


def _avg(x: str) -> str:
    return f"({_total(x)} / nullif(count({x}), 0))"


def _round(x: str, places: int) -> str:
    power = f"1e{places}"
    return f"(sign({x}) * floor(abs({x}) * {power} + 0.5) / {power} + 0.0)"


def _share(condition: str) -> str:
    return _round(f"(CAST(count(*) FILTER (WHERE {condition}) AS DOUBLE) / count(*))", 4)


# The shop tables; the formulas are those of FIXTURES.md.
_SHOP = {
    "clients": """
        SELECT CAST(c_custkey AS VARCHAR) AS client_id, 'L' || c_custkey AS last_name,
               c_name AS first_name,
               'user' || c_custkey || CASE WHEN c_custkey % 200 = 7 THEN 'at' ELSE '@' END
                 || 'shop.example' AS email,
               CAST(CASE WHEN c_custkey % 50 = 3 THEN NULL WHEN c_custkey % 300 = 11 THEN 5
                    WHEN c_custkey % 300 = 17 THEN 110 ELSE 18 + c_custkey % 58 END AS DOUBLE) AS age,
               CASE c_custkey % 3 WHEN 0 THEN 'M' WHEN 1 THEN 'F' ELSE 'Non-binary' END AS gender,
               CASE WHEN c_custkey % 40 <> 21 THEN n_name END AS country,
               CAST(NULL AS VARCHAR) AS city, CAST(NULL AS VARCHAR) AS phone,
               CAST(DATE '1995-01-01' + CAST(c_custkey % 80 * 30 AS INTEGER) AS TIMESTAMP)
                 AS registration_date,
               c_mktsegment AS segment
        FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    "products": """
        SELECT CAST(p_partkey AS VARCHAR) AS product_id, p_name AS product_name,
               p_type AS category, p_retailprice AS unit_price, CAST(p_size AS BIGINT) AS stock
        FROM part""",
    "shop_orders": """
        SELECT CAST(o_orderkey AS VARCHAR) AS order_id, CAST(o_custkey AS VARCHAR) AS client_id,
               o_orderdate AS order_date,
               CASE WHEN o_orderkey % 50 = 49 THEN NULL WHEN o_orderstatus = 'F' THEN 'Cancelled'
                    WHEN o_orderstatus = 'O' AND o_orderkey % 10 = 3 THEN 'Refunded'
                    WHEN o_orderstatus = 'O' THEN 'Delivered' ELSE 'Pending' END AS status,
               o_orderpriority AS payment_method, r_name AS region,
               CASE WHEN o_orderkey % 50 <> 24 THEN o_totalprice END AS total_amount,
               o_orderkey
        FROM orders JOIN customer ON o_custkey = c_custkey
        JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
    "order_items": """
        SELECT l_orderkey || '-' || l_linenumber AS item_id,
               CAST(l_orderkey AS VARCHAR) AS order_id, CAST(l_partkey AS VARCHAR) AS product_id,
               l_quantity AS quantity, l_extendedprice / l_quantity AS unit_price
        FROM lineitem""",
    "dialled": """
        SELECT *, CAST(regexp_extract(props, '[0-9]+') AS INTEGER) AS k FROM events""",
    "incidents": """
        SELECT CAST(event_id AS VARCHAR) AS incident_id, CAST(user_id AS VARCHAR) AS client_id,
               ts AS report_date, event_type AS category,
               CASE WHEN event_id % 10 < 7 THEN CAST(event_id * 2 AS VARCHAR) END AS order_id,
               CASE WHEN k < 60 THEN 'Resolved' WHEN k < 85 THEN 'In progress'
                    WHEN k < 95 THEN 'Escalated' ELSE 'Closed' END AS status,
               CASE WHEN event_id % 10 < 3 THEN 'Low' WHEN event_id % 10 < 7 THEN 'Medium'
                    WHEN event_id % 10 < 9 THEN 'High' ELSE 'Critical' END AS priority,
               CASE WHEN k NOT BETWEEN 60 AND 83 THEN value END AS resolution_time_h
        FROM dialled""",
    "page_views": """
        SELECT CAST(event_id AS VARCHAR) AS session_id,
               CASE WHEN k < 80 THEN CAST(user_id AS VARCHAR) END AS client_id,
               event_type AS page, ts AS event_datetime, value AS duration_seconds,
               CASE WHEN k < 55 THEN 'Mobile' WHEN k < 95 THEN 'Desktop' ELSE 'Tablet' END AS device,
               CASE WHEN k % 5 < 3 THEN 'Chrome' WHEN k % 5 = 3 THEN 'Safari' ELSE 'Opera' END
                 AS browser,
               CASE WHEN k % 2 = 0 THEN 'Google' ELSE 'Direct' END AS traffic_source
        FROM dialled""",
    "plain_messages": """
        SELECT o.*, p.product_id FROM shop_orders o LEFT JOIN (
            SELECT CAST(l_orderkey AS VARCHAR) AS order_id,
                   CAST(min(l_partkey) AS VARCHAR) AS product_id
            FROM lineitem GROUP BY l_orderkey) p USING (order_id)""",
    # One row per order message, with what the cleaning should make of it.
    "messages": """
        SELECT order_id, status, total_amount, o_orderkey,
               CASE WHEN o_orderkey % 97 = 13 THEN 'nobody' ELSE client_id END AS client_id,
               CASE WHEN o_orderkey % 89 = 21 AND product_id IS NOT NULL THEN 'nothing'
                    ELSE product_id END AS product_id,
               CASE WHEN o_orderkey % 113 <> 17 THEN order_date END AS order_date,
               CASE WHEN o_orderkey % 101 = 5 THEN -total_amount ELSE total_amount END AS amount,
               CASE WHEN o_orderkey % 103 = 7 THEN 'bad_json'
                    WHEN o_orderkey % 109 = 11 THEN 'missing_field'
                    WHEN product_id IS NULL THEN 'null_key'
                    WHEN total_amount IS NULL THEN 'bad_amount'
                    WHEN o_orderkey % 101 = 5 THEN 'negative_amount' END AS reason
        FROM plain_messages""",
    "cleaned": """
        SELECT order_id, client_id, product_id, total_amount,
               CASE WHEN lower(status) IN ('pending', 'confirmed', 'shipped', 'delivered',
                                           'cancelled')
                    THEN lower(status) ELSE 'unknown' END AS status,
               order_date, TIMESTAMP '2001-08-02 00:00:00' AS sent_at
        FROM messages WHERE reason IS NULL""",
    "client_names": """
        SELECT client_id, first_name || ' ' || last_name AS name, email FROM clients""",
    "enriched": """
        SELECT c.*, name, email, CAST(NULL AS VARCHAR) AS category
        FROM cleaned c JOIN client_names USING (client_id)
        UNION ALL
        SELECT c.*, product_name, NULL, category FROM cleaned c JOIN products USING (product_id)""",
    "joined": """
        SELECT c.*, name, email, category, product_name
        FROM cleaned c JOIN client_names USING (client_id) JOIN products USING (product_id)""",
}

_TABLES = {"clients": "clients", "products": "products", "orders": "shop_orders",
           "order_items": "order_items", "incidents": "incidents", "page_views": "page_views"}

_METRICS = (f"SELECT client_id, count(*) AS order_count, {_total('total_amount')} AS total_revenue "
            "FROM {} GROUP BY client_id")

_WINDOWED = f"""
    SELECT time_bucket(INTERVAL 60 SECONDS, order_date) AS window_start,
           time_bucket(INTERVAL 60 SECONDS, order_date) + INTERVAL 60 SECONDS AS window_end,
           client_id, count(*) AS order_count, {_total('total_amount')} AS total_revenue
    FROM joined WHERE order_date IS NOT NULL GROUP BY ALL"""

# One batch per year of order, undated orders first and every eleventh order a year late. A window is
# closed ten minutes behind the latest order of the batches before; a batch's own orders close windows
# when it is through.
_LATE = f"""
    SELECT * FROM (
        WITH numbered AS (
            SELECT *, coalesce(year(order_date) - 1995 + 1 + CASE WHEN CAST(order_id AS BIGINT) % 11 = 4 THEN 1 ELSE 0 END, 0)
                     AS batch, time_bucket(INTERVAL 60 SECONDS, order_date) AS window_start
            FROM joined),
        marks AS (
            SELECT batch, max(max(order_date)) OVER (ORDER BY batch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS mark,
                   max(max(order_date)) OVER () AS final_mark
            FROM numbered GROUP BY batch),
        judged AS (
            SELECT *, CASE WHEN order_date IS NULL THEN 'no_date'
                           WHEN window_start + INTERVAL 60 SECONDS <= mark - INTERVAL 10 MINUTES THEN 'late' END AS reason
            FROM numbered JOIN marks USING (batch))
        SELECT window_start, client_id, count(*) AS order_count, {_total('total_amount')} AS total_revenue,
               CASE WHEN window_start + INTERVAL 60 SECONDS <= any_value(final_mark) - INTERVAL 10 MINUTES THEN 'closed'
                    ELSE 'open' END AS kind, CAST(NULL AS VARCHAR) AS order_id
        FROM judged WHERE reason IS NULL GROUP BY window_start, client_id
        UNION ALL
        SELECT NULL, client_id, NULL, NULL, reason, order_id FROM judged WHERE reason IS NOT NULL)"""

_INACTIVE = f"""
    SELECT c.client_id, first_name, last_name, email, country, segment, last_order_date,
           date_sub('day', last_order_date, {AS_OF}) AS days_inactive, nb_orders,
           historical_revenue
    FROM clients c JOIN (
        SELECT client_id, max(order_date) AS last_order_date, count(order_id) AS nb_orders,
               {_round(_total('total_amount'), 2)} AS historical_revenue
        FROM shop_orders WHERE status <> 'Cancelled' GROUP BY client_id) l USING (client_id)
    WHERE date_sub('day', last_order_date, {AS_OF}) > 60"""

def _client_360(incidents: str) -> str:
    worth = "total_revenue * 0.5 + nb_orders * 2"
    score = f"({worth} + 20 / CAST(nullif(nb_incidents, 0) AS DOUBLE))"
    return f"""
        SELECT *, {_round(score, 2)} AS value_score,
               CASE WHEN {worth} > 200 THEN 'VIP' WHEN {worth} > 50 THEN 'Regular'
                    ELSE 'At risk' END AS client_segment
        FROM (
            SELECT client_id, first_name, last_name, country, segment, registration_date,
                   last_order_date, ifnull(n_orders, 0) AS nb_orders,
                   ifnull(revenue, 0.0) AS total_revenue, ifnull(basket, 0.0) AS avg_basket,
                   (SELECT count(*) FROM incidents i
                    WHERE i.client_id = c.client_id {incidents}) AS nb_incidents,
                   (SELECT count(*) FROM page_views v
                    WHERE v.client_id = c.client_id) AS nb_pageviews
            FROM clients c LEFT JOIN (
                SELECT client_id, count(DISTINCT order_id) AS n_orders,
                       {_round(_total("total_amount"), 2)} AS revenue,
                       {_round(_avg("total_amount"), 2)} AS basket,
                       max(order_date) AS last_order_date
                FROM shop_orders WHERE status <> 'Cancelled' GROUP BY client_id) o
            USING (client_id))"""


def _null_profile() -> str:
    columns = {
        "clients": "last_name first_name email age gender country city phone registration_date segment",
        "products": "product_name category unit_price stock",
        "orders": "order_date status payment_method region total_amount",
        "order_items": "quantity unit_price",
        "incidents": "report_date category status priority resolution_time_h",
        "page_views": "page event_datetime duration_seconds device browser traffic_source",
    }
    rows = []
    for table, names in columns.items():
        source = "shop_orders" if table == "orders" else table
        for name in names.split():
            missing = f"count(*) FILTER (WHERE {name} IS NULL)"
            rows.append(
                f"SELECT '{table}' AS table_name, '{name}' AS column_name, count(*) AS n_rows, "
                f"{missing} AS n_nulls, {_share(f'{name} IS NULL')} AS null_rate FROM {source}")
    return " UNION ALL ".join(rows)


# What each column may hold.
_ACCEPTED = {
    "clients": {
        "gender": ("M", "F", "Non-binary"),
        "country": ("France", "Belgium", "Switzerland", "Canada", "Morocco", "Tunisia", "Senegal"),
        "segment": ("new", "regular"),
    },
    "products": {
        "category": ("Electronics", "Audio", "Office Furniture", "Accessories", "Storage"),
    },
    "orders": {
        "status": ("Delivered", "Pending", "Cancelled", "Refunded"),
        "payment_method": ("Credit card", "PayPal", "Bank transfer", "Cheque"),
    },
    "incidents": {
        "category": ("Payment", "Delivery", "Defective product", "Login", "Customer service"),
        "status": ("Resolved", "In progress", "Escalated", "Closed"),
        "priority": ("Low", "Medium", "High", "Critical"),
    },
    "page_views": {
        "page": (
            "/home", "/products", "/cart", "/checkout", "/profile", "/support",
            "/deals", "/category/electronics", "/category/audio"),
        "device": ("Mobile", "Desktop", "Tablet"),
        "browser": ("Chrome", "Safari", "Firefox", "Edge"),
        "traffic_source": ("Direct", "Google", "Instagram", "Email", "Referral"),
    },
}


def _accepted_values() -> str:
    rows = []
    for table, lists in _ACCEPTED.items():
        source = "shop_orders" if table == "orders" else table
        for column, values in lists.items():
            good = ", ".join(f"'{v}'" for v in values)
            rows.append(f"SELECT '{table}' AS table_name, '{column}' AS column_name, "
                        f"{column} AS value, count(*) AS n_rows FROM {source} "
                        f"WHERE {column} NOT IN ({good}) GROUP BY {column}")
    return " UNION ALL ".join(rows)


def _ref_integrity() -> str:
    relations = [("orders", "client_id", "shop_orders", "clients"),
                 ("order_items", "order_id", "order_items", "shop_orders"),
                 ("order_items", "product_id", "order_items", "products"),
                 ("incidents", "client_id", "incidents", "clients"),
                 ("incidents", "order_id", "incidents", "shop_orders")]
    return " UNION ALL ".join(
        f"SELECT '{name}.{key}' AS relation, count(DISTINCT {key}) AS orphan_keys, "
        f"count(*) AS orphan_rows FROM {child} c WHERE {key} IS NOT NULL "
        f"AND NOT EXISTS (SELECT 1 FROM {parent} p WHERE p.{key} = c.{key})"
        for name, key, child, parent in relations)


def _bodies() -> dict[str, str]:
    total, amount = _total("total_amount"), "total_amount"
    line = "quantity * i.unit_price"
    encoded = """'{"order_id":"' || order_id || '","client_id":"' || client_id || '","product_id":'
        || coalesce('"' || product_id || '"', 'null') || ',"total_amount":'
        || coalesce(CAST(total_amount AS VARCHAR), 'null') || ',"status":'
        || coalesce('"' || status || '"', 'null') || ',"order_date":'
        || coalesce('"' || strftime(order_date, '%Y-%m-%d %H:%M:%S') || '"', 'null')
        || ',"sent_at":"2001-08-02T00:00:00.000000"}'"""
    sent = encoded.replace("coalesce(CAST(total_amount AS VARCHAR)",
                           "coalesce(CAST(amount AS VARCHAR)").replace(
        """coalesce('"' || status || '"', 'null')""",
        """coalesce('"' || CASE WHEN o_orderkey % 107 = 9 THEN ' \\t' || upper(status) || '\\n'
                               ELSE status END || '"', 'null')""")
    rejected = f"""
        SELECT CASE WHEN o_orderkey % 103 = 7 THEN left(value, length(value) - 3)
                    WHEN o_orderkey % 109 = 11
                    THEN replace(value, '"product_id"', '"product"') ELSE value END AS value,
               reason
        FROM (SELECT o_orderkey, reason, {sent} AS value FROM messages) WHERE reason IS NOT NULL"""
    unchanged = " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, count(*) AS n_rows, CAST(0 AS BIGINT) AS n_changed FROM {source}"
        for name, source in _TABLES.items())
    return {
        "revenue_by_region": f"""
            SELECT country, o.region, date_trunc('month', order_date) AS month,
                   count(DISTINCT order_id) AS nb_orders, {_round(total, 2)} AS revenue,
                   {_round(_avg(amount), 2)} AS avg_basket,
                   {_round(f'({total} / sum({total}) OVER ())', 4)} AS pct_global_revenue
            FROM shop_orders o JOIN clients c ON o.client_id = c.client_id
            WHERE status <> 'Cancelled' GROUP BY ALL""",
        "inactive_clients": _INACTIVE,
        "top_products": f"""
            SELECT p.product_id, product_name, category, count(DISTINCT i.order_id) AS nb_orders,
                   {_total('quantity')} AS qty_sold, {_round(_total(line), 2)} AS revenue,
                   {_round(_avg('i.unit_price'), 2)} AS avg_price,
                   {_share("o.status = 'Cancelled'")} AS cancellation_rate,
                   rank() OVER (PARTITION BY category ORDER BY {_total(line)} DESC)
                     AS rank_in_category
            FROM order_items i JOIN products p ON i.product_id = p.product_id
            JOIN shop_orders o ON i.order_id = o.order_id
            GROUP BY p.product_id, product_name, category""",
        "recurring_incidents": f"""
            SELECT category, count(*) AS nb_incidents,
                   {_round(_avg('resolution_time_h'), 1)} AS avg_resolution_h,
                   {_share("status = 'Escalated'")} AS pct_escalated,
                   {_share("priority = 'Critical'")} AS pct_critical,
                   {_share("status = 'Resolved'")} AS resolution_rate
            FROM incidents GROUP BY category""",
        "navigation_funnel": f"""
            SELECT page, count(*) AS nb_sessions, count(DISTINCT client_id) AS unique_users,
                   {_round(_avg('duration_seconds'), 1)} AS avg_duration_s,
                   {_share("device = 'Mobile'")} AS pct_mobile,
                   {_share("device = 'Desktop'")} AS pct_desktop,
                   {_round(f"({_avg('duration_seconds')} * count(*) / 1000)", 2)}
                     AS engagement_score
            FROM page_views GROUP BY page""",
        "weekly_kpis": f"""
            SELECT CAST("week" AS VARCHAR) AS "week", nb_orders, revenue, active_clients,
                   before AS prev_week_revenue,
                   {_round('((revenue - before) / nullif(before, 0) * 100)', 2)} AS growth_pct
            FROM (SELECT *, lag(revenue) OVER (ORDER BY "week") AS before FROM (
                SELECT CAST(date_trunc('week', order_date) AS DATE) AS "week",
                       count(DISTINCT order_id) AS nb_orders, {_round(total, 2)} AS revenue,
                       count(DISTINCT client_id) AS active_clients
                FROM shop_orders WHERE status <> 'Cancelled' GROUP BY 1))""",
        "client_360": _client_360(""),
        "sql_over_views": f"""
            SELECT s.client_segment, s.segment, count(*) AS nb_clients,
                   count(i.client_id) AS nb_inactive, max(s.nb_orders) AS most_orders
            FROM ({_client_360('')}) s LEFT JOIN ({_INACTIVE}) i ON s.client_id = i.client_id
            GROUP BY s.client_segment, s.segment""",
        "delivered_by_region": f"""
            SELECT region, count(*) AS orders, {_round(total, 2)} AS revenue
            FROM shop_orders WHERE status = 'Delivered' GROUP BY region""",
        "top_customers": f"""
            SELECT c.client_id, first_name || ' ' || last_name AS name, country,
                   count(order_id) AS num_orders, {_round(total, 2)} AS total_spent
            FROM clients c LEFT JOIN shop_orders o ON c.client_id = o.client_id
            GROUP BY ALL ORDER BY total_spent DESC NULLS LAST, c.client_id LIMIT 10""",
        "row_counts": " UNION ALL ".join(
            f"SELECT '{name}' AS table_name, count(*) AS n_rows FROM {source}"
            for name, source in _TABLES.items()),
        "country_distribution": f"""
            SELECT country, count(*) AS nb_clients,
                   {_round('(count(*) / (SELECT CAST(count(*) AS DOUBLE) FROM clients) * 100)', 1)}
                     AS pct
            FROM clients WHERE country IS NOT NULL GROUP BY country""",
        "total_revenue": f"SELECT {_round(total, 2)} AS total_revenue FROM shop_orders",
        "delivery_rate": f"""
            SELECT count(*) FILTER (WHERE status = 'Delivered') AS delivered, count(*) AS orders,
                   {_round("(count(*) FILTER (WHERE status = 'Delivered') / CAST(count(*) AS DOUBLE) * 100)", 1)}
                     AS delivery_rate_pct FROM shop_orders""",
        "resolution_rate": f"""
            SELECT count(*) FILTER (WHERE status = 'Resolved') AS resolved, count(*) AS incidents,
                   {_round("(count(*) FILTER (WHERE status = 'Resolved') / CAST(count(*) AS DOUBLE) * 100)", 1)}
                     AS resolution_rate_pct FROM incidents""",
        "top5_products": f"""
            SELECT product_name, {_round(_total(line), 2)} AS revenue
            FROM order_items i LEFT JOIN products p ON i.product_id = p.product_id
            WHERE product_name IS NOT NULL
            GROUP BY product_name ORDER BY revenue DESC, product_name LIMIT 5""",
        "event_encode": f"SELECT order_id AS key, {encoded} AS value FROM plain_messages",
        "clean_orders": "SELECT * FROM cleaned",
        "rejected_orders": rejected,
        "dimension_first": """
            SELECT item_id, order_id, product_id, quantity, unit_price FROM (
                SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY
                    order_id NULLS FIRST, product_id NULLS FIRST, quantity NULLS FIRST,
                    unit_price NULLS FIRST) AS place FROM order_items) WHERE place = 1""",
        "orders_join_clients": """
            SELECT c.*, name, email FROM cleaned c JOIN client_names USING (client_id)""",
        "orders_join_products": """
            SELECT c.*, product_name AS name, category
            FROM cleaned c JOIN products USING (product_id)""",
        "enriched_union": "SELECT * FROM enriched",
        "enriched_joined": "SELECT * FROM joined",
        "client_metrics_union": _METRICS.format("enriched"),
        "client_metrics": _METRICS.format("joined"),
        "client_metrics_windowed": _WINDOWED,
        "stream_clean_orders": f"""
            SELECT *, CAST(NULL AS VARCHAR) AS value, CAST(NULL AS VARCHAR) AS reason FROM enriched
            UNION ALL SELECT NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, value, reason
            FROM ({rejected})""",
        "undated_orders": """
            SELECT order_id, client_id, 'no_date' AS reason FROM joined WHERE order_date IS NULL""",
        "stream_dedup_orders": "SELECT * FROM cleaned",
        "stream_client_metrics": _METRICS.format("joined"),
        # A stream holds back the windows its watermark has not passed: ten minutes before the
        # last order.
        "stream_windowed_metrics": f"""
            SELECT * FROM ({_WINDOWED}) WHERE window_end <=
                (SELECT max(order_date) - INTERVAL 10 MINUTES FROM joined)""",
        "stream_finished_batches": f"""
            SELECT *, CAST(NULL AS VARCHAR) AS value, CAST(NULL AS VARCHAR) AS reason FROM enriched
            UNION ALL SELECT NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, value, reason
            FROM ({rejected})""",
        "stream_client_totals": _METRICS.format("joined"),
        "stream_late_orders": _LATE,
        "stream_distinct_counts": """
            SELECT 'page' AS measure, page AS group_value, count(DISTINCT client_id) AS distinct_values,
                   TRUE AS close_in_many, TRUE AS close_in_one FROM page_views GROUP BY page
            UNION ALL
            SELECT 'week', CAST(CAST(date_trunc('week', order_date) AS DATE) AS VARCHAR),
                   count(DISTINCT client_id), TRUE, TRUE
            FROM shop_orders WHERE status <> 'Cancelled' GROUP BY 2""",
        "csv_roundtrip": "SELECT * FROM clients",
        "csv_roundtrip_all": unchanged,
        "csv_split_quoted": """
            SELECT * REPLACE (CASE WHEN CAST(client_id AS BIGINT) % 3 = 0
                              THEN 'a "b"' || chr(10) || ',' || last_name || chr(10) || chr(10) || '"'
                              ELSE last_name END AS last_name) FROM clients""",
        "catalog_replace": " UNION ALL ".join(
            f"SELECT '{name}' AS table_name, '{step}' AS step, count(*) AS n_rows, "
            f"CAST(sum(CAST({key} AS BIGINT)) AS BIGINT) AS keys FROM {source} {where}"
            for name, source, key in (("page_views", "page_views", "session_id"), ("clients", "clients", "client_id"))
            for step, where in (("first", f"WHERE CAST({key} AS BIGINT) % 5 = 0"),
                                ("failed", f"WHERE CAST({key} AS BIGINT) % 5 = 0"), ("second", ""))),
        "csv_rejects": """
            SELECT product_id || ',' || product_name || ',' || category || ',cheap,' || stock AS value,
                   'bad_value' AS reason FROM products WHERE CAST(product_id AS BIGINT) % 20 = 3""",
        "positional_csv": """
            SELECT client_id AS key, last_name AS second, first_name AS third, 'clients' AS kind FROM clients
            UNION ALL SELECT product_id, product_name, category, 'products' FROM products""",
        "partitioned_roundtrip_all": unchanged,
        "partitioned_roundtrip": """
            SELECT *, CAST(CAST(event_datetime AS DATE) AS VARCHAR) AS day FROM page_views""",
        "catalog_tables": """
            SELECT country, count(*) AS nb_orders,
                   CAST(sum((SELECT nullif(count(*), 0) FROM order_items i WHERE i.order_id = o.order_id)) AS BIGINT)
                     AS nb_items,
                   CAST(sum((SELECT CASE WHEN count(*) > 0 THEN count(p.product_id) END FROM order_items i
                        LEFT JOIN products p ON i.product_id = p.product_id WHERE i.order_id = o.order_id)) AS BIGINT)
                     AS nb_products,
                   max((SELECT nullif(count(*), 0) FROM incidents n WHERE n.client_id = o.client_id)) AS most_incidents,
                   max((SELECT CASE WHEN count(*) > 0 THEN count(DISTINCT CAST(event_datetime AS DATE)) END
                        FROM page_views v WHERE v.client_id = o.client_id)) AS most_days
            FROM shop_orders o JOIN clients USING (client_id) GROUP BY country""",
        "landing_manifest": " UNION ALL ".join(
            f"SELECT '{name}' AS table_name, count(*) AS n_rows, 0 AS empty_files FROM {source}"
            for name, source in [*_TABLES.items(), ("regions", "region"), ("returns", "region WHERE false")]),
        "null_profile": _null_profile(),
        "duplicate_rows": """
            SELECT *, count(*) AS copies FROM (
                SELECT * FROM order_items UNION ALL
                SELECT * FROM order_items WHERE order_id LIKE '%7') GROUP BY ALL HAVING count(*) > 1""",
        "dedup_rows": "SELECT DISTINCT * FROM order_items",
        "email_check": """
            SELECT client_id, email, replace(email, 'at', '@') AS repaired_email
            FROM clients WHERE email NOT LIKE '%@%'""",
        "age_check": "SELECT client_id, age FROM clients WHERE age < 10 OR age > 100",
        "ref_integrity": _ref_integrity(),
        "order_total_check": f"""
            SELECT o.order_id, total_amount, items_total,
                   {_round('(total_amount - items_total)', 2)} AS difference, count(*) AS copies, has_items
            FROM (SELECT o.order_id, total_amount, coalesce(t, 0.0) AS items_total, t IS NOT NULL AS has_items
                  FROM shop_orders o LEFT JOIN (
                      SELECT order_id, CAST(sum(CAST({_round('(unit_price * quantity)', 2)}
                                                AS DECIMAL(38,6))) AS DOUBLE) AS t
                      FROM order_items GROUP BY order_id) i ON o.order_id = i.order_id) o
            WHERE abs(total_amount - items_total) > 0.005
            GROUP BY o.order_id, total_amount, items_total, has_items""",
        "incident_date_check": """
            SELECT i.client_id, incident_id, report_date, registration_date
            FROM incidents i JOIN clients c ON i.client_id = c.client_id
            WHERE report_date < registration_date""",
        "mend_ages": "SELECT client_id, CASE WHEN age >= 10 AND age <= 100 THEN age END AS age FROM clients",
        "seeded_sample": """
            SELECT item_id, order_id, product_id, quantity, unit_price FROM (
                SELECT *, row_number() OVER (ORDER BY md5(concat_ws('|', '42', item_id, order_id, product_id,
                              CAST(place AS VARCHAR), CAST(chance AS VARCHAR)))) AS rank
                FROM (SELECT *, row_number() OVER (PARTITION BY item_id, order_id, product_id
                                                   ORDER BY quantity, unit_price) AS place FROM order_items),
                     (SELECT unnest([1, 2, 3]) AS chance))
            WHERE rank <= greatest(1, floor((SELECT count(*) FROM order_items) * 0.01))""",
        "drawn_sample": """
            SELECT * FROM (WITH twice AS (
                SELECT * FROM order_items UNION ALL SELECT * FROM order_items WHERE order_id LIKE '%7'),
            numbered AS (
                SELECT *, row_number() OVER (ORDER BY md5(concat_ws('|', item_id, order_id, product_id)), item_id,
                          order_id, product_id, quantity, unit_price) - 1 AS place FROM twice),
            draws AS (
                SELECT CAST(('0x' || left(md5('42|' || i), 15))::HUGEINT * (SELECT count(*) FROM twice)::HUGEINT
                            // 1152921504606846976 AS BIGINT) AS place
                FROM (SELECT unnest(range(1, CAST(greatest(1, floor((SELECT count(*) FROM twice) * 0.01)) AS BIGINT) + 1)) AS i))
            SELECT item_id, order_id, product_id, quantity, unit_price FROM draws JOIN numbered USING (place))""",
        "date_order_check": """
            SELECT o.client_id, order_id, order_date, registration_date
            FROM shop_orders o JOIN clients c ON o.client_id = c.client_id
            WHERE order_date < registration_date""",
        "segment_rule": f"""
            SELECT client_id, registration_date, segment,
                   CASE WHEN registration_date >= {AS_OF} - INTERVAL 182 DAYS THEN 'new'
                        ELSE 'regular' END AS expected_segment
            FROM clients""",
        "region_lookup": """
            SELECT country, region,
                   CASE country WHEN 'NATION_1' THEN 'AMERICA' WHEN 'NATION_2' THEN 'ASIA'
                                WHEN 'NATION_3' THEN 'EUROPE' ELSE 'Other' END AS expected_region,
                   count(*) AS nb_orders
            FROM shop_orders o JOIN clients c ON o.client_id = c.client_id GROUP BY ALL""",
        "resolution_rule": """
            SELECT incident_id, status, priority, resolution_time_h,
                   CASE WHEN status = 'In progress' THEN 'time_while_open' ELSE 'over_limit' END
                     AS violation
            FROM incidents
            WHERE (status = 'In progress' AND resolution_time_h IS NOT NULL)
               OR (priority = 'Critical' AND resolution_time_h > 24)
               OR (priority <> 'Critical' AND resolution_time_h > 168)""",
        "price_band_check": """
            SELECT item_id, i.product_id, i.unit_price, p.unit_price AS catalogue_price
            FROM order_items i JOIN products p ON i.product_id = p.product_id
            WHERE i.unit_price < p.unit_price * (1 - CAST(0.05 AS DOUBLE))
               OR i.unit_price > p.unit_price * (1 + CAST(0.05 AS DOUBLE))""",
        "catalogue_band_check": """
            SELECT product_id, category, unit_price FROM products
            WHERE (category = 'ECONOMY' AND unit_price NOT BETWEEN 900 AND 950)
               OR (category = 'SMALL' AND unit_price NOT BETWEEN 920 AND 990)
               OR (category = 'LARGE' AND unit_price NOT BETWEEN 900 AND 1500)""",
        "duration_band_check": """
            SELECT session_id, page, duration_seconds FROM page_views
            WHERE (page = 'view' AND duration_seconds NOT BETWEEN 10 AND 60)
               OR (page = 'click' AND duration_seconds NOT BETWEEN 1 AND 100)
               OR (page = 'purchase' AND duration_seconds NOT BETWEEN 60 AND 600)""",
        "accepted_values": _accepted_values(),
    }


def statements() -> dict[str, str]:
    shop = ",\n".join(f"{name} AS ({body})" for name, body in _SHOP.items())
    return {name: f"WITH {shop}\n{body}" for name, body in _bodies().items()}
