"""The same queries as plain SQL, written the long way round, for checking.

The SQL builds master by its definition (six left joins at item grain) and
aggregates master for every feature table, so it shares no shortcut with the
Spark plans.
"""

from __future__ import annotations


def _half_up(value: str, digits: int) -> str:
    return f"CAST(ROUND(CAST({value} AS DECIMAL(28,10)), {digits}) AS DOUBLE)"


def _exact(value: str) -> str:
    return f"CAST({value} AS DECIMAL(28,10))"


def _settled(columns: str) -> str:
    """Select list from a spec: names ending in ``~`` are doubles to settle."""
    return ", ".join(
        f"{_half_up(name[:-1], 6)} AS {name[:-1]}" if name.endswith("~") else name
        for name in columns.split()
    )


_VIEWS = {
    "fx_orders": """
        SELECT o_orderkey AS order_id, o_custkey AS customer_id,
               CASE o_orderstatus WHEN 'F' THEN 'delivered' WHEN 'O' THEN 'shipped'
                                  WHEN 'P' THEN 'canceled' END AS order_status,
               o_orderdate AS order_purchase_timestamp,
               CASE WHEN o_orderkey % 40 = 0 THEN NULL
                    ELSE o_orderdate + to_days(CAST(o_orderkey * 37 % 45 AS INTEGER))
                                     + to_hours(o_orderkey % 24)
               END AS order_delivered_customer_date,
               o_orderdate + to_days(30) AS order_estimated_delivery_date
        FROM orders""",
    "fx_items": f"""
        SELECT l_orderkey AS order_id, l_linenumber AS order_item_id, l_partkey AS product_id,
               l_suppkey AS seller_id, l_extendedprice AS price,
               {_half_up("l_extendedprice * l_tax", 2)} AS freight_value
        FROM lineitem""",
    "fx_products": """
        SELECT p_partkey AS product_id,
               CASE WHEN p_partkey % 97 = 0 THEN NULL ELSE replace(p_name, ' ', '_')
               END AS product_category_name
        FROM part""",
    "fx_category": """
        SELECT DISTINCT replace(p_name, ' ', '_') AS product_category_name,
               upper(p_name) AS product_category_name_english
        FROM part WHERE p_name NOT LIKE 'red %'""",
    "fx_customers": """
        SELECT c_custkey AS customer_id, n_name AS customer_state
        FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    "fx_sellers": """
        SELECT s_suppkey AS seller_id, s_name AS seller_city, n_name AS seller_state
        FROM supplier JOIN nation ON s_nationkey = n_nationkey""",
    "fx_payments": f"""
        SELECT l_orderkey AS order_id,
               {_half_up("l_extendedprice * (1 - l_discount)", 2)} AS payment_value,
               l_linenumber AS payment_installments
        FROM lineitem""",
    "fx_reviews": """
        SELECT CAST(event_id // 2 * 3 AS BIGINT) AS order_id,
               CASE WHEN event_type = 'error' THEN 'n/a'
                    ELSE CAST(1 + CAST(floor(value) AS BIGINT) % 5 AS VARCHAR)
               END AS review_score
        FROM events""",
    "fx_category_names": "SELECT product_category_name FROM fx_category",
    "raw_payments": """
        SELECT CAST(l_orderkey AS VARCHAR) AS order_id,
               CASE WHEN (l_orderkey * 7 + l_linenumber) % 5003 = 0 THEN 'not paid'
                    WHEN (l_orderkey * 7 + l_linenumber) % 4001 = 0 THEN NULL
                    ELSE CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS VARCHAR)
               END AS payment_value,
               CAST(l_linenumber AS VARCHAR) AS payment_installments
        FROM lineitem""",
    "raw_reviews": """
        SELECT CAST(order_id AS VARCHAR) AS order_id, review_score FROM fx_reviews""",
    "raw_order_items": """
        SELECT CAST(l_orderkey AS VARCHAR) AS order_id,
               CAST(l_linenumber AS VARCHAR) AS order_item_id,
               CAST(l_partkey AS VARCHAR) AS product_id, CAST(l_suppkey AS VARCHAR) AS seller_id,
               CASE WHEN (l_orderkey * 5 + l_linenumber) % 4507 = 0 THEN 'R$ 12,50'
                    ELSE CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS VARCHAR) END AS price,
               CAST(CAST(l_tax AS DECIMAL(18,2)) AS VARCHAR) AS freight_value
        FROM lineitem""",
    "kept_orders": """
        SELECT * FROM fx_orders
        WHERE order_status = 'delivered' AND order_delivered_customer_date IS NOT NULL
          AND order_purchase_timestamp IS NOT NULL""",
    "payment_agg": """
        SELECT order_id, SUM(payment_value) AS total_payment,
               AVG(payment_installments) AS avg_installments
        FROM fx_payments GROUP BY order_id""",
    "review_agg": """
        SELECT order_id, AVG(TRY_CAST(review_score AS DOUBLE)) AS avg_review_score
        FROM fx_reviews WHERE TRY_CAST(review_score AS DOUBLE) IS NOT NULL GROUP BY order_id""",
    "products_translated": """
        SELECT product_id, product_category_name, product_category_name_english
        FROM fx_products LEFT JOIN fx_category USING (product_category_name)""",
    "master": """
        SELECT o.*, i.product_id, i.seller_id, i.price, i.freight_value,
               p.product_category_name, p.product_category_name_english, c.customer_state,
               s.seller_city, s.seller_state, total_payment, avg_installments, avg_review_score,
               CAST(date_diff('day', CAST(order_estimated_delivery_date AS DATE),
                              CAST(order_delivered_customer_date AS DATE)) AS INTEGER)
                   AS delivery_delay_days,
               CASE WHEN date_diff('day', CAST(order_estimated_delivery_date AS DATE),
                                   CAST(order_delivered_customer_date AS DATE)) > 0
                    THEN 1 ELSE 0 END AS is_late
        FROM kept_orders o
        LEFT JOIN fx_items i ON o.order_id = i.order_id
        LEFT JOIN products_translated p ON i.product_id = p.product_id
        LEFT JOIN fx_customers c ON o.customer_id = c.customer_id
        LEFT JOIN fx_sellers s ON i.seller_id = s.seller_id
        LEFT JOIN payment_agg pa ON o.order_id = pa.order_id
        LEFT JOIN review_agg ra ON o.order_id = ra.order_id""",
    "order_features": """
        SELECT order_id, SUM(price) AS order_total_price, SUM(freight_value) AS order_total_freight,
               COUNT(product_id) AS order_item_count, AVG(avg_review_score) AS order_review_score,
               AVG(delivery_delay_days) AS order_delay_days, AVG(is_late) AS order_is_late,
               AVG(total_payment) AS order_payment_value
        FROM master GROUP BY order_id""",
    "seller_features": """
        SELECT seller_id, MIN(seller_city) AS seller_city, MIN(seller_state) AS seller_state,
               AVG(avg_review_score) AS seller_avg_review, AVG(is_late) AS seller_late_rate,
               COUNT(order_id) AS seller_total_orders, AVG(price) AS seller_avg_price
        FROM master GROUP BY seller_id""",
    "category_features": """
        SELECT product_category_name_english, AVG(price) AS category_avg_price,
               AVG(avg_review_score) AS category_avg_review,
               COUNT(order_id) AS category_total_orders, AVG(is_late) AS category_late_rate
        FROM master GROUP BY product_category_name_english""",
    "customer_features": """
        SELECT customer_state, COUNT(order_id) AS state_total_orders,
               AVG(total_payment) AS state_avg_payment, AVG(is_late) AS state_late_rate
        FROM master GROUP BY customer_state""",
    "entities": """
        SELECT 'seller' AS entity_type, CAST(seller_id AS VARCHAR) AS entity_id,
               'late_rate' AS metric, seller_late_rate AS value
        FROM seller_features WHERE seller_id IS NOT NULL AND seller_total_orders >= 10
        UNION ALL
        SELECT 'seller', CAST(seller_id AS VARCHAR), 'avg_review', seller_avg_review
        FROM seller_features WHERE seller_id IS NOT NULL AND seller_total_orders >= 10
        UNION ALL
        SELECT 'category', product_category_name_english, 'late_rate', category_late_rate
        FROM category_features WHERE product_category_name_english IS NOT NULL
        UNION ALL
        SELECT 'category', product_category_name_english, 'avg_review', category_avg_review
        FROM category_features WHERE product_category_name_english IS NOT NULL
        UNION ALL
        SELECT 'state', customer_state, 'late_rate', state_late_rate
        FROM customer_features WHERE customer_state IS NOT NULL""",
    "scored": f"""
        SELECT e.*, b.baseline,
               {_half_up("(value - b.baseline) / NULLIF(b.spread, 0)", 6)} AS z
        FROM entities e JOIN (
            SELECT entity_type, metric, AVG(value) AS baseline, STDDEV_POP(value) AS spread
            FROM entities GROUP BY entity_type, metric
        ) b ON e.entity_type = b.entity_type AND e.metric = b.metric""",
    "anomaly_flags": f"""
        SELECT entity_type, entity_id, metric, {_half_up("value", 6)} AS value,
               {_half_up("baseline", 6)} AS baseline, z,
               CASE metric WHEN 'late_rate' THEN 'review logistics and carriers'
                           ELSE 'audit product quality and support' END AS action
        FROM scored
        WHERE (metric = 'late_rate' AND z >= 2.0) OR (metric = 'avg_review' AND z <= -2.0)
        ORDER BY ABS(z) DESC, entity_type, entity_id, metric LIMIT 5""",
    "known_categories": """
        SELECT * FROM category_features WHERE product_category_name_english IS NOT NULL""",
    "known_states": "SELECT * FROM customer_features WHERE customer_state IS NOT NULL",
    "business_insights": f"""
        (SELECT 1 AS rank, 'revenue' AS theme, product_category_name_english AS entity_id,
                'revenue' AS metric,
                {_half_up("category_avg_price * category_total_orders", 2)} AS value
         FROM known_categories ORDER BY value DESC, entity_id LIMIT 1)
        UNION ALL
        (SELECT 2, 'satisfaction', product_category_name_english, 'avg_review',
                {_half_up("category_avg_review", 2)}
         FROM (SELECT * FROM known_categories
               ORDER BY category_total_orders DESC, product_category_name_english LIMIT 10)
         ORDER BY {_exact("category_avg_review")}, product_category_name_english LIMIT 1)
        UNION ALL
        (SELECT 3, 'geography', customer_state, 'total_orders',
                CAST(state_total_orders AS DOUBLE)
         FROM known_states
         WHERE {_exact("state_late_rate")} > (
             SELECT {_exact("SUM(state_late_rate * state_total_orders) / SUM(state_total_orders)")}
             FROM known_states)
         ORDER BY state_total_orders DESC, customer_state LIMIT 1)
        UNION ALL
        (SELECT 4, 'revenue', customer_state, 'avg_payment', {_half_up("state_avg_payment", 2)}
         FROM known_states
         ORDER BY {_exact("state_avg_payment")} DESC NULLS LAST, customer_state LIMIT 1)
        UNION ALL
        (SELECT 5, 'geography', customer_state, 'late_pct', {_half_up("state_late_rate * 100", 2)}
         FROM known_states ORDER BY {_exact("state_late_rate")} DESC, customer_state LIMIT 1)""",
    "seller_summary": f"""
        SELECT {_half_up("AVG(seller_avg_review)", 2)} AS avg_review,
               {_half_up("AVG(seller_late_rate) * 100", 1)} AS late_pct,
               COUNT(*) AS total_sellers, CAST(SUM(seller_total_orders) AS BIGINT) AS total_orders
        FROM seller_features""",
    "ranked_flags": """
        SELECT *, ROW_NUMBER() OVER (ORDER BY ABS(z) DESC, entity_type, entity_id, metric) AS seq
        FROM anomaly_flags""",
}


def _sql(final: str, **other: str) -> str:
    views = ",\n".join(f"{name} AS ({body})" for name, body in (_VIEWS | other).items())
    return f"WITH {views}\n{final}"


def _repeated(view: str, rows: str, copies: int = 2) -> str:
    """A view in which the rows of a condition stand ``copies`` times."""
    again = f" UNION ALL SELECT * FROM ({_VIEWS[view]}) WHERE {rows}"
    return f"SELECT * FROM ({_VIEWS[view]})" + again * (copies - 1)


_REPEATING = {
    "fx_orders": _repeated("fx_orders", "order_id % 7 = 0"),
    "fx_customers": _repeated("fx_customers", "customer_id % 4 = 0"),
    "fx_products": _repeated("fx_products", "product_id % 5 < 2"),
    "fx_sellers": _repeated("fx_sellers", "seller_id % 3 = 0", 3),
    "fx_category": _repeated("fx_category", "product_category_name_english LIKE 'B%'"),
}


def _row_counts(label: str, **tables: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{name}' AS {label}, COUNT(*) AS row_count FROM {table}"
        for name, table in tables.items()
    )


_RAW = {
    "orders": "fx_orders",
    "order_items": "fx_items",
    "products": "fx_products",
    "customers": "fx_customers",
    "sellers": "fx_sellers",
    "reviews": "fx_reviews",
    "payments": "fx_payments",
    "geolocation": "customer",
    "category": "fx_category",
}
_DERIVED = {
    name: name
    for name in (
        "master",
        "order_features",
        "seller_features",
        "category_features",
        "customer_features",
    )
}
_MASTER = """order_id customer_id order_status order_purchase_timestamp
    order_delivered_customer_date order_estimated_delivery_date product_id seller_id price~
    freight_value~ product_category_name product_category_name_english customer_state seller_city
    seller_state total_payment~ avg_installments~ avg_review_score~ delivery_delay_days is_late"""

# Spark's names of the column types, in table order.
_TYPES = {
    "master": [
        ("order_id", "bigint"),
        ("customer_id", "bigint"),
        ("order_status", "string"),
        ("order_purchase_timestamp", "timestamp_ntz"),
        ("order_delivered_customer_date", "timestamp_ntz"),
        ("order_estimated_delivery_date", "timestamp_ntz"),
        ("product_id", "bigint"),
        ("seller_id", "bigint"),
        ("price", "double"),
        ("freight_value", "double"),
        ("product_category_name", "string"),
        ("product_category_name_english", "string"),
        ("customer_state", "string"),
        ("seller_city", "string"),
        ("seller_state", "string"),
        ("total_payment", "double"),
        ("avg_installments", "double"),
        ("avg_review_score", "double"),
        ("delivery_delay_days", "int"),
        ("is_late", "int"),
    ],
    "payments": [
        ("order_id", "bigint"),
        ("payment_value", "double"),
        ("payment_installments", "int"),
    ],
    "reviews": [("order_id", "bigint"), ("review_score", "string")],
    "order_items": [
        ("order_id", "bigint"),
        ("order_item_id", "int"),
        ("product_id", "bigint"),
        ("seller_id", "bigint"),
        ("price", "double"),
        ("freight_value", "double"),
    ],
}


def _schemas() -> str:
    return " UNION ALL ".join(
        f"SELECT '{table}' AS table_name, {i} AS position, '{column}' AS column_name, "
        f"'{kind}' AS data_type, COUNT({column}) AS non_null_rows, COUNT(*) AS total_rows "
        f"FROM {_RAW.get(table, table)}"
        for table, columns in _TYPES.items()
        for i, (column, kind) in enumerate(columns, 1)
    )


def _bad(name: str, column: str) -> str:
    return f"TRY_CAST({column} AS DOUBLE) IS NULL"


def _cells(name: str) -> str:
    return ", ".join(f"'{column}': {column}" for column, _ in _TYPES[name])


_CHECKED = {"payments": "payment_value", "reviews": "review_score", "order_items": "price"}
_BAD_ROWS = " UNION ALL ".join(
    f"(SELECT '{name}' AS dataset, '{column}' AS column_name, "
    f"CAST(order_id AS VARCHAR) AS order_id, CAST({column} AS VARCHAR) AS value, "
    f"CAST(to_json({{{_cells(name)}}}) AS VARCHAR) AS whole_row "
    f"FROM raw_{name} WHERE {_bad(name, column)} "
    f"ORDER BY CAST(order_id AS VARCHAR), value, whole_row LIMIT 5)"
    for name, column in _CHECKED.items()
)
_BAD_COUNTS = " UNION ALL ".join(
    f"SELECT '{name}' AS dataset, '{column}' AS column_name, COUNT(*) AS total_rows, "
    f"COUNT(*) FILTER (WHERE {_bad(name, column)}) AS bad_rows FROM raw_{name}"
    for name, column in _CHECKED.items()
)

_DOUBLES = {
    "order_features": (
        "order_id",
        "order_total_price order_total_freight order_item_count order_review_score "
        "order_delay_days order_is_late order_payment_value",
    ),
    "seller_features": (
        "seller_id",
        "seller_avg_review seller_late_rate seller_total_orders seller_avg_price",
    ),
    "category_features": (
        "product_category_name_english",
        "category_avg_price category_avg_review category_total_orders category_late_rate",
    ),
    "customer_features": (
        "customer_state",
        "state_total_orders state_avg_payment state_late_rate",
    ),
}
_LONG_TABLES = " UNION ALL ".join(
    f"SELECT '{table}' AS table_name, CAST({key} AS VARCHAR) AS entity, '{column}' AS metric, "
    f"{_half_up(column, 6)} AS value FROM {table}"
    for table, (key, columns) in _DOUBLES.items()
    for column in columns.split()
)
_PUBLISHED_REPORTS = f"""
    SELECT 'platform' AS report, 'sellers' AS entity, COUNT(*) AS orders,
           {_half_up("AVG(seller_late_rate)", 6)} AS late_rate FROM seller_features
    UNION ALL
    SELECT 'state', customer_state, state_total_orders, {_half_up("state_late_rate", 6)}
    FROM customer_features
    UNION ALL
    SELECT 'category', product_category_name_english, category_total_orders,
           {_half_up("category_late_rate", 6)} FROM category_features
    UNION ALL
    SELECT 'master', customer_state, COUNT(*), {_half_up("AVG(is_late)", 6)}
    FROM master GROUP BY customer_state
    UNION ALL
    SELECT 'orders', 'all', COUNT(*), {_half_up("AVG(order_is_late)", 6)} FROM order_features"""
_DUPLICATES = " UNION ALL ".join(
    f"SELECT '{name}' AS dataset, '{key}' AS key_column, CAST({key} AS VARCHAR) AS key_value, "
    f"COUNT(*) AS row_count FROM {table} WHERE {key} IS NOT NULL GROUP BY {key} HAVING COUNT(*) > 1"
    for name, key, table in (
        ("orders", "order_id", "fx_orders"),
        ("products", "product_id", "fx_products"),
        ("customers", "customer_id", "fx_customers"),
        ("sellers", "seller_id", "fx_sellers"),
        ("category", "product_category_name", "fx_category_names"),
    )
)

_VALUE = "CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS VARCHAR)"
_DAMAGED = f"""
    SELECT 'payments' AS dataset, (l_orderkey * 7 + l_linenumber) % 1009 AS kind,
           CASE (l_orderkey * 7 + l_linenumber) % 1009
                WHEN 0 THEN l_orderkey || ',' || {_VALUE}
                WHEN 1 THEN l_orderkey || ',' || {_VALUE} || ',' || l_linenumber || ',again'
                WHEN 2 THEN l_orderkey || ',' || {_VALUE} || ',"' || l_linenumber
                WHEN 3 THEN l_orderkey || ',"' || {_VALUE} || ',' || l_linenumber END AS record
    FROM lineitem
    UNION ALL
    SELECT 'reviews', CASE WHEN doc_id % 97 > 1 THEN 9 ELSE doc_id % 97 END,
           CASE doc_id % 97 WHEN 0 THEN doc_id || ',4'
                ELSE doc_id || ',4,"' || replace(text, '"', '""') || '","' || replace(text, '"', '""') || '"' END
    FROM documents WHERE text IS NOT NULL"""
_BROKEN_ROWS = f"""
    SELECT dataset, CASE kind WHEN 0 THEN 'too few cells' WHEN 1 THEN 'too many cells'
                              ELSE 'unclosed quote' END AS reason,
           CAST(CASE kind WHEN 0 THEN 2 WHEN 1 THEN 4 END AS INTEGER) AS cells, 3 AS expected,
           md5(record) AS record_md5
    FROM ({_DAMAGED}) WHERE kind < 4"""
_BROKEN_COUNTS = f"""
    SELECT dataset, COUNT(*) AS total_records, COUNT(*) FILTER (WHERE kind = 0) AS too_few_cells,
           COUNT(*) FILTER (WHERE kind = 1) AS too_many_cells,
           COUNT(*) FILTER (WHERE kind IN (2, 3)) AS unclosed_quotes
    FROM ({_DAMAGED}) GROUP BY dataset"""

_ORDER_FEATURES = f"""SELECT {_settled('''order_id order_total_price~ order_total_freight~
    order_item_count order_review_score~ order_delay_days~ order_is_late~ order_payment_value~''')}
    FROM order_features"""

_REPORT_NUMBERS = {
    "seller_summary": ("'platform'", "avg_review late_pct total_sellers total_orders"),
    "top_sellers_by_review": ("seller_id", "avg_review seller_total_orders"),
    "top5_categories": ("product_category_name_english", "category_total_orders avg_price avg_review"),
    "worst5_states": ("customer_state", "state_total_orders late_pct"),
    "top10_categories": (
        "product_category_name_english", "category_total_orders avg_price avg_review late_pct",
    ),
    "late_states": ("customer_state", "state_total_orders late_pct avg_payment"),
    "bad_sellers": ("seller_id", "avg_review late_pct seller_total_orders"),
    "high_risk_sellers": ("seller_id", "avg_review late_pct total_orders"),
    "all_categories": ("category", "orders avg_price avg_review late_pct"),
    "all_states": ("state", "orders late_pct avg_payment"),
    "chart_top_categories": ("category", "orders avg_review"),
}

_FINAL = {
    "scan_csv_typed": """
        SELECT CAST(order_id AS VARCHAR) AS order_id, CAST(customer_id AS VARCHAR) AS customer_id,
               order_status, order_purchase_timestamp, order_delivered_customer_date,
               order_estimated_delivery_date FROM fx_orders""",
    "scan_csv_multiline": """
        SELECT CAST(doc_id AS VARCHAR) AS order_id, CAST(n_chars AS VARCHAR) AS review_score,
               CAST(length(text) AS INTEGER) AS text_length, md5(text) AS text_md5
        FROM documents""",
    "scan_parquet": "SELECT * FROM lineitem",
    "sink_parquet_roundtrip": _ORDER_FEATURES,
    "table_ctas_roundtrip": _PUBLISHED_REPORTS,
    "dataset_row_counts": _row_counts("dataset", **_RAW),
    "table_schemas": _schemas(),
    "bad_value_rows": _BAD_ROWS,
    "bad_value_counts": _BAD_COUNTS,
    "clean_orders": "SELECT * FROM kept_orders",
    "payment_agg": f"""
        SELECT {_settled("order_id total_payment~ avg_installments~")} FROM payment_agg""",
    "review_agg": f"SELECT {_settled('order_id avg_review_score~')} FROM review_agg",
    "products_translated": "SELECT * FROM products_translated",
    "delivery_delay": """
        SELECT order_id, CAST(delay AS INTEGER) AS delivery_delay_days,
               CASE WHEN delay > 0 THEN 1 ELSE 0 END AS is_late
        FROM (SELECT order_id, date_diff('day', CAST(order_estimated_delivery_date AS DATE),
                                         CAST(order_delivered_customer_date AS DATE)) AS delay
              FROM kept_orders)""",
    "master": f"SELECT {_settled(_MASTER)} FROM master",
    "master_row_counts": """
        SELECT COUNT(*) AS master_rows,
               COUNT(*) FILTER (WHERE product_id IS NULL) AS itemless_rows,
               COUNT(*) FILTER (WHERE product_category_name_english IS NULL) AS null_category_rows,
               COUNT(*) FILTER (WHERE avg_review_score IS NULL) AS null_review_rows,
               COUNT(*) FILTER (WHERE delivery_delay_days = 0) AS zero_delay_rows,
               COUNT(*) FILTER (WHERE is_late = 1) AS late_rows
        FROM master""",
    "order_features": _ORDER_FEATURES,
    "seller_features": f"""SELECT {_settled('''seller_id seller_city seller_state
        seller_avg_review~ seller_late_rate~ seller_total_orders seller_avg_price~''')}
        FROM seller_features""",
    "seller_features_window": f"""
        SELECT order_id, product_id, seller_id,
               {_half_up("AVG(avg_review_score) OVER seller", 6)} AS seller_avg_review,
               {_half_up("AVG(is_late) OVER seller", 6)} AS seller_late_rate,
               COUNT(order_id) OVER seller AS seller_total_orders,
               {_half_up("AVG(price) OVER seller", 6)} AS seller_avg_price
        FROM master WINDOW seller AS (PARTITION BY seller_id)""",
    "category_features": f"""SELECT {_settled('''product_category_name_english category_avg_price~
        category_avg_review~ category_total_orders category_late_rate~''')}
        FROM category_features""",
    "customer_features": f"""SELECT {_settled('''customer_state state_total_orders
        state_avg_payment~ state_late_rate~''')} FROM customer_features""",
    "seller_summary": "SELECT * FROM seller_summary",
    "top_sellers_by_review": f"""
        SELECT seller_id, seller_state, {_half_up("seller_avg_review", 2)} AS avg_review,
               seller_total_orders
        FROM seller_features
        ORDER BY {_exact("seller_avg_review")} DESC NULLS LAST, seller_id NULLS LAST LIMIT 5""",
    "top5_categories": f"""
        SELECT product_category_name_english, category_total_orders,
               {_half_up("category_avg_price", 2)} AS avg_price,
               {_half_up("category_avg_review", 2)} AS avg_review
        FROM category_features
        ORDER BY category_total_orders DESC, product_category_name_english NULLS LAST LIMIT 5""",
    "worst5_states": f"""
        SELECT customer_state, state_total_orders,
               {_half_up("state_late_rate * 100", 1)} AS late_pct
        FROM customer_features
        ORDER BY {_exact("state_late_rate")} DESC, customer_state NULLS LAST LIMIT 5""",
    "top10_categories": f"""
        SELECT product_category_name_english, category_total_orders,
               {_half_up("category_avg_price", 2)} AS avg_price,
               {_half_up("category_avg_review", 2)} AS avg_review,
               {_half_up("category_late_rate * 100", 1)} AS late_pct
        FROM category_features
        ORDER BY category_total_orders DESC, product_category_name_english NULLS LAST LIMIT 10""",
    "late_states": f"""
        SELECT customer_state, state_total_orders,
               {_half_up("state_late_rate * 100", 1)} AS late_pct,
               {_half_up("state_avg_payment", 2)} AS avg_payment
        FROM customer_features
        ORDER BY {_exact("state_late_rate")} DESC, customer_state NULLS LAST LIMIT 10""",
    "bad_sellers": f"""
        SELECT seller_id, seller_state, {_half_up("seller_avg_review", 2)} AS avg_review,
               {_half_up("seller_late_rate * 100", 1)} AS late_pct, seller_total_orders
        FROM seller_features WHERE seller_total_orders >= 10
        ORDER BY {_exact("seller_late_rate")} DESC, seller_id NULLS LAST LIMIT 10""",
    "high_risk_sellers": f"""
        SELECT seller_id, seller_state, {_half_up("seller_avg_review", 2)} AS avg_review,
               {_half_up("seller_late_rate * 100", 1)} AS late_pct,
               seller_total_orders AS total_orders
        FROM seller_features WHERE seller_total_orders >= 20
        ORDER BY late_pct DESC, seller_id NULLS LAST LIMIT 20""",
    "all_categories": f"""
        SELECT product_category_name_english AS category, category_total_orders AS orders,
               {_half_up("category_avg_price", 2)} AS avg_price,
               {_half_up("category_avg_review", 2)} AS avg_review,
               {_half_up("category_late_rate * 100", 1)} AS late_pct
        FROM category_features ORDER BY orders DESC, category NULLS LAST""",
    "all_states": f"""
        SELECT customer_state AS state, state_total_orders AS orders,
               {_half_up("state_late_rate * 100", 1)} AS late_pct,
               {_half_up("state_avg_payment", 2)} AS avg_payment
        FROM customer_features ORDER BY late_pct DESC, state NULLS LAST""",
    "chart_top_categories": f"""
        SELECT product_category_name_english AS category, category_total_orders AS orders,
               {_half_up("category_avg_review", 2)} AS avg_review
        FROM category_features ORDER BY orders DESC, category NULLS LAST LIMIT 10""",
    "anomaly_flags": "SELECT * FROM anomaly_flags",
    "business_insights": "SELECT * FROM business_insights",
    "findings_report": """
        SELECT CASE section WHEN 'summary' THEN 1 WHEN 'insights' THEN 2 WHEN 'risks' THEN 3
                            ELSE 4 END AS section_no, * FROM (
        SELECT 'summary' AS section, 1 AS seq, 'platform' AS entity_id, 'avg_review' AS metric,
               avg_review AS value FROM seller_summary
        UNION ALL SELECT 'summary', 2, 'platform', 'late_pct', late_pct FROM seller_summary
        UNION ALL SELECT 'summary', 3, 'platform', 'total_sellers', CAST(total_sellers AS DOUBLE)
        FROM seller_summary
        UNION ALL SELECT 'summary', 4, 'platform', 'total_orders', CAST(total_orders AS DOUBLE)
        FROM seller_summary
        UNION ALL SELECT 'insights', rank, entity_id, metric, value FROM business_insights
        UNION ALL SELECT 'risks', CAST(seq AS INTEGER), entity_id, entity_type || ' ' || metric,
                         value FROM ranked_flags
        UNION ALL SELECT 'actions', CAST(seq AS INTEGER), entity_id, action, z
        FROM ranked_flags)""",
    "full_refresh": _row_counts("stage", **_RAW, **_DERIVED),
    "csv_refresh": _LONG_TABLES,
    "duplicate_keys": _DUPLICATES,
    "bad_record_rows": _BROKEN_ROWS,
    "bad_record_counts": _BROKEN_COUNTS,
}
for _table in ("master", "seller_features", "category_features", "customer_features"):
    _FINAL[f"refreshed_{_table}"] = _FINAL[_table]
_FINAL |= {
    "incremental_refresh": _FINAL["master"],
    "merged_features": _LONG_TABLES,
    "published_tables": _LONG_TABLES,
    "report_views": " UNION ALL ".join(
        f"SELECT '{report}' AS report, CAST({entity} AS VARCHAR) AS entity, '{metric}' AS metric, "
        f"CAST({metric} AS DOUBLE) AS value FROM ({_FINAL[report]}) AS {report}_rows"
        for report, (entity, metrics) in _REPORT_NUMBERS.items()
        for metric in metrics.split()
    ),
}

ORACLE_SQL: dict[str, str] = {
    **{name: _sql(final) for name, final in _FINAL.items()},
    "weighted_features": _sql(_LONG_TABLES, **_REPEATING),
}
