"""The same results as plain SQL over the driver's tables, for DuckDB."""

from __future__ import annotations

from checks.inputs import AS_OF

_AS_OF = f"DATE '{AS_OF.isoformat()}'"


def _written(date: str, key: str) -> str:
    return f"""CASE ({key}) % 6
        WHEN 0 THEN strftime({date}, '%d-%m-%Y') WHEN 2 THEN strftime({date}, '%Y/%m/%d')
        WHEN 3 THEN strftime({date}, '%m/%d/%Y') WHEN 4 THEN 'not_a_date'
        ELSE strftime({date}, '%Y-%m-%d') END"""


# Date layouts with the text they have to match as a whole.
_LAYOUTS = [
    (r"\d{2}-\d{2}-\d{4}", "%d-%m-%Y"),
    (r"\d{4}-\d{2}-\d{2}", "%Y-%m-%d"),
    (r"\d{4}/\d{2}/\d{2}", "%Y/%m/%d"),
    (r"\d{2}/\d{2}/\d{4}", "%m/%d/%Y"),
]


def _parsed(text: str) -> str:
    tries = ", ".join(
        f"CASE WHEN regexp_full_match({text}, '{shape}') "
        f"THEN CAST(try_strptime({text}, '{layout}') AS DATE) END"
        for shape, layout in _LAYOUTS
    )
    return f"coalesce({tries})"


def _titled(text: str) -> str:
    return (
        f"array_to_string(list_transform(string_split(trim({text}), ' '), "
        "lambda w: upper(w[1]) || lower(w[2:])), ' ')"
    )


# Table expressions by name, each after those it reads.
_PARTS = {
    "dom_customers": "SELECT c_custkey AS customer_id, c_name AS name FROM customer",
    "dom_native_orders": """SELECT o_orderkey AS order_id, o_custkey AS customer_id,
        CAST(o_orderdate AS DATE) AS order_date, o_totalprice AS amount,
        o_orderstatus AS status FROM orders""",
    "dom_orders": """SELECT order_id, customer_id, order_date, amount,
        CASE status WHEN 'F' THEN 'completed' WHEN 'O' THEN 'pending' ELSE 'cancelled' END AS status
        FROM dom_native_orders""",
    "dom_payments": """SELECT l_orderkey * 10 + l_linenumber AS payment_id,
        l_orderkey AS order_id, CAST(l_shipdate AS DATE) AS payment_date,
        CASE WHEN l_returnflag = 'R' AND l_linenumber = 1 THEN 'success' ELSE 'failed' END
            AS payment_status
        FROM lineitem""",
    "raw_customers": f"""SELECT c_custkey AS customer_id,
        CASE WHEN c_custkey % 50 <> 21 THEN c_name END AS name,
        {_written("(DATE '2023-01-01' + CAST(c_custkey % 700 AS INT))", "c_custkey")}
            AS signup_date,
        CASE c_custkey % 3 WHEN 0 THEN upper(n_name) WHEN 1 THEN '  ' || lower(n_name)
            ELSE n_name || ' ' END AS country,
        0 AS seq
        FROM customer JOIN nation ON c_nationkey = n_nationkey
        UNION ALL
        SELECT c_custkey, c_name || ' dup', {_written("DATE '2024-01-01'", "c_custkey")}, 'dup', 1
        FROM customer WHERE c_custkey % 40 = 5""",
    "raw_orders": f"""SELECT o_orderkey AS order_id,
        CASE WHEN o_orderkey % 97 = 0 THEN o_custkey + 10000000 ELSE o_custkey END AS customer_id,
        {_written("CAST(o_orderdate AS DATE)", "o_orderkey")} AS order_date,
        CASE WHEN o_orderkey % 101 = 0 THEN NULL WHEN o_orderkey % 103 = 0 THEN -o_totalprice
            ELSE o_totalprice END AS amount,
        CASE o_orderstatus WHEN 'F' THEN ' Completed ' WHEN 'O' THEN 'PENDING'
            ELSE 'cancelled' END AS status,
        0 AS seq
        FROM orders
        UNION ALL
        SELECT o_orderkey, o_custkey, {_written("CAST(o_orderdate AS DATE)", "o_orderkey")},
            o_totalprice + 1, 'completed', 1
        FROM orders WHERE o_orderkey % 200 = 11""",
    "raw_payments": f"""SELECT l_orderkey * 10 + l_linenumber AS payment_id,
        CASE WHEN l_orderkey % 211 = 0 THEN l_orderkey + 100000000 ELSE l_orderkey END AS order_id,
        {_written("CAST(l_shipdate AS DATE)", "l_orderkey * 10 + l_linenumber")} AS payment_date,
        CASE WHEN l_returnflag = 'R' AND l_linenumber = 1 THEN ' SUCCESS' ELSE 'Failed ' END
            AS payment_status,
        row_number() OVER (PARTITION BY l_orderkey, l_linenumber
            ORDER BY l_shipdate, l_partkey, l_suppkey, l_extendedprice) AS seq
        FROM lineitem""",
    "named_customers": "SELECT * FROM raw_customers WHERE name IS NOT NULL",
    "first_customers": """SELECT * FROM named_customers
        QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY seq) = 1""",
    "first_orders": """SELECT * FROM raw_orders
        QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY seq) = 1""",
    "first_payments": """SELECT * FROM raw_payments
        QUALIFY row_number() OVER (PARTITION BY payment_id ORDER BY seq) = 1""",
    "clean_customers": f"""SELECT customer_id, name, {_parsed("signup_date")} AS signup_date,
        {_titled("country")} AS country FROM first_customers""",
    "good_orders": f"""SELECT order_id, customer_id, {_parsed("order_date")} AS order_date,
        amount, lower(trim(status)) AS status FROM first_orders WHERE amount >= 0""",
    "clean_orders": """SELECT * FROM good_orders
        WHERE customer_id IN (SELECT customer_id FROM clean_customers)""",
    "orphan_orders": """SELECT * FROM good_orders
        WHERE customer_id NOT IN (SELECT customer_id FROM clean_customers)""",
    "good_payments": f"""SELECT payment_id, order_id, {_parsed("payment_date")} AS payment_date,
        lower(trim(payment_status)) AS payment_status FROM first_payments""",
    "clean_payments": """SELECT * FROM good_payments
        WHERE order_id IN (SELECT order_id FROM clean_orders)""",
    "orphan_payments": """SELECT * FROM good_payments
        WHERE order_id NOT IN (SELECT order_id FROM clean_orders)""",
    "paid_customers": """SELECT DISTINCT o.customer_id FROM dom_native_orders o
        JOIN dom_payments p ON o.order_id = p.order_id WHERE p.payment_status = 'success'""",
}


def _with(select: str) -> str:
    """Prefix the table expressions that ``select`` reads, directly or not."""
    needed: set[str] = set()
    text = select
    for name in reversed(_PARTS):
        if name in text:
            needed.add(name)
            text += _PARTS[name]
    parts = ",\n".join(f"{n} AS ({sql})" for n, sql in _PARTS.items() if n in needed)
    return f"WITH {parts}\n{select}" if parts else select


def _revenue(customers: str, orders: str, status: str) -> str:
    return f"""SELECT c.customer_id, c.name, round(sum(o.amount), 2) AS total_revenue
        FROM {customers} c JOIN {orders} o ON c.customer_id = o.customer_id
        WHERE o.status = '{status}' GROUP BY c.customer_id, c.name"""


def _top(customers: str, orders: str, status: str) -> str:
    return (
        f"SELECT * FROM ({_revenue(customers, orders, status)}) r "
        "ORDER BY total_revenue DESC, customer_id LIMIT 5"
    )


def _monthly(orders: str, status: str) -> str:
    return f"""SELECT strftime(order_date, '%Y-%m') AS month,
        round(sum(amount), 2) AS monthly_revenue
        FROM {orders} WHERE status = '{status}' GROUP BY 1"""


def _unpaid(customers: str, orders: str, payments: str) -> str:
    return f"""SELECT c.customer_id, c.name FROM {customers} c
        WHERE EXISTS (SELECT 1 FROM {orders} o WHERE o.customer_id = c.customer_id)
        AND c.customer_id NOT IN (SELECT o.customer_id FROM {orders} o
            JOIN {payments} p ON o.order_id = p.order_id WHERE p.payment_status = 'success')"""


def _inactive(customers: str, orders: str) -> str:
    return f"""SELECT c.customer_id, c.name, max(o.order_date) AS last_order_date
        FROM {customers} c LEFT JOIN {orders} o ON c.customer_id = o.customer_id
        GROUP BY c.customer_id, c.name
        HAVING max(o.order_date) IS NULL
            OR max(o.order_date) < CAST({_AS_OF} - INTERVAL 90 DAY AS DATE)"""


# Columns of the three tables.
_COLUMNS = {
    "customers": "customer_id, name, signup_date, country",
    "orders": "order_id, customer_id, order_date, amount, status",
    "payments": "payment_id, order_id, payment_date, payment_status",
}

_SELECTS = {
    "q1_revenue_per_customer": _revenue("dom_customers", "dom_native_orders", "F"),
    "q2_monthly_revenue": _monthly("dom_native_orders", "F"),
    "q3_unpaid_customers": _unpaid("dom_customers", "dom_native_orders", "dom_payments"),
    "q4_top_customers": _top("dom_customers", "dom_native_orders", "F"),
    "q5_inactive_customers": _inactive("dom_customers", "dom_native_orders"),
    "q1_clean": _revenue("clean_customers", "clean_orders", "completed"),
    "q2_clean": _monthly("clean_orders", "completed"),
    "q3_clean": _unpaid("clean_customers", "clean_orders", "clean_payments"),
    "q4_clean": _top("clean_customers", "clean_orders", "completed"),
    "q5_clean": _inactive("clean_customers", "clean_orders"),
    "whole_run_revenue": _revenue("clean_customers", "clean_orders", "completed"),
    "whole_run_top_customers": _top("clean_customers", "clean_orders", "completed"),
    "whole_run_unpaid_customers": _unpaid("clean_customers", "clean_orders", "clean_payments"),
    "whole_run_inactive_customers": _inactive("clean_customers", "clean_orders"),
    "wellformed_rows": """SELECT order_id, customer_id,
        CAST(CAST(amount AS DECIMAL(15, 2)) AS DOUBLE) AS amount, status
        FROM dom_native_orders WHERE order_id % 50 NOT IN (7, 8)""",
    "scan_csv_by_position": """SELECT CAST(order_id AS INT) AS order_id,
        CAST(customer_id AS INT) AS customer_id, order_date, amount, status FROM raw_orders""",
    "quarantine_text_csv": """SELECT customer_id, CASE customer_id % 6
            WHEN 0 THEN name || chr(10) || 'b' WHEN 1 THEN name || chr(13) || chr(10) || 'c'
            WHEN 2 THEN name || ',"q"' WHEN 3 THEN NULL WHEN 4 THEN ' ' || name || ' '
            ELSE name END AS name, signup_date, country FROM raw_customers""",
    "malformed_rows": """SELECT order_id, customer_id,
        CASE WHEN order_id % 50 = 8 THEN amount END AS amount,
        order_id || ',' || customer_id || ',2024-01-15,'
            || CASE WHEN order_id % 50 = 7 THEN 'abc'
               ELSE CAST(CAST(amount AS DECIMAL(15, 2)) AS VARCHAR) END
            || ',' || status || CASE WHEN order_id % 50 = 8 THEN ',extra' ELSE '' END AS bad_line
        FROM dom_native_orders WHERE order_id % 50 IN (7, 8)""",
    "ddl_create_tables": "SELECT * FROM dom_orders",
    "ddl_replace_tables": """SELECT 'customers' AS table_name, customer_id AS row_key
        FROM dom_customers UNION ALL SELECT 'orders', order_id FROM dom_orders
        UNION ALL SELECT 'payments', payment_id FROM dom_payments""",
    "partitioned_orders_month": """SELECT *, 1995 AS year, 3 AS month FROM dom_orders
        WHERE year(order_date) = 1995 AND month(order_date) = 3""",
    "partitioned_orders": """SELECT *, CAST(year(order_date) AS INT) AS year,
        CAST(month(order_date) AS INT) AS month FROM dom_orders""",
    "clustered_orders": "SELECT * FROM dom_orders",
    "upsert_orders": f"""SELECT {_COLUMNS["orders"]} FROM raw_orders
        QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY seq DESC) = 1
        UNION ALL
        SELECT order_id + 1000000000, customer_id, order_date, amount, status
        FROM raw_orders WHERE seq = 1""",
    "upsert_table_orders": f"""SELECT {_COLUMNS["orders"]} FROM raw_orders
        QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY seq DESC) = 1
        UNION ALL
        SELECT order_id + 1000000000, customer_id, order_date, amount, status
        FROM raw_orders WHERE seq = 1""",
    "readable_files_orders": """SELECT order_id, customer_id,
        CAST(order_date AS VARCHAR) AS order_date, amount, status
        FROM dom_native_orders WHERE status <> 'P'""",
    "skipped_files_orders": """SELECT DISTINCT 'broken-N.csv.gz' AS file, true AS names_the_reason,
        status AS missing_status FROM dom_native_orders WHERE status = 'P'""",
    "table_rules_orders": """SELECT rule, CASE WHEN value >= least AND value <= most
            THEN 'passed' ELSE 'failed' END AS verdict, true AS exact_within_bounds FROM (
        SELECT 'rows' AS rule, CAST(count(*) AS DOUBLE) AS value, 10.0 AS least, 1e18 AS most
            FROM raw_orders
        UNION ALL SELECT 'no_rows', count(*), 0, 10 FROM raw_orders
        UNION ALL SELECT 'orders', count(DISTINCT order_id), 10, 1e18 FROM raw_orders
        UNION ALL SELECT 'customers', count(DISTINCT customer_id), 10, 1e18 FROM raw_orders
        UNION ALL SELECT 'median_amount', median(amount), 0, 1e18 FROM raw_orders
        UNION ALL SELECT 'low_amount', quantile_cont(amount, 0.001), 1e12, 1e18 FROM raw_orders
        UNION ALL SELECT 'known_customers', count(DISTINCT customer_id) FILTER (customer_id IN
            (SELECT customer_id FROM raw_customers)) / count(DISTINCT customer_id), 0.5, 1
            FROM raw_orders) r""",
    "clustered_orders_two_columns": """SELECT * FROM dom_orders
        WHERE customer_id < 500 OR order_date < DATE '1993-01-01'""",
    "expectations_warned": f"""SELECT order_id, seq, concat_ws(',',
        CASE WHEN amount IS NULL OR amount < 0 THEN 'amount_valid' END,
        CASE WHEN {_parsed("order_date")} IS NULL THEN 'date_readable' END,
        CASE WHEN lower(trim(status)) NOT IN ('completed', 'pending', 'cancelled')
            THEN 'status_known' END) AS failed_rules FROM raw_orders""",
    "expectations_that_stop": f"""SELECT rule, broken > 0 AS stops, true AS has_rows,
        least(broken, 1) AS broken FROM (
        SELECT 'amount_valid' AS rule, count(*) FILTER (amount IS NULL OR amount < 0) AS broken
            FROM raw_orders
        UNION ALL SELECT 'date_readable', count(*) FILTER ({_parsed("order_date")} IS NULL)
            FROM raw_orders
        UNION ALL SELECT 'status_known', count(*) FILTER
            (lower(trim(status)) NOT IN ('completed', 'pending', 'cancelled')) FROM raw_orders
        UNION ALL SELECT 'has_a_key', count(*) FILTER (order_id IS NULL) FROM raw_orders) r""",
    "csv_modes_orders": """SELECT 'PERMISSIVE' AS mode, count(*) AS n FROM dom_native_orders
        UNION ALL SELECT 'DROPMALFORMED', count(*) FROM dom_native_orders
            WHERE order_id % 50 NOT IN (7, 8)
        UNION ALL SELECT 'FAILFAST', CASE WHEN count(*) FILTER (order_id % 50 IN (7, 8)) = 0
            THEN count(*) END FROM dom_native_orders""",
    "inactive_today": _inactive("dom_customers", "dom_native_orders").replace(
        _AS_OF, "CAST(current_date AS DATE)"
    ),
    "incremental_revenue_per_customer": _revenue("clean_customers", "clean_orders", "completed"),
    "incremental_monthly_revenue": _monthly("clean_orders", "completed"),
    "incremental_unpaid_customers": _unpaid("clean_customers", "clean_orders", "clean_payments"),
    "incremental_top_customers": _top("clean_customers", "clean_orders", "completed"),
    "incremental_inactive_customers": _inactive("clean_customers", "clean_orders"),
    "drop_null_name": "SELECT * FROM named_customers",
    "drop_invalid_amount": "SELECT * FROM raw_orders WHERE amount IS NOT NULL AND amount >= 0",
    "filter_completed": "SELECT * FROM dom_native_orders WHERE status = 'F'",
    "unparsed_dates": f"""SELECT 'customers' AS table_name, customer_id AS row_key,
        'signup_date' AS column_name, signup_date AS original FROM first_customers
        WHERE signup_date IS NOT NULL AND {_parsed("signup_date")} IS NULL
        UNION ALL SELECT 'orders', order_id, 'order_date', order_date FROM first_orders
        WHERE amount >= 0 AND order_date IS NOT NULL AND {_parsed("order_date")} IS NULL
        UNION ALL SELECT 'payments', payment_id, 'payment_date', payment_date FROM first_payments
        WHERE payment_date IS NOT NULL AND {_parsed("payment_date")} IS NULL""",
    "unparsed_customer_dates": f"""SELECT 'customers' AS table_name, customer_id AS row_key,
        name, 'signup_date' AS column_name, signup_date AS original FROM first_customers
        WHERE signup_date IS NOT NULL AND {_parsed("signup_date")} IS NULL""",
    "normalise_country": f"SELECT customer_id, {_titled('country')} AS country FROM raw_customers",
    "normalise_order_status": "SELECT order_id, lower(trim(status)) AS status FROM raw_orders",
    "normalise_payment_status": """SELECT payment_id,
        lower(trim(payment_status)) AS payment_status FROM raw_payments""",
    "month_bucket": """SELECT order_id, strftime(order_date, '%Y-%m') AS month
        FROM dom_native_orders""",
    "dedup_documents": """SELECT doc_id, text FROM documents
        QUALIFY row_number() OVER (PARTITION BY text ORDER BY doc_id) = 1""",
    "fk_valid_orders": "SELECT * FROM clean_orders",
    "fk_orphan_orders": "SELECT * FROM orphan_orders",
    "fk_valid_payments": "SELECT * FROM clean_payments",
    "fk_orphan_payments": "SELECT * FROM orphan_payments",
    "quarantine_orders_csv": "SELECT * FROM orphan_orders",
    "quarantine_payments_csv": "SELECT * FROM orphan_payments",
    "quarantine_reasons_orders": """SELECT *, CASE WHEN customer_id IN
        (SELECT customer_id FROM raw_customers) THEN 'parent_rejected' ELSE 'missing_parent' END
        AS reason FROM orphan_orders""",
    "quarantine_reasons_payments": """SELECT *, CASE WHEN order_id IN
        (SELECT order_id FROM raw_orders) THEN 'parent_rejected' ELSE 'missing_parent' END
        AS reason FROM orphan_payments""",
    "join_inner": """SELECT o.*, c.name FROM dom_customers c
        JOIN dom_native_orders o ON c.customer_id = o.customer_id""",
    "join_left": """SELECT c.customer_id, c.name, o.order_id, o.order_date, o.amount, o.status
        FROM dom_customers c LEFT JOIN dom_native_orders o ON c.customer_id = o.customer_id""",
    "exists_orders": """SELECT * FROM dom_customers c WHERE EXISTS
        (SELECT 1 FROM dom_native_orders o WHERE o.customer_id = c.customer_id)""",
    "distinct_paid_customers": "SELECT * FROM paid_customers",
    "not_in_paid": """SELECT * FROM dom_customers
        WHERE customer_id NOT IN (SELECT customer_id FROM paid_customers)""",
    "not_in_paid_null_aware": """SELECT * FROM dom_customers WHERE customer_id NOT IN
        (SELECT CASE WHEN amount IS NOT NULL THEN customer_id END FROM raw_orders)""",
    "broadcast_join": """SELECT o.*, c.name FROM dom_customers c
        JOIN dom_native_orders o ON c.customer_id = o.customer_id""",
    "hot_key_join": """SELECT *, payment_status = 'success' AS settled FROM dom_payments""",
    "hot_key_join_mixed_types": """SELECT order_id, grp, 'g' || grp AS name FROM (
        SELECT order_id, CAST(CASE WHEN order_id % 3 = 0 THEN 7 ELSE customer_id % 50 END AS INT)
            AS grp FROM dom_native_orders) o WHERE grp < 40""",
    "refused_customers": """SELECT customer_id, name, signup_date, country,
        'missing_name' AS reason FROM raw_customers WHERE name IS NULL
        UNION ALL SELECT customer_id, name, signup_date, country, 'duplicate'
        FROM named_customers
        QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY seq) > 1""",
    "refused_orders": f"""SELECT {_COLUMNS["orders"]}, 'invalid_amount' AS reason
        FROM first_orders WHERE amount IS NULL OR amount < 0
        UNION ALL SELECT {_COLUMNS["orders"]}, 'duplicate' FROM raw_orders
        QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY seq) > 1""",
    "refused_payments": f"""SELECT {_COLUMNS["payments"]}, 'duplicate' AS reason
        FROM raw_payments WHERE seq > 1""",
    "quality_expectations": f"""SELECT rule, passed, total - passed AS failed FROM (
        SELECT 'amount_valid' AS rule, count(*) FILTER (amount >= 0) AS passed,
            count(*) AS total FROM raw_orders
        UNION ALL SELECT 'date_readable',
            count(*) FILTER ({_parsed("order_date")} IS NOT NULL), count(*) FROM raw_orders
        UNION ALL SELECT 'status_known',
            count(*) FILTER (lower(trim(status)) IN ('completed', 'pending', 'cancelled')),
            count(*) FROM raw_orders) r""",
    "expectations_dropped": f"""SELECT * FROM raw_orders WHERE amount >= 0
        AND {_parsed("order_date")} IS NOT NULL
        AND lower(trim(status)) IN ('completed', 'pending', 'cancelled')""",
    "not_null_violations": """SELECT 'customer_id' AS "column",
        count(*) FILTER (customer_id IS NULL) AS nulls FROM raw_customers
        UNION ALL SELECT 'name', count(*) FILTER (name IS NULL) FROM raw_customers""",
    "stream_ingest_orders": f"SELECT {_COLUMNS['orders']} FROM raw_orders",
    "stream_late_parent": "SELECT * FROM clean_orders",
    "stream_settled_orders": "SELECT * FROM clean_orders",
    "stream_settled_orphans": "SELECT * FROM orphan_orders",
    "stream_rerun_idempotent": f"SELECT {_COLUMNS['orders']} FROM raw_orders",
    "stream_clean_orders": "SELECT * FROM clean_orders",
}

for _name, _columns in _COLUMNS.items():
    _date = {"customers": "signup_date", "orders": "order_date", "payments": "payment_date"}[_name]
    _key = _columns.split(",")[0]
    _SELECTS[f"scan_csv_{_name}"] = f"SELECT {_columns} FROM raw_{_name}"
    _SELECTS[f"dedup_{_name}"] = f"""SELECT {_columns} FROM raw_{_name}
        QUALIFY row_number() OVER (PARTITION BY {_key} ORDER BY seq) = 1"""
    _SELECTS[f"parse_dates_{_name}"] = f"""SELECT {_key}, {_date} AS original,
        {_parsed(_date)} AS parsed FROM raw_{_name}"""
    _SELECTS[f"clean_{_name}"] = f"SELECT * FROM clean_{_name}"
    _SELECTS[f"table_roundtrip_{_name}"] = (
        f"SELECT * FROM {'clean_customers' if _name == 'customers' else 'good_' + _name}"
    )


def _counts() -> str:
    first = {n: f"first_{n}" for n in _COLUMNS}
    rows = []
    for name in _COLUMNS:
        date = {"customers": "signup_date", "orders": "order_date", "payments": "payment_date"}[
            name
        ]
        rule = "amount >= 0" if name == "orders" else "true"
        good = "clean_customers" if name == "customers" else f"good_{name}"
        orphan = "0" if name == "customers" else f"(SELECT count(*) FROM orphan_{name})"
        stages = {
            "raw": f"(SELECT count(*) FROM raw_{name})",
            "kept_first": f"(SELECT count(*) FROM {first[name]})",
            "passed_rules": f"(SELECT count(*) FROM {good})",
            "orphan": orphan,
            "clean": f"(SELECT count(*) FROM clean_{name})",
            "unparsed": f"(SELECT count(*) FROM {first[name]} WHERE {rule} AND "
            f"{date} IS NOT NULL AND {_parsed(date)} IS NULL)",
            "missing": f"(SELECT count(*) FROM {first[name]} WHERE {rule} AND {date} IS NULL)",
        }
        rows += [
            f"SELECT '{name}' AS table_name, '{stage}' AS stage, CAST({n} AS BIGINT) AS n"
            for stage, n in stages.items()
        ]
    return "\nUNION ALL ".join(rows)


_SELECTS["row_counts"] = _counts()

SQL = {name: _with(select) for name, select in _SELECTS.items()}
