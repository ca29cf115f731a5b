"""The same results as plain SQL over the supplied tables, written for DuckDB.

Nothing here uses the library: the noise draws, the quality rules and the reports are
spelled out again, as common table expressions that each query picks from.
"""

from __future__ import annotations

import re

ORACLES: dict[str, str] = {}

# Fixed values of the noise, see its operator.
PRIME = 2**31 - 1
FOLD = 1_000_003_391
LEVEL = int(0.3 * PRIME)
NULL_SHARE = 500

COLUMNS = {
    "users": ["user_id", "name", "email", "country", "address", "signup_date"],
    "products": ["product_id", "name", "category", "description", "price"],
    "transactions": ["transaction_id", "user_id", "product_id", "quantity", "transaction_date"],
}
DATES = {"users": "signup_date", "transactions": "transaction_date"}

RAW = {
    "users": """
        SELECT c_custkey AS user_id, c_name AS name,
               lower(replace(c_name, '#', '.')) || '@example.com' AS email,
               n_name AS country, c_mktsegment AS address,
               CAST('2000-06-01' AS DATE) AS signup_date
        FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    "products": """
        SELECT p_partkey AS product_id, p_name AS name, p_type AS category,
               p_brand || ' ' || CAST(p_size AS VARCHAR) AS description,
               p_retailprice AS price
        FROM part""",
    "transactions": """
        SELECT l_orderkey AS transaction_id, o_custkey AS user_id, l_partkey AS product_id,
               CAST(l_quantity AS INTEGER) AS quantity,
               CAST(o_orderdate AS DATE) AS transaction_date
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
}

RUNS = """
    SELECT event_type AS experiment, user_id % 3 AS run,
           CASE WHEN event_id % 2 = 0 THEN 'silver' ELSE 'gold' END AS stage,
           CAST(event_id % 5 AS VARCHAR) AS item, value AS transform_s,
           value / 10 AS write_s, CAST(1 AS BIGINT) AS "rows",
           CASE WHEN event_type = 'error' THEN 'failed' ELSE 'success' END AS status,
           'steps of ' || event_type AS description
    FROM events"""

KEYS_OK = {
    "users": ["user_id"],
    "products": ["product_id"],
    "transactions": ["transaction_id", "user_id", "product_id"],
}
RULES = {
    "users": {
        "name_present": "name IS NOT NULL AND name <> ''",
        "country_present": "country IS NOT NULL AND country <> ''",
        "address_present": "address IS NOT NULL AND address <> ''",
        "email_valid": "email IS NOT NULL AND email <> '' AND contains(email, '@')",
        "signup_date_recent": "TRY_CAST(signup_date AS DATE) > DATE '2000-01-01'",
    },
    "products": {
        "price_positive": "price IS NOT NULL AND price > 0",
        "name_present": "name IS NOT NULL AND name <> ''",
        "category_present": "category IS NOT NULL AND category <> ''",
        "description_present": "description IS NOT NULL AND description <> ''",
    },
    "transactions": {
        "quantity_positive": "quantity IS NOT NULL AND quantity > 0",
        "transaction_date_recent": "TRY_CAST(transaction_date AS DATE) > DATE '2000-01-01'",
    },
}


def _all_rules(table: str) -> dict[str, str]:
    known = {f"{k}_known": f"{k} IS NOT NULL" for k in KEYS_OK[table]}
    above = {f"{k}_positive": f"{k} > 0" for k in KEYS_OK[table]}
    return {**known, **above, **RULES[table]}


def _noisy(table: str, keys: list[str], bad: str = f"draw < {LEVEL}") -> str:
    folded = "CAST(0 AS BIGINT)"
    for key in keys:
        folded = f"(({folded} * {FOLD} + {key} % {PRIME}) % {PRIME})"
    columns = COLUMNS[table]
    number = "list_extract([-1, -99, 0], CAST(variant % 3 AS INTEGER) + 1)"
    old_date = "DATE '2025-01-01' - (CAST(variant * 7919 % 146000 AS INTEGER) + 36500)"
    wrong = {
        "user_id": f"CAST({number} AS BIGINT)",
        "product_id": f"CAST({number} AS BIGINT)",
        "transaction_id": f"CAST({number} AS BIGINT)",
        "quantity": f"CAST({number} AS INTEGER)",
        "price": f"CAST({number} AS DOUBLE)",
        "email": "replace(email, '@', '_at_')",
        "signup_date": old_date,
        "transaction_date": old_date,
    }
    cells = ", ".join(
        f"CASE WHEN NOT ({bad}) OR cell <> {i} THEN {c} "
        f"WHEN share < {NULL_SHARE} THEN NULL ELSE {wrong.get(c, chr(39) * 2)} END AS {c}"
        for i, c in enumerate(columns)
    )
    width = len(columns)
    return f"""
        SELECT {cells} FROM (
            SELECT *, draw % {width} AS cell, draw // {width} % 1000 AS share,
                   draw // {width * 1000} AS variant
            FROM (SELECT *, h * (h + 1) % {PRIME} AS draw
                  FROM (SELECT *, {folded} * 48271 % {PRIME} AS h FROM raw_{table})))"""


def _text_dates(table: str, key: str, col: str) -> str:
    others = ", ".join(c for c in COLUMNS[table] if c != col)
    return f"""
        SELECT {others}, CASE {key} % 5 WHEN 0 THEN 'invalid-date' WHEN 1 THEN NULL
            WHEN 2 THEN '' WHEN 3 THEN '1899-01-01' ELSE CAST({col} AS VARCHAR) END AS {col}
        FROM raw_{table}"""


def _clean(table: str, source: str) -> str:
    return f"SELECT * FROM {source}_{table} WHERE " + " AND ".join(
        f"({rule})" for rule in _all_rules(table).values()
    )


_CTES: dict[str, str] = {f"raw_{table}": sql for table, sql in RAW.items()}
_CTES["noisy_users"] = _noisy("users", ["user_id"])
_CTES["noisy_products"] = _noisy("products", ["product_id"])
_CTES["noisy_transactions"] = _noisy("transactions", ["transaction_id", "product_id"])
_CTES["text_users"] = _text_dates("users", "user_id", "signup_date")
_CTES["text_transactions"] = _text_dates("transactions", "transaction_id", "transaction_date")
for _table in COLUMNS:
    _CTES[f"clean_{_table}"] = _clean(_table, "raw")
    _CTES[f"denoised_{_table}"] = _clean(_table, "noisy")
for _prefix, _name in (("clean", "silver"), ("denoised", "restored")):
    _CTES[f"{_name}_transactions"] = f"""
        SELECT * FROM {_prefix}_transactions
        WHERE user_id IN (SELECT user_id FROM {_prefix}_users)
          AND product_id IN (SELECT product_id FROM {_prefix}_products)"""
_CTES["silver_users"] = "SELECT * FROM clean_users"
_CTES["silver_products"] = "SELECT * FROM clean_products"
_CTES["daily"] = """
        SELECT transaction_date AS day,
               COALESCE(SUM(quantity * CAST(price AS DECIMAL(12, 2))), 0) AS total
        FROM silver_transactions LEFT JOIN silver_products USING (product_id)
        GROUP BY transaction_date"""
_CTES["spine"] = """
        SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS day
        FROM (SELECT MIN(transaction_date) AS lo, MAX(transaction_date) AS hi
              FROM silver_transactions)"""
_CTES["series"] = """
        SELECT spine.day, COALESCE(daily.total, 0) AS total
        FROM spine LEFT JOIN daily ON spine.day = daily.day"""
_CTES["sold"] = """
        SELECT category, product_id, name, SUM(quantity) AS sold
        FROM silver_transactions JOIN silver_products USING (product_id)
        GROUP BY category, product_id, name"""
_CTES["best"] = """
        SELECT category, product_id, name, CAST(sold AS BIGINT) AS total_quantity_sold
        FROM (SELECT *, RANK() OVER (PARTITION BY category ORDER BY sold DESC) AS place FROM sold)
        WHERE place <= 5"""
_CTES["runs"] = RUNS


def _sums(measure: str) -> str:
    total = "CAST(SUM(CAST({} AS DECIMAL(28, 9))) AS DOUBLE)"
    staged = [
        f"COALESCE({total.format(f'CASE WHEN stage = {chr(39)}{stage}{chr(39)} THEN {measure} END')}"
        f", 0.0) AS {stage}_{measure}"
        for stage in ("silver", "gold")
    ]
    return ", ".join([*staged, f"{total.format(measure)} AS total_{measure}"])


_CTES["totals"] = f"""
        SELECT experiment, run, {_sums('transform_s')}, {_sums('write_s')},
               COALESCE(CAST(SUM(CAST(transform_s AS DECIMAL(28, 9))) AS DOUBLE), 0.0)
                   + COALESCE(CAST(SUM(CAST(write_s AS DECIMAL(28, 9))) AS DOUBLE), 0.0) AS total_s,
               bool_and(status = 'success') AS succeeded, MIN(description) AS description
        FROM runs GROUP BY experiment, run"""
_CTES["summary"] = """
        SELECT experiment, MIN(description) AS description, COUNT(*) AS successful_runs,
               AVG(silver_transform_s) AS avg_silver_s, AVG(gold_transform_s) AS avg_gold_s,
               AVG(total_transform_s) AS avg_total_s, AVG(total_write_s) AS avg_write_s,
               MIN(total_transform_s) AS min_total_s, MAX(total_transform_s) AS max_total_s,
               stddev_pop(total_transform_s) AS std_total_s
        FROM totals WHERE succeeded GROUP BY experiment"""


def _needed(sql: str, found: list[str]) -> list[str]:
    """The expressions a query reads, those they read first."""
    for name in re.findall(r"(?:FROM|JOIN)\s+(\w+)", sql):
        if name in _CTES and name not in found:
            _needed(_CTES[name], found)
            found.append(name)
    return found


def oracle(name: str, sql: str) -> None:
    ctes = ",\n".join(f"    {cte} AS ({_CTES[cte]})" for cte in _needed(sql, []))
    ORACLES[name] = f"WITH\n{ctes}\n{sql}" if ctes else sql


def _select(table: str, nullify_text: bool = False) -> str:
    """Every column of a table, dates as text; CSV cannot tell "" from NULL."""
    texts = {"name", "email", "country", "address", "category", "description"}
    parts = []
    for col in COLUMNS[table]:
        if col == DATES.get(table):
            parts.append(f"CAST({col} AS VARCHAR) AS {col}")
        elif nullify_text and col in texts:
            parts.append(f"nullif({col}, '') AS {col}")
        else:
            parts.append(col)
    return ", ".join(parts)


def _where(table: str, *rules: str) -> str:
    return " AND ".join(f"({_all_rules(table)[rule]})" for rule in rules)


U, P, X = "users", "products", "transactions"
STAGE_TOTALS = """
SELECT experiment, run,
       ROUND(silver_transform_s, 6) AS silver_transform_s,
       ROUND(gold_transform_s, 6) AS gold_transform_s,
       ROUND(total_transform_s, 6) AS total_transform_s,
       ROUND(silver_write_s, 6) AS silver_write_s, ROUND(gold_write_s, 6) AS gold_write_s,
       ROUND(total_write_s, 6) AS total_write_s, ROUND(total_s, 6) AS total_s,
       succeeded, description
FROM totals"""
DAY_TO_DAY = """
SELECT CAST(day AS VARCHAR) AS transaction_date, CAST(total AS DOUBLE) AS total_sales,
       CAST(before AS DOUBLE) AS previous_day_sales,
       CASE WHEN before <> 0 THEN (CAST(total AS DOUBLE) - CAST(before AS DOUBLE))
            / CAST(before AS DOUBLE) * 100 END AS percent_change
FROM (SELECT day, total, LAG(total) OVER (ORDER BY day) AS before FROM series)
ORDER BY day"""
TOP_SPENDERS = """
SELECT user_id, u.name, CAST(SUM(quantity * CAST(price AS DECIMAL(12, 2))) AS DOUBLE) AS total_spent
FROM silver_transactions JOIN silver_users AS u USING (user_id)
JOIN silver_products USING (product_id)
GROUP BY user_id, u.name ORDER BY total_spent DESC, user_id LIMIT 10"""


def _country(transactions: str, users: str, products: str) -> str:
    return f"""
SELECT u.country,
       CAST(COALESCE(SUM(t.quantity * CAST(p.price AS DECIMAL(12, 2))), 0) AS DOUBLE)
           AS total_sales,
       COUNT(DISTINCT t.transaction_id) AS total_transactions,
       COUNT(DISTINCT t.user_id) AS total_users
FROM {users} AS u LEFT JOIN {transactions} AS t ON u.user_id = t.user_id
LEFT JOIN {products} AS p ON t.product_id = p.product_id
GROUP BY u.country ORDER BY total_sales DESC, u.country"""


COUNTRY = _country("silver_transactions", "silver_users", "silver_products")

# Scans and sinks: what was written is what is read.
oracle("scan_csv_bronze", f"SELECT {_select(U, nullify_text=True)} FROM noisy_users")
oracle("scan_csv_dateformat", f"SELECT {_select(X)} FROM noisy_transactions")
oracle("scan_parquet_silver", f"SELECT {_select(X)} FROM silver_transactions")
oracle(
    "scan_partitioned_products",
    f"SELECT {_select(P)} FROM silver_products WHERE category IN ('ECONOMY', 'SMALL')",
)
oracle("scan_run_metrics_json", "SELECT * FROM runs")
oracle("sql_report", TOP_SPENDERS)
oracle("sink_parquet_roundtrip", f"SELECT {_select(U)} FROM silver_users")
oracle("sink_parquet_codec", f"SELECT {_select(P)} FROM silver_products")
oracle("sink_partitioned", f"SELECT {_select(P)} FROM silver_products")
oracle("sink_gold_table", COUNTRY)
oracle("sink_gold_parquet", DAY_TO_DAY)
oracle("sink_csv_roundtrip", f"SELECT {_select(P)} FROM silver_products")
oracle("sink_run_metrics_json", STAGE_TOTALS)

# Cleaning.
_keys = KEYS_OK[X]
oracle(
    "clean_null_ids",
    f"SELECT {_select(X)} FROM noisy_transactions WHERE "
    + _where(X, *[f"{k}_known" for k in _keys]),
)
oracle(
    "clean_positive_ids",
    f"SELECT {_select(X)} FROM noisy_transactions WHERE "
    + _where(X, *[f"{k}_positive" for k in _keys]),
)
for _name, _table, _source, _rules in (
    ("clean_quantity", X, "noisy", ["quantity_positive"]),
    ("clean_transaction_date", X, "text", ["transaction_date_recent"]),
    ("clean_price", P, "noisy", ["price_positive"]),
    ("clean_product_text", P, "noisy", ["name_present", "category_present", "description_present"]),
    ("clean_user_text", U, "noisy", ["name_present", "country_present", "address_present"]),
    ("clean_email", U, "noisy", ["email_valid"]),
    ("clean_signup_date", U, "text", ["signup_date_recent"]),
):
    oracle(
        _name, f"SELECT {_select(_table)} FROM {_source}_{_table} WHERE {_where(_table, *_rules)}"
    )
for _table in COLUMNS:
    oracle(f"clean_{_table}", f"SELECT {_select(_table)} FROM denoised_{_table}")
oracle(
    "reject_predicates",
    f"SELECT {_select(U)} FROM noisy_users WHERE user_id IS NULL OR user_id <= 0 "
    "OR email IS NULL OR email NOT LIKE '%@%'",
)
oracle(
    "quality_report",
    "\nUNION ALL\n".join(
        f"SELECT '{table}' AS table_name, '{rule}' AS rule, "
        f"COUNT(*) FILTER (WHERE ({check}) IS NOT TRUE) AS rows_failing, "
        f"COUNT(*) AS rows_before, COUNT(*) FILTER (WHERE {_where(table, *_all_rules(table))}) "
        f"AS rows_after, "
        f"COUNT(*) FILTER (WHERE ({_where(table, *_all_rules(table))}) IS NOT TRUE) "
        f"AS rows_removed FROM noisy_{table}"
        for table in COLUMNS
        for rule, check in _all_rules(table).items()
    ),
)
oracle(
    "silver_write_counts",
    "\nUNION ALL\n".join(
        f"SELECT '{table}' AS table_name, '{rule}' AS rule, "
        f"COUNT(*) FILTER (WHERE ({check}) IS NOT TRUE) AS rows_failing, "
        f"COUNT(*) AS rows_before, COUNT(*) FILTER (WHERE {_where(table, *_all_rules(table))}) "
        f"AS rows_after, "
        f"COUNT(*) FILTER (WHERE ({_where(table, *_all_rules(table))}) IS NOT TRUE) "
        f"AS rows_removed, (SELECT COUNT(*) FROM {kept}) AS rows_written FROM noisy_{table}"
        for table, kept in (
            ("users", "denoised_users"),
            ("products", "denoised_products"),
            ("transactions", "restored_transactions"),
        )
        for rule, check in _all_rules(table).items()
    ),
)
oracle(
    "sink_replace",
    f"SELECT {_select('users')} FROM (SELECT * REPLACE (upper(name) AS name) FROM clean_users)",
)
oracle(
    "try_parse_date",
    "SELECT transaction_id, transaction_date, "
    "CAST(TRY_CAST(transaction_date AS DATE) AS VARCHAR) AS parsed_date FROM text_transactions",
)

# Integrity and joins.
oracle(
    "fk_enforce_users",
    f"SELECT {_select(X)} FROM noisy_transactions "
    "WHERE user_id IN (SELECT user_id FROM denoised_users)",
)
oracle(
    "fk_enforce_products",
    f"SELECT {_select(X)} FROM noisy_transactions "
    "WHERE product_id IN (SELECT product_id FROM denoised_products)",
)
oracle("fk_enforce_both", f"SELECT {_select(X)} FROM restored_transactions")
_ORDER = "transaction_date, transaction_id, product_id, user_id, quantity"
oracle(
    "long_moving_average",
    f"""
SELECT {_select(X)}, round(sum(quantity) OVER w / count(*) OVER w, 6) AS moving_average
FROM clean_transactions
WINDOW w AS (ORDER BY {_ORDER} ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)""",
)
oracle(
    "long_period_over_period",
    f"""
SELECT {_select(X)}, previous, round(CASE WHEN previous <> 0
    THEN (quantity - previous) / CAST(previous AS DOUBLE) * 100 END, 6) AS percent_change
FROM (SELECT *, lag(quantity, 3) OVER (ORDER BY {_ORDER}) AS previous FROM clean_transactions)""",
)
oracle(
    "long_fill_gaps",
    """
SELECT CAST(DATE '1970-01-01' + CAST(key AS INTEGER) AS VARCHAR) AS day,
    coalesce(orders, 0) AS orders
FROM (SELECT unnest(range(min(user_id), max(user_id) + 1)) AS key FROM raw_transactions)
LEFT JOIN (SELECT user_id, count(DISTINCT transaction_id) AS orders
    FROM raw_transactions GROUP BY user_id) ON key = user_id""",
)
oracle("scan_other_scheme", f"SELECT {_select(X)} FROM restored_transactions")
oracle(
    "fk_orphans",
    f"SELECT {_select(X)} FROM noisy_transactions AS t WHERE NOT EXISTS "
    "(SELECT 1 FROM denoised_users AS u WHERE u.user_id = t.user_id)",
)
for _name in ("join_broadcast", "join_sort_merge"):
    oracle(
        _name,
        "SELECT transaction_id, product_id, category, quantity, price "
        "FROM silver_transactions JOIN silver_products USING (product_id)",
    )

# Aggregates and calendar.
oracle(
    "date_bounds",
    "SELECT CAST(MIN(transaction_date) AS VARCHAR) AS min_date, "
    "CAST(MAX(transaction_date) AS VARCHAR) AS max_date FROM silver_transactions",
)
oracle(
    "daily_sales",
    "SELECT CAST(day AS VARCHAR) AS transaction_date, CAST(total AS DOUBLE) AS total_sales "
    "FROM daily",
)
oracle(
    "product_quantity",
    "SELECT category, product_id, name, CAST(sold AS BIGINT) AS total_quantity_sold FROM sold",
)
oracle("distinct_keys", "SELECT DISTINCT user_id FROM silver_transactions")
oracle(
    "table_counts",
    " UNION ALL ".join(
        f"SELECT '{table}' AS table_name, COUNT(*) AS \"rows\" FROM silver_{table}"
        for table in COLUMNS
    ),
)
oracle("category_counts", 'SELECT category, COUNT(*) AS "rows" FROM best GROUP BY category')
oracle("date_spine", "SELECT CAST(day AS VARCHAR) AS transaction_date FROM spine")
oracle(
    "date_spine_fill",
    "SELECT CAST(day AS VARCHAR) AS transaction_date, CAST(total AS DOUBLE) AS total_sales "
    "FROM series",
)

# Reports.
oracle("top_spenders", TOP_SPENDERS)
oracle("top_n_per_group", "SELECT * FROM best")
oracle("country_performance", COUNTRY)
oracle("day_to_day_sales", DAY_TO_DAY)
oracle(
    "sales_moving_average",
    """
SELECT CAST(day AS VARCHAR) AS transaction_date, CAST(total AS DOUBLE) AS total_sales,
       CAST(SUM(total) OVER week AS DOUBLE) / COUNT(*) OVER week AS moving_average_sales
FROM series WINDOW week AS (ORDER BY day ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)
ORDER BY day""",
)

# Noise.
for _table in COLUMNS:
    oracle(f"inject_noise_{_table}", f"SELECT {_select(_table)} FROM noisy_{_table}")
_CTES["exact_users"] = _noisy(
    "users",
    ["user_id"],
    "row_number() OVER (ORDER BY draw, user_id) <= floor(0.03 * COUNT(*) OVER ())",
)
oracle("inject_noise_exact", f"SELECT {_select(U)} FROM exact_users")

# Run metrics.
oracle(
    "run_summary",
    """
SELECT experiment, description, successful_runs, ROUND(avg_silver_s, 6) AS avg_silver_s,
       ROUND(avg_gold_s, 6) AS avg_gold_s, ROUND(avg_total_s, 6) AS avg_total_s,
       ROUND(avg_write_s, 6) AS avg_write_s, ROUND(min_total_s, 6) AS min_total_s,
       ROUND(max_total_s, 6) AS max_total_s, ROUND(std_total_s, 6) AS std_total_s
FROM summary ORDER BY summary.avg_total_s, experiment""",
)
oracle("stage_totals", STAGE_TOTALS)
oracle(
    "group_vs_baseline",
    """
SELECT s.experiment, ROUND(s.avg_total_s, 6) AS avg_total_s,
       ROUND(b.avg_total_s, 6) AS baseline_s,
       ROUND(b.avg_total_s / s.avg_total_s, 6) AS times_faster,
       ROUND(b.avg_total_s - s.avg_total_s, 6) AS saved_s
FROM summary AS s JOIN summary AS b ON b.experiment = 'view' AND s.experiment <> 'view'""",
)
oracle(
    "layer_share",
    """
SELECT experiment,
       ROUND(avg_silver_s * 100 / (avg_silver_s + avg_gold_s), 6) AS silver_percent,
       ROUND(avg_gold_s * 100 / (avg_silver_s + avg_gold_s), 6) AS gold_percent
FROM summary""",
)
oracle(
    "group_distribution",
    """
SELECT experiment, ROUND(AVG(total_transform_s), 6) AS mean_s,
       ROUND(quantile_cont(total_transform_s, 0.5), 6) AS median_s,
       ROUND(stddev_pop(total_transform_s), 6) AS std_s,
       ROUND(MIN(total_transform_s), 6) AS min_s, ROUND(MAX(total_transform_s), 6) AS max_s,
       ROUND(quantile_cont(total_transform_s, 0.25), 6) AS q1_s,
       ROUND(quantile_cont(total_transform_s, 0.75), 6) AS q3_s
FROM totals WHERE succeeded GROUP BY experiment""",
)
oracle(
    "group_runs",
    """
SELECT experiment, run, ROUND(total_transform_s, 6) AS total_transform_s
FROM totals WHERE succeeded ORDER BY experiment, totals.total_transform_s, run""",
)

# All layers, from noisy files to a report.
oracle(
    "medallion_end_to_end",
    _country("restored_transactions", "denoised_users", "denoised_products"),
)

oracle(
    "csv_line_breaks",
    """
SELECT user_id, name, email, country,
       address || CASE user_id % 4 WHEN 3 THEN '   ' ELSE ' ' END || name AS address,
       CAST(signup_date AS VARCHAR) AS signup_date
FROM raw_users""",
)

# Prices that no decimal of six places holds: the sums are doubles, to so many digits.
oracle(
    "money_extremes",
    """
SELECT kind, CAST(day AS VARCHAR) AS transaction_date, ROUND(SUM(quantity * price) / unit, 3) AS total
FROM (
    SELECT kind, unit, transaction_date AS day, quantity,
           CASE kind WHEN 'tiny' THEN 4e-7 WHEN 'huge' THEN 1e13
               ELSE CASE WHEN product_id % 2 = 0 THEN 4e-7 ELSE price END END AS price
    FROM raw_transactions JOIN raw_products USING (product_id)
    CROSS JOIN (VALUES ('tiny', 1e-7), ('huge', 1e13), ('mixed', 1.0)) AS k(kind, unit))
GROUP BY kind, unit, day""",
)
