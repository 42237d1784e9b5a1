"""The same queries as SQL over the same tables, for an independent engine."""

from __future__ import annotations

from workload.feeds import AS_OF_DATE, ID_FACTOR

# --- the raw feeds ------------------------------------------------------------


def raw_bookings(day=None) -> str:
    f, o, p = ("cancelled", "completed", "pending") if day == 2 else ("completed", "pending", "cancelled")
    return f"""
SELECT
  CASE WHEN o_orderkey % 101 = 17 THEN NULL ELSE 'B' || (o_orderkey * {ID_FACTOR[day]}) END AS booking_id,
  CASE WHEN o_orderkey % 97 = 13 THEN NULL ELSE 'C' || o_custkey END AS customer_id,
  CASE WHEN o_orderkey % 103 = 7 THEN NULL ELSE 'CARS' || (100 + o_orderkey % 900) END AS car_id,
  CASE WHEN o_orderkey % 107 = 11 THEN NULL
       WHEN o_orderkey % 89 = 5 THEN '2024-MAY-15'
       ELSE strftime(o_orderdate, '%Y-%m-%d') END AS booking_date,
  CASE WHEN o_orderkey % 83 = 3 THEN strftime(o_orderdate + INTERVAL 34 HOUR, '%Y-%m-%d %H:%M:%S')
       ELSE strftime(o_orderdate + INTERVAL 34 HOUR, '%Y-%m-%dT%H:%M:%SZ') END AS start_time,
  CASE WHEN o_orderkey % 79 = 2 THEN NULL
       ELSE strftime(o_orderdate + to_hours(42 + o_orderkey % 17), '%Y-%m-%dT%H:%M:%SZ') END AS end_time,
  CASE WHEN o_orderkey % 109 = 19 THEN NULL
       WHEN o_orderkey % 11 = 4 THEN 'null'
       WHEN o_orderkey % 13 = 6 THEN 'canceled'
       WHEN o_orderstatus = 'F' THEN '{f}'
       WHEN o_orderstatus = 'O' THEN '{o}'
       WHEN o_orderstatus = 'P' THEN '{p}' END AS status,
  o_totalprice + {1.0 if day == 2 else 0.0}::DOUBLE AS total_amount
FROM orders"""


def raw_rentals(number="l_orderkey") -> str:
    return f"""
SELECT
  'B' || ({number}) AS booking_id,
  'C' || l_suppkey AS customer_id,
  'CARS' || (100 + l_partkey % 900) AS car_id,
  strftime(l_shipdate, '%Y-%m-%d') AS booking_date,
  strftime(l_shipdate, '%Y-%m-%dT%H:%M:%SZ') AS start_time,
  '1999-06-01T00:00:00Z' AS end_time,
  'completed' AS status,
  l_extendedprice AS total_amount
FROM lineitem"""


RAW_RENTALS = raw_rentals()
HOT_RENTALS = raw_rentals("CASE WHEN l_returnflag = 'R' THEN 0 ELSE l_orderkey END")


def raw_customers(day=None) -> str:
    home, away = ("active", "inactive") if day == 2 else ("inactive", "active")
    return f"""
SELECT
  CASE WHEN k % 101 = 17 THEN NULL ELSE 'C' || (k * {ID_FACTOR[day]}) END AS customer_id,
  CASE WHEN k % 97 = 13 THEN NULL ELSE c_name END AS name,
  CASE WHEN k % 103 = 7 THEN NULL
       WHEN k % 31 = 3 THEN 'u' || k || '@exa-mple.net'
       WHEN k % 37 = 5 THEN 'u%x' || k || '@example.net'
       WHEN k % 41 = 2 THEN 'u' || k || '@example.o-1rg'
       WHEN k % 43 = 1 THEN 'u' || k || '@example.com!!'
       ELSE 'u.' || k || '@example.org' END AS email,
  CASE WHEN k % 107 = 11 THEN NULL
       WHEN k % 89 = 5 THEN '2024-MAY-15'
       WHEN k % 83 = 3 THEN '2024-1-5'
       ELSE CAST(DATE '2023-01-01' + CAST(k % 700 AS INTEGER) AS VARCHAR) END AS signup_date,
  CASE k % 12
       WHEN 0 THEN a || '.' || b || '.' || c
       WHEN 1 THEN a || b || c
       WHEN 2 THEN a || '-' || b || '-' || c
       WHEN 3 THEN '(' || a || ')' || b || '-' || c
       WHEN 4 THEN '+1-' || a || '-' || b || '-' || c
       WHEN 5 THEN '+1-' || a || '-' || b || '-' || c || 'x' || x
       WHEN 6 THEN '001-' || a || '-' || b || '-' || c
       WHEN 7 THEN a || '.' || b || '.' || c || 'x' || x
       WHEN 8 THEN '(' || a || ')' || b || '-' || c || 'x45'
       WHEN 9 THEN '+(' || a || ')' || b || '-' || c
       WHEN 10 THEN b || '-' || c
       ELSE '001-' || a || '-' || b || '-' || c || 'x' || x || '7' END AS phone_number,
  CASE WHEN k % 109 = 19 THEN NULL
       WHEN k % 5 = 4 THEN 'null'
       WHEN c_mktsegment IN ('BUILDING', 'HOUSEHOLD') THEN '{home}'
       ELSE '{away}' END AS status
FROM (
  SELECT c_custkey AS k, c_name, c_mktsegment,
         CAST(200 + c_custkey % 700 AS VARCHAR) AS a,
         CAST(100 + (7 * c_custkey) % 900 AS VARCHAR) AS b,
         CAST(1000 + (13 * c_custkey) % 9000 AS VARCHAR) AS c,
         CAST(100 + (3 * c_custkey) % 900 AS VARCHAR) AS x
  FROM customer
)"""


# --- expressions --------------------------------------------------------------


def as_time(text: str) -> str:
    shape = r"'\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}Z'"
    return (
        f"CASE WHEN regexp_full_match({text}, {shape}) "
        f"THEN try_strptime({text}, '%Y-%m-%dT%H:%M:%SZ') END"
    )


def as_date(text: str) -> str:
    shape = r"'\d{4}-\d{2}-\d{2}'"
    return (
        f"CASE WHEN regexp_full_match({text}, {shape}) "
        f"THEN CAST(try_strptime({text}, '%Y-%m-%d') AS DATE) END"
    )


def hours(start: str, end: str) -> str:
    return f"(epoch({as_time(end)}) - epoch({as_time(start)})) / 3600.0::DOUBLE"


def before(text: str, mark: str) -> str:
    return f"str_split({text}, '{mark}')[1]"


def after_t(text: str) -> str:
    return f"str_split({text}, 'T')[2]"


TIME_PARTS = f"""
  {before("start_time", "T")} AS start_date,
  {before(after_t("start_time"), "Z")} AS starting_time,
  {before("end_time", "T")} AS end_date,
  {before(after_t("end_time"), "Z")} AS ending_time"""

TENURE = f"CAST(date_diff('day', signup, DATE '{AS_OF_DATE}') AS INTEGER)"

DIGITS = r"""array_to_string([substr(p, i, 1) for i in range(1, length(p) + 1)
    if regexp_matches(substr(p, i, 1), '\d') or (i > 1 and substr(p, i - 1, 1) = '+')], '')"""

PHONE = """CASE
    WHEN length(d) = 10
      THEN '(' || substr(d, 1, 3) || ') ' || substr(d, 4, 3) || '-' || substr(d, 7)
    WHEN length(d) = 11 AND d LIKE '1%'
      THEN '+1 (' || substr(d, 2, 3) || ') ' || substr(d, 5, 3) || '-' || substr(d, 8)
    WHEN length(d) > 11 AND d LIKE '1%'
      THEN '+1 (' || substr(d, 2, 3) || ') ' || substr(d, 5, 3) || '-' || substr(d, 8)
           || ' (Ext: ' || substr(d, 12) || ')'
    WHEN length(d) > 10
      THEN '+' || substr(d, 1, length(d) - 10) || ' (' || substr(d, length(d) - 9, 3) || ') '
           || substr(d, length(d) - 6, 3) || '-' || right(d, 4) || ' (Ext: ' || right(d, 3) || ')'
    ELSE p END"""

BOOKING_KEYS = "booking_id IS NOT NULL AND customer_id IS NOT NULL AND car_id IS NOT NULL AND booking_date IS NOT NULL"
BOOKING_DATES = (
    f"({as_time('start_time')}) IS NOT NULL AND ({as_time('end_time')}) IS NOT NULL "
    f"AND ({as_date('booking_date')}) IS NOT NULL"
)
BOOKING_STATUS = "status IN ('completed', 'cancelled', 'pending')"
CUSTOMER_KEYS = "customer_id IS NOT NULL AND name IS NOT NULL AND email IS NOT NULL"
CUSTOMER_STATUS = "status IN ('active', 'inactive')"
CUSTOMER_EMAIL = r"regexp_matches(email, '^[a-zA-Z0-9._]+@[a-z0-9._]+\.[a-z]{2,}')"
CUSTOMER_SIGNUP = f"({as_date('signup_date')}) IS NOT NULL"

# --- staged tables --------------------------------------------------------------


def reshaped_bookings(raw: str) -> str:
    return f"""
SELECT booking_id, customer_id, car_id, booking_date, status, total_amount, {TIME_PARTS},
  {hours("start_time", "end_time")} AS total_duration
FROM ({raw})
WHERE {BOOKING_KEYS} AND {BOOKING_DATES} AND {BOOKING_STATUS}"""


def staged_bookings(day=None) -> str:
    return reshaped_bookings(raw_bookings(day))


def staged_customers(day=None) -> str:
    return f"""
SELECT customer_id, name, email, signup AS signup_date, {PHONE} AS phone_number, status,
  {TENURE} AS tenure_in_days
FROM (
  SELECT *, phone_number AS p, {DIGITS.replace("p,", "phone_number,").replace("(p)", "(phone_number)")} AS d,
    {as_date("signup_date")} AS signup
  FROM ({raw_customers(day)})
  WHERE {CUSTOMER_KEYS} AND {CUSTOMER_STATUS} AND {CUSTOMER_EMAIL} AND {CUSTOMER_SIGNUP}
)"""


STAGED_RENTALS = reshaped_bookings(RAW_RENTALS)
STAGED_HOT_RENTALS = reshaped_bookings(HOT_RENTALS)

# --- funnel, checks, merge ------------------------------------------------------


def funnel(raw: str, stages: list[tuple[str, str]]) -> str:
    """One count per step, each with its own pass."""
    steps = [f"SELECT 0 AS step, 'raw' AS stage, count(*) AS rows FROM ({raw})"]
    for i in range(1, len(stages) + 1):
        passed = " AND ".join(f"({test})" for _, test in stages[:i])
        steps.append(
            f"SELECT {i} AS step, '{stages[i - 1][0]}' AS stage, count(*) AS rows "
            f"FROM ({raw}) WHERE {passed}"
        )
    return "\nUNION ALL\n".join(steps)


def size(test: str) -> tuple[str, str, str]:
    return "Size", "CAST(count(*) AS DOUBLE)", f"count(*) {test}"


def complete(column: str) -> tuple[str, str, str]:
    return _fraction(f"Completeness({column})", f"count({column})")


def non_negative(column: str) -> tuple[str, str, str]:
    return _fraction(
        f"NonNegative({column})", f"count(*) FILTER (WHERE coalesce({column}, 0) >= 0)"
    )


def _fraction(label, compliant):
    return label, f"CAST({compliant} AS DOUBLE) / count(*)", f"{compliant} = count(*) AND count(*) > 0"


def checked(table: str, *checks: tuple[str, str, list[tuple[str, str, str]]]) -> str:
    """Checks are (name, level, constraints)."""
    rows = "\nUNION ALL\n".join(
        f"SELECT '{name}' AS \"check\", '{level}' AS check_level, '{label}' AS \"constraint\", "
        f"{value} AS value, {holds} AS ok FROM staged"
        for name, level, constraints in checks
        for label, value, holds in constraints
    )
    return f"""
WITH staged AS MATERIALIZED ({table}), tested AS ({rows})
SELECT "check", check_level,
  CASE WHEN bool_and(ok) OVER (PARTITION BY "check") THEN 'Success' ELSE check_level END AS check_status,
  "constraint",
  CASE WHEN ok THEN 'Success' ELSE 'Failure' END AS constraint_status,
  CASE WHEN ok THEN '' ELSE 'Value: ' || CAST(value AS VARCHAR)
       || ' does not meet the constraint requirement!' END AS constraint_message
FROM tested"""


BOOKINGS_CHECK = (
    "Quality check on bookings",
    "Error",
    [
        size("> 0"),
        *[complete(c) for c in ("booking_id", "customer_id", "car_id", "booking_date", "status")],
        non_negative("total_amount"),
        *[complete(c) for c in ("start_date", "starting_time", "end_date", "ending_time")],
        non_negative("total_duration"),
    ],
)
CUSTOMERS_CHECK = (
    "Quality check on customers",
    "Error",
    [
        size("> 0"),
        *[
            complete(c)
            for c in ("customer_id", "name", "email", "signup_date", "phone_number", "status")
        ],
        non_negative("tenure_in_days"),
    ],
)

BOOKING_COLUMNS = [
    "booking_id", "customer_id", "car_id", "booking_date", "status", "total_amount",
    "start_date", "starting_time", "end_date", "ending_time", "total_duration",
]
CUSTOMER_COLUMNS = [
    "customer_id", "name", "email", "signup_date", "phone_number", "status", "tenure_in_days",
]


def merged(target: str, updates: str, columns: list[str], delete: str, decides="t") -> str:
    """Case by case: updated, kept, inserted; what is left out is deleted."""
    key = columns[0]
    updated = ", ".join(["t." + key, *(f"u.{c}" for c in columns[1:])])
    mine, new = (", ".join(f"{side}.{c}" for c in columns) for side in "tu")
    return f"""
WITH t AS MATERIALIZED ({target}), u AS MATERIALIZED ({updates})
SELECT {updated} FROM t JOIN u ON t.{key} = u.{key} WHERE {decides}.status <> '{delete}'
UNION ALL
SELECT {mine} FROM t JOIN u ON t.{key} = u.{key} WHERE {decides}.status IS NULL
UNION ALL
SELECT {mine} FROM t WHERE NOT EXISTS (SELECT 1 FROM u WHERE u.{key} = t.{key})
UNION ALL
SELECT {new} FROM u WHERE NOT EXISTS (SELECT 1 FROM t WHERE t.{key} = u.{key})"""


MERGED_BOOKINGS = merged(staged_bookings(1), staged_bookings(2), BOOKING_COLUMNS, "cancelled")
MERGED_CUSTOMERS = merged(staged_customers(1), staged_customers(2), CUSTOMER_COLUMNS, "inactive")


# --- mock feeds -------------------------------------------------------------------


def draw(seed: int, choices: int) -> str:
    return f"((((id % 2147483647) * 48271 + {seed * 69621}) % 2147483647) * 16807 % 2147483647 % {choices})"


def pick(seed: int, values: list[str]) -> str:
    cases = " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(values))
    return f"CASE {draw(seed, len(values))} {cases} END"


FIRST = ["Ada", "Ben", "Chloe", "Dev", "Elena", "Farid", "Grace", "Hugo"]
LAST = ["Abbott", "Brown", "Chen", "Diaz", "Evans", "Fischer", "Gupta"]

MOCK_BOOKINGS = f"""
SELECT printf('B%03d', id) AS booking_id, printf('C%03d', id) AS customer_id,
  'CARS' || (100 + {draw(1, 900)}) AS car_id,
  '2024-07-20' AS booking_date, '2024-07-21T10:00:00Z' AS start_time, '2024-07-21T18:00:00Z' AS end_time,
  {pick(2, ["completed", "pending", "canceled", "null"])} AS status,
  CAST({draw(3, 25001)} + 5000 AS DOUBLE) / 100.0::DOUBLE AS total_amount
FROM (SELECT o_orderkey AS id FROM orders)"""

MOCK_CUSTOMERS = f"""
SELECT customer_id, name, email, signup_date,
  CASE WHEN shape = 20 THEN a || b || c
       WHEN shape % 5 = 0 THEN '(' || a || ')' || b || '-' || c
       WHEN shape % 5 = 1 THEN a || '-' || b || '-' || c
       WHEN shape % 5 = 2 THEN a || '.' || b || '.' || c
       WHEN shape % 5 = 3 THEN '+1-' || a || '-' || b || '-' || c
       ELSE '001-' || a || '-' || b || '-' || c END
  || CASE WHEN shape < 5 OR shape = 20 THEN ''
          WHEN shape < 10 THEN 'x' || left(ext, 3)
          WHEN shape < 15 THEN 'x' || left(ext, 4)
          ELSE 'x' || ext END AS phone_number,
  status
FROM (
  SELECT printf('C%03d', id) AS customer_id,
    {pick(1, FIRST)} || ' ' || {pick(2, LAST)} AS name,
    lower({pick(1, FIRST)}) || '.' || id || '@' || {pick(3, ["example.com", "example.net", "example.org"])} AS email,
    '2024-01-15' AS signup_date,
    CAST(200 + {draw(5, 700)} AS VARCHAR) AS a,
    CAST(100 + {draw(6, 900)} AS VARCHAR) AS b,
    CAST(1000 + {draw(7, 9000)} AS VARCHAR) AS c,
    {draw(8, 21)} AS shape,
    printf('%05d', {draw(9, 100000)}) AS ext,
    {pick(4, ["active", "inactive", "null"])} AS status
  FROM (SELECT c_custkey AS id FROM customer)
)"""


# --- the queries --------------------------------------------------------------------


def where(raw: str, test: str) -> str:
    return f"SELECT * FROM ({raw}) WHERE {test}"


def renamed(rentals: str) -> str:
    return f"SELECT * REPLACE ('R' || booking_id AS booking_id) FROM ({rentals})"


BOOKING_STAGES = [("null_keys", BOOKING_KEYS), ("dates", BOOKING_DATES), ("status", BOOKING_STATUS)]
CUSTOMER_STAGES = [
    ("null_keys", CUSTOMER_KEYS),
    ("status", CUSTOMER_STATUS),
    ("email", CUSTOMER_EMAIL),
    ("signup_date", CUSTOMER_SIGNUP),
]

RAW_MERGE_COLUMNS = [*BOOKING_COLUMNS[:4], "start_time", "end_time", *BOOKING_COLUMNS[4:6]]


def numbered_orders(where: str, price: str) -> str:
    return f"SELECT CAST(o_orderkey AS INT) AS order_key, o_orderstatus AS status, {price} AS o_totalprice FROM orders WHERE {where}"


MERGED_ORDERS = merged(
    numbered_orders("o_orderkey % 3 <> 0", "o_totalprice"),
    numbered_orders("o_orderkey % 2 = 0", "0.0::DOUBLE"),
    ["order_key", "status", "o_totalprice"],
    "F",
)

ORACLE = {
    "bookings_drop_null_keys": where(raw_bookings(), BOOKING_KEYS),
    "bookings_valid_dates": where(raw_bookings(), BOOKING_DATES),
    "bookings_valid_status": where(raw_bookings(), BOOKING_STATUS),
    "customers_drop_null_keys": where(raw_customers(), CUSTOMER_KEYS),
    "customers_valid_status": where(raw_customers(), CUSTOMER_STATUS),
    "customers_valid_email": where(raw_customers(), CUSTOMER_EMAIL),
    "customers_valid_signup": where(raw_customers(), CUSTOMER_SIGNUP),
    "bookings_split_times": f"SELECT booking_id, start_time, end_time, {TIME_PARTS} FROM ({raw_bookings()})",
    "bookings_duration": f"""
SELECT booking_id, start_time, end_time, {hours("start_time", "end_time")} AS total_duration
FROM ({raw_bookings()})""",
    "bookings_duration_utc": f"""
SELECT booking_id, start_time, end_time, {hours("start_time", "end_time")} AS total_duration
FROM ({RAW_RENTALS})""",
    "customers_phone": f"""
SELECT customer_id, p AS phone_raw, {PHONE} AS phone_number
FROM (SELECT customer_id, p, {DIGITS} AS d
      FROM (SELECT customer_id, phone_number AS p FROM ({raw_customers()})))""",
    "customers_tenure": f"""
SELECT customer_id, signup AS signup_date, {TENURE} AS tenure_in_days
FROM (SELECT customer_id, {as_date("signup_date")} AS signup FROM ({raw_customers()}))""",
    "bookings_staged": staged_bookings(),
    "customers_staged": staged_customers(),
    "bookings_funnel": funnel(raw_bookings(), BOOKING_STAGES),
    "customers_funnel": funnel(raw_customers(), CUSTOMER_STAGES),
    "bookings_json_scan": raw_bookings(),
    "bookings_json_array_scan": raw_bookings(),
    "bookings_json_split_array_scan": raw_bookings(),
    "customers_json_scan": raw_customers(),
    "bookings_json_undeclared_keys": """
SELECT CAST(o_orderkey AS VARCHAR) AS booking_id, CAST(NULL AS VARCHAR) AS customer_id,
  CAST(NULL AS VARCHAR) AS car_id, CAST(NULL AS VARCHAR) AS booking_date,
  CAST(NULL AS VARCHAR) AS start_time, CAST(NULL AS VARCHAR) AS end_time,
  o_orderstatus AS status, CAST(NULL AS DOUBLE) AS total_amount
FROM orders""",
    "bookings_quality": checked(staged_bookings(), BOOKINGS_CHECK),
    "customers_quality": checked(staged_customers(), CUSTOMERS_CHECK),
    "bookings_quality_failing": checked(STAGED_RENTALS, BOOKINGS_CHECK),
    "bookings_quality_raw": checked(
        raw_bookings(),
        ("keys", "Error", [size("> 1000"), complete("booking_id"), complete("end_time")]),
        ("amounts", "Warning", [non_negative("total_amount")]),
    ),
    "quality_status": "\nUNION ALL\n".join(
        f"""
SELECT '{run}' AS run,
  CASE WHEN bool_or(check_status = 'Error') THEN 'Error'
       WHEN bool_or(check_status = 'Warning') THEN 'Warning' ELSE 'Success' END AS status
FROM ({checked(table, check)})"""
        for run, table, check in (
            ("bookings", staged_bookings(), BOOKINGS_CHECK),
            ("customers", staged_customers(), CUSTOMERS_CHECK),
            ("rentals", STAGED_RENTALS, BOOKINGS_CHECK),
        )
    ),
    "bookings_merge": MERGED_BOOKINGS,
    "customers_merge": MERGED_CUSTOMERS,
    "bookings_merge_broadcast": MERGED_BOOKINGS,
    "customers_merge_broadcast": MERGED_CUSTOMERS,
    "bookings_merge_shuffle": MERGED_BOOKINGS,
    "customers_merge_shuffle": MERGED_CUSTOMERS,
    "bookings_merge_delete_on_incoming": merged(
        staged_bookings(1), staged_bookings(2), BOOKING_COLUMNS, "cancelled", decides="u"
    ),
    "bookings_merge_null_status": merged(
        raw_bookings(1), raw_bookings(2), RAW_MERGE_COLUMNS, "cancelled"
    ),
    "merge_number_keys": MERGED_ORDERS,
    "merge_number_keys_shuffle": MERGED_ORDERS,
    "bookings_merge_repeated_inserts": merged(
        staged_bookings(), renamed(STAGED_RENTALS), BOOKING_COLUMNS, "cancelled"
    ),
    "bookings_merge_hot_inserts": merged(
        staged_bookings(), renamed(STAGED_HOT_RENTALS), BOOKING_COLUMNS, "cancelled"
    ),
    "bookings_merge_hot_target": merged(
        STAGED_HOT_RENTALS, staged_bookings(), BOOKING_COLUMNS, "cancelled"
    ),
    "merge_ambiguous_keys": f"""
SELECT booking_id, count(*) AS copies FROM ({STAGED_RENTALS})
WHERE booking_id IN (SELECT booking_id FROM ({staged_bookings()}) WHERE status IS NOT NULL)
GROUP BY booking_id HAVING count(*) > 1""",
    "bookings_first_load": staged_bookings(),
    "customers_first_load": staged_customers(),
    "run_day_counts": f"""
SELECT 'bookings' AS target, count(*) AS rows FROM ({MERGED_BOOKINGS})
UNION ALL
SELECT 'customers' AS target, count(*) AS rows FROM ({MERGED_CUSTOMERS})""",
    "run_day_bookings": MERGED_BOOKINGS,
    "run_day_bookings_in_parts": MERGED_BOOKINGS,
    "run_day_bookings_in_buckets": MERGED_BOOKINGS,
    "run_day_customers_retried": MERGED_CUSTOMERS,
    "bookings_merge_filtered": MERGED_BOOKINGS,
    "run_day_customers": MERGED_CUSTOMERS,
    "mock_bookings": MOCK_BOOKINGS,
    "mock_customers": MOCK_CUSTOMERS,
    "preview_sizes": """
SELECT 'bookings' AS preview, least(5, count(*)) AS rows FROM orders
UNION ALL
SELECT 'customers' AS preview, least(5, count(*)) AS rows FROM customer
UNION ALL
SELECT 'staged customers' AS preview, least(10, count(*)) AS rows FROM (""" + staged_customers() + ")",
}
