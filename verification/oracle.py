"""The registered queries in DuckDB SQL, written apart from the library.

Each statement starts with common table expressions that derive the raw, staging and mart tables
from the provided ones; only the drawing of attributes, which is test data and not a result, is
built from the same pools and numbers.
"""

from __future__ import annotations

from itertools import accumulate

from martwright import domain
from martwright.sources import synthetic as s
from verification import tables as t
from verification.queries import BUYERS_FROM, BUYERS_TO, HISTORY_END, SHORT_ROLES, SINCE_END, order_lines

D = "CAST({} AS DOUBLE)".format
I = "CAST({} AS BIGINT)".format  # noqa: E741
S = "CAST({} AS VARCHAR)".format


# Drawing the raw tables.


def _draw(number: str, attribute: str, size: int) -> str:
    return f"(CAST('0x' || substr(md5({number} || '/{attribute}'), 1, 8) AS BIGINT) % {size})"


def _texts(values) -> str:
    return "[" + ", ".join("'" + v + "'" for v in values) + "]"


def _pick(values, number: str, stream: str) -> str:
    return f"{_texts(values)}[{_draw(number, stream, len(values))} + 1]"


def _weighted(values, weights, number: str, stream: str) -> str:
    shown = ["'" + v + "'" if isinstance(v, str) else v for v in values]
    drawn = _draw(number, stream, 100)
    cases = [f"WHEN {drawn} < {end} THEN {v}" for v, end in zip(shown, accumulate(weights))]
    return "CASE " + " ".join(cases) + " END"


def _region(number: str) -> str:
    return f"CASE WHEN {_draw(number, 'region', 100)} < 55 THEN 'UK' ELSE 'EU' END"


def _either(uk: str, eu: str) -> str:
    return f"CASE WHEN region = 'UK' THEN {uk} ELSE {eu} END"


def _customers(source: str, number: str, country: str) -> str:
    first = _either(_pick(s.UK_FIRST, "n", "first"), _pick(s.EU_FIRST, "n", "first"))
    last = _either(_pick(s.UK_LAST, "n", "last"), _pick(s.EU_LAST, "n", "last"))
    mail = _either(_pick(s.UK_MAIL, "n", "mail"), _pick(s.EU_MAIL, "n", "mail"))
    drawn_country = _either(
        *(_weighted(*zip(*c), "n", "country") for c in (s.UK_COUNTRIES, s.EU_COUNTRIES))
    )
    a, b = f"({_draw('n', 'phone_a', 900)} + 100)", f"({_draw('n', 'phone_b', 900)} + 100)"
    c, prefix = f"({_draw('n', 'phone_c', 9000)} + 1000)", f"({_draw('n', 'prefix', 19)} + 31)"
    digits = f"{a} || ' ' || {b} || ' ' || {c}"
    phone = _either(f"'+44 7' || {digits}", f"'+' || {prefix} || ' ' || {digits}")
    born = (
        f"make_date({_draw('n', 'birth_year', 56)} + 1950, {_draw('n', 'birth_month', 12)} + 1,"
        f" {_draw('n', 'birth_day', 28)} + 1)"
    )
    joined = f"CAST(DATE '2022-01-01' + CAST({_draw('n', 'joined', 801)} AS INTEGER) AS TIMESTAMP)"
    return f"""
    SELECT n, printf('CUST-%05d', n) AS customer_id,
      first_name || ' ' || last_name AS customer_full_name,
      replace(lower(first_name) || '.' || translate(lower(last_name), 'üöéø', 'uoeo')
        || '_' || n || '@' || mail, ' ', '.') AS customer_email,
      customer_phone, country, region, gender, date_of_birth, created_at, created_at AS updated_at
    FROM (SELECT n, region, {first} AS first_name, {last} AS last_name, {mail} AS mail,
            {phone} AS customer_phone, {country or drawn_country} AS country,
            {_pick(domain.GENDERS, 'n', 'gender')} AS gender, {born} AS date_of_birth,
            {joined} AS created_at
          FROM (SELECT *, {number} AS n, {_region(number)} AS region FROM {source}))"""


def _orders(source: str, number: str, customer: str, day: str, pence: str = "", status: str = "") -> str:
    pence = pence or f"((125 + product * 397 % 1171) * ({_draw('n', 'price', 301)} + 900) + 500) // 1000"
    status = status or _weighted(domain.ORDER_STATUSES, domain.ORDER_STATUS_WEIGHTS, "n", "status")
    category = f"{_texts(domain.PRODUCT_CATEGORIES)}[product // 6 + 1]"
    return f"""
    SELECT n, printf('ORD-%05d', n) AS order_id, printf('CUST-%05d', buyer) AS customer_id,
      order_date,
      {status} AS order_status,
      {_pick(domain.PAYMENT_METHODS, 'n', 'payment')} AS payment_method,
      {category} AS product_category,
      upper({category}) || ', ITEM ' || (product % 6 + 1) AS product_description,
      {_weighted(domain.QUANTITIES, domain.QUANTITY_WEIGHTS, 'n', 'quantity')} AS quantity,
      CAST(CAST({pence} AS DECIMAL(10,0)) * 0.01 AS DECIMAL(10,2)) AS unit_price,
      {_region('buyer')} AS region, CAST(order_date AS TIMESTAMP) AS created_at
    FROM (SELECT *, {number} AS n, {customer} AS buyer, {day} AS order_date,
            {_draw(number, 'product', 48)} AS product FROM {source})"""


CUSTOMER_COLUMNS = (
    "customer_id customer_full_name customer_email customer_phone country region gender "
    "date_of_birth created_at updated_at"
).split()
ORDER_COLUMNS = (
    "order_id customer_id order_date order_status payment_method product_category "
    "product_description quantity unit_price region created_at"
).split()


def _spoilt(source: str, columns: list[str], defects: dict, cycle: int) -> str:
    values = ", ".join(
        f"{t.defect_sql(c, defects, 'n', cycle)} AS {c}" if c in defects else c for c in columns
    )
    return f"""
    SELECT {values} FROM {source}
    UNION ALL
    SELECT * REPLACE (created_at + INTERVAL 1 DAY AS created_at)
    FROM (SELECT {values} FROM {source} WHERE n % {cycle} = {t.DUPLICATE_REMAINDER})"""


_SPLIT = r"[\p{L}\p{N}]+|[^\p{L}\p{N}]+"


def _title(c: str) -> str:
    words = f"regexp_extract_all(lower(trim({c})), '{_SPLIT}')"
    capital = "lambda w: upper(substr(w, 1, 1)) || substr(w, 2)"
    return f"array_to_string(list_transform({words}, {capital}), '')"


def _completed(birth: str, day: str) -> str:
    return (
        f"(year({day}) - year({birth})"
        f" - CASE WHEN strftime({day}, '%m%d') < strftime({birth}, '%m%d') THEN 1 ELSE 0 END)"
    )


_FITS = "(CAST(quantity AS BIGINT) * CAST(unit_price * 100 AS BIGINT) * 120 + 50) // 100 < 1000000000000"
TODAY = f"DATE '{t.AS_OF}'"


def _firsts(rows: str, key: str) -> str:
    """The first row of each key, as a load of raw rows keeps it."""
    return f"""SELECT * EXCLUDE (r) FROM (SELECT *, row_number() OVER
      (PARTITION BY {key} ORDER BY created_at NULLS LAST) AS r FROM ({rows}) WHERE {key} IS NOT NULL) WHERE r = 1"""


def _with(dirty: bool, loaded: bool = False) -> str:
    """The raw, staging and mart tables as common table expressions."""
    customers = _customers(
        "customer JOIN nation ON c_nationkey = n_nationkey", "c_custkey", "n_name"
    )
    orders = _orders(
        "orders", "o_orderkey", "o_custkey", "CAST(o_orderdate AS DATE)",
        "CAST(floor(o_totalprice / 10) AS BIGINT)",
        "CASE o_orderstatus WHEN 'F' THEN 'Delivered' WHEN 'O' THEN 'Pending'"
        " WHEN 'P' THEN 'Shipped' ELSE o_orderstatus END",
    )
    if dirty:
        customer_rows = _spoilt("c0", CUSTOMER_COLUMNS, t.CUSTOMER_DEFECTS, t.CUSTOMER_CYCLE)
        order_rows = _spoilt("o0", ORDER_COLUMNS, t.ORDER_DEFECTS, t.ORDER_CYCLE)
    else:
        customer_rows, order_rows = "SELECT * EXCLUDE (n) FROM c0", "SELECT * EXCLUDE (n) FROM o0"
    if loaded:
        customer_rows, order_rows = _firsts(customer_rows, "customer_id"), _firsts(order_rows, "order_id")
    return f"""WITH c0 AS ({customers}),
o0 AS ({orders}),
raw_customers AS ({customer_rows}),
raw_orders AS ({order_rows}),
stg_customers AS (
  SELECT customer_id, customer_full_name,
    sha256(customer_email) AS customer_email_hash, customer_email AS customer_email_raw,
    sha256(customer_phone) AS customer_phone_hash, customer_phone AS customer_phone_raw,
    upper(trim(country)) AS country, upper(trim(region)) AS region, gender,
    {_completed('date_of_birth', TODAY)} AS customer_age, date_of_birth, created_at, updated_at
  FROM raw_customers),
stg_orders AS (
  SELECT order_id, customer_id, order_date, {_title('order_status')} AS order_status,
    {_title('payment_method')} AS payment_method, product_category, product_description,
    quantity, unit_price,
    (pence * 20 + 50) // 100 AS tax_pence, (pence * 120 + 50) // 100 AS total_pence, pence,
    upper(trim(region)) AS region, created_at
  FROM (SELECT *, CAST(quantity * CAST(unit_price * 100 AS BIGINT) AS BIGINT) AS pence
        FROM raw_orders)
  WHERE quantity > 0 AND unit_price >= 0 AND order_date IS NOT NULL AND {_FITS}),
dim_customers AS (
  SELECT md5(customer_id) AS customer_key, customer_id, customer_full_name,
    customer_email_raw AS customer_email, customer_phone_raw AS customer_phone, country, region,
    gender, customer_age, date_of_birth, CAST(created_at AS DATE) AS customer_since, updated_at
  FROM stg_customers WHERE customer_id IS NOT NULL),
fct_orders AS (
  SELECT md5(coalesce(order_id, '{domain.NULL_KEY_TOKEN}')) AS order_key, o.*,
    o.region AS order_region, d.customer_key
  FROM stg_orders o JOIN dim_customers d ON o.customer_id = d.customer_id)
"""


CLEAN, DIRTY, LOADED = _with(False), _with(True), _with(True, loaded=True)
_FACT_PENCE = t.defect_sql("total_pence", {
    "total_pence": [(1, "total_pence + 3"), (2, "total_pence + 2"), (4, "NULL")]
}, "coalesce(CAST(substr(order_id, 5) AS BIGINT), 0)", t.ORDER_CYCLE)
SPOILT = ", spoilt AS (SELECT * REPLACE (" + _FACT_PENCE + " AS total_pence) FROM fct_orders)\n"


def _mean(pence: str, count: str) -> str:
    """Pounds from a sum of pence and a count, rounded half up."""
    return D(f"((2 * {pence} + {count}) // (2 * {count}))") + " / 100"


def _share(part: str, whole: str) -> str:
    return D(f"((2000 * {part} + {whole}) // (2 * {whole}))") + " / 10"


def _pounds(pence: str) -> str:
    return D(I(pence)) + " / 100"


ORACLE: dict[str, str] = {}

_CUSTOMER_OUT = f"""customer_id, customer_full_name, customer_email, customer_phone, country, region,
  gender, {S('date_of_birth')} AS date_of_birth, {S('created_at')} AS created_at,
  {S('updated_at')} AS updated_at"""
_ORDER_OUT = f"""order_id, customer_id, {S('order_date')} AS order_date, order_status, payment_method,
  product_category, product_description, {D('quantity')} AS quantity,
  {D('unit_price')} AS unit_price, region, {S('created_at')} AS created_at"""

# Sources, sinks and loading.

ORACLE["raw_customers"] = f"{CLEAN} SELECT {_CUSTOMER_OUT} FROM raw_customers"
ORACLE["raw_orders"] = f"{CLEAN} SELECT {_ORDER_OUT} FROM raw_orders"
ORACLE["projected_scan"] = "SELECT o_orderkey, o_orderstatus FROM orders"


def _blank_as_null(output: str, *columns: str) -> str:
    for c in columns:
        output = output.replace(f" {c},", f" nullif({c}, '') AS {c},")
    return output


_SEED = _blank_as_null(_CUSTOMER_OUT, "customer_email", "country")
ORACLE["seed_customers"] = f"{DIRTY} SELECT {_SEED} FROM raw_customers"
_SEED = _blank_as_null(_ORDER_OUT.replace("\n", " "), "product_description")
ORACLE["seed_orders"] = f"{DIRTY} SELECT {_SEED} FROM raw_orders"
ORACLE["full_refresh"] = f"""{CLEAN} SELECT order_id, {_pounds('total_pence')} AS total_amount,
  order_region FROM fct_orders WHERE order_region = 'UK'"""

_FIRST_ORDERS = """SELECT * EXCLUDE (r) FROM (SELECT *, row_number() OVER
  (PARTITION BY order_id ORDER BY created_at) AS r FROM raw_orders WHERE order_id IS NOT NULL)
  WHERE r = 1"""
ORACLE["first_row_per_key"] = f"{DIRTY} SELECT {_ORDER_OUT} FROM ({_FIRST_ORDERS})"
ORACLE["insert_raw_orders"] = f"""{DIRTY} SELECT {_ORDER_OUT} FROM ({_FIRST_ORDERS}) b
  WHERE order_id NOT IN (SELECT order_id FROM o0 WHERE created_at < TIMESTAMP '{HISTORY_END}')"""
_OLD = f"(SELECT {', '.join(CUSTOMER_COLUMNS)} FROM c0 WHERE created_at < TIMESTAMP '{SINCE_END}')"
ORACLE["insert_raw_customers"] = f"""{DIRTY}, old AS {_OLD}
  SELECT {_CUSTOMER_OUT} FROM (
    SELECT * FROM old UNION ALL
    SELECT * EXCLUDE (r) FROM (
      SELECT {', '.join(CUSTOMER_COLUMNS)},
        row_number() OVER (PARTITION BY customer_id ORDER BY created_at NULLS LAST) AS r
      FROM raw_customers
      WHERE customer_id IS NOT NULL AND customer_id NOT IN (SELECT customer_id FROM old))
    WHERE r = 1)"""
_DIM_OUT = f"""customer_key, customer_id, customer_full_name, customer_email, customer_phone,
  country, region, gender, {D('customer_age')} AS customer_age,
  {S('customer_since')} AS customer_since"""
ORACLE["insert_dim_customers"] = f"""{DIRTY}, old AS (
    SELECT md5(customer_id) AS customer_key, customer_id, customer_full_name, customer_email,
      customer_phone, upper(trim(country)) AS country, region, gender,
      {_completed('date_of_birth', TODAY)} AS customer_age, CAST(created_at AS DATE) AS customer_since
    FROM c0 WHERE created_at < TIMESTAMP '{SINCE_END}')
  SELECT {_DIM_OUT} FROM (
    SELECT * FROM old UNION ALL
    SELECT * EXCLUDE (r) FROM (
      SELECT * EXCLUDE (date_of_birth, updated_at),
        row_number() OVER (PARTITION BY customer_id ORDER BY customer_since NULLS LAST) AS r
      FROM dim_customers WHERE customer_id NOT IN (SELECT customer_id FROM old))
    WHERE r = 1)"""
_LINE = """order_id || ',' || customer_id || ',' || order_date || ',' || order_status || ',' || payment_method || ',' ||
  product_category || ',"' || product_description || '",' || quantity || ',' || unit_price || ',' || region || ',' || order_date || 'T00:00:00.000Z'"""
_SEEDED = f"""{CLEAN}, seeded AS (SELECT *, {order_lines('', 'n')} AS given FROM (
    SELECT *, CAST(order_date AS VARCHAR) AS order_day, CAST(quantity AS VARCHAR) AS items, {_LINE} AS line FROM o0))"""
ORACLE["quarantined_orders"] = f"""{_SEEDED} SELECT 'raw_orders' AS seed, given AS line, CASE n % 97
  WHEN 1 THEN 'not of its type: order_date' WHEN 2 THEN '12 values instead of 11'
  WHEN 3 THEN '1 values instead of 11' ELSE 'not of its type: quantity' END AS reason
  FROM seeded WHERE n % 97 BETWEEN 1 AND 4"""
ORACLE["parsed_orders"] = f"{_SEEDED} SELECT {_ORDER_OUT} FROM seeded WHERE n % 97 NOT BETWEEN 1 AND 4"
ORACLE["default_timestamps"] = f"""{DIRTY} SELECT customer_id, {D('1')} AS filled,
  CASE WHEN created_at IS NOT NULL THEN {D('1')} END AS kept FROM raw_customers"""
ORACLE["synthetic_customers"] = (
    f"WITH g AS ({_customers('customer', 'c_custkey', '')}) SELECT {_CUSTOMER_OUT} FROM g"
)
_DAY = f"DATE '2022-01-01' + CAST({_draw('o_orderkey', 'day', 1001)} AS INTEGER)"
_BUYER = f"({_draw('o_orderkey', 'buyer', 1000)} + 1)"
ORACLE["synthetic_orders"] = (
    f"WITH g AS ({_orders('orders', 'o_orderkey', _BUYER, _DAY)}) SELECT {_ORDER_OUT} FROM g"
)

# Staging and scalars.

ORACLE["stg_customers"] = f"""{DIRTY} SELECT customer_id, customer_full_name, customer_email_hash,
  customer_email_raw, customer_phone_hash, customer_phone_raw, country, region, gender,
  {D('customer_age')} AS customer_age, {S('date_of_birth')} AS date_of_birth,
  {S('created_at')} AS created_at, {S('updated_at')} AS updated_at FROM stg_customers"""
ORACLE["stg_customers_calendar_age"] = f"""{DIRTY} SELECT customer_id,
  {D(f"date_diff('year', date_of_birth, {TODAY})")} AS customer_age,
  sha256('pepper' || customer_email) AS customer_email_hash,
  sha256('pepper' || customer_phone) AS customer_phone_hash FROM raw_customers"""
_STG_ORDER_OUT = f"""order_id, customer_id, {S('order_date')} AS order_date, order_status,
  payment_method, product_category, product_description, {D('quantity')} AS quantity,
  {D('unit_price')} AS unit_price, {_pounds('pence')} AS gross_amount,
  {_pounds('tax_pence')} AS tax_amount, {_pounds('total_pence')} AS total_amount,
  {S('created_at')} AS created_at"""
ORACLE["stg_orders"] = f"{DIRTY} SELECT {_STG_ORDER_OUT}, region FROM stg_orders"
ORACLE["stg_orders_upper_status"] = f"""{DIRTY} SELECT order_id,
  upper(trim(order_status)) AS order_status, {_title('payment_method')} AS payment_method,
  upper(trim(region)) AS region FROM raw_orders
  WHERE quantity > 0 AND unit_price >= 0 AND order_date IS NOT NULL AND {_FITS}"""
_REJECTED = f"""SELECT *, CASE WHEN quantity IS NULL OR quantity <= 0 THEN 'quantity'
      WHEN unit_price IS NULL OR unit_price < 0 THEN 'unit_price'
      WHEN order_date IS NULL THEN 'order_date'
      WHEN NOT {_FITS} THEN 'amount' END AS reject_reason FROM raw_orders"""
ORACLE["rejected_rows"] = f"""{DIRTY} SELECT order_id, {D('quantity')} AS quantity,
  {D('unit_price')} AS unit_price, {S('order_date')} AS order_date, reject_reason FROM ({_REJECTED})
  WHERE reject_reason IS NOT NULL"""
ORACLE["rejected_ids"] = f"""{LOADED} SELECT order_id, reject_reason FROM ({_REJECTED})
  WHERE reject_reason IS NOT NULL AND customer_id IN (SELECT customer_id FROM dim_customers)"""
ORACLE["order_amounts"] = f"""{CLEAN} SELECT order_id, {_pounds('pence')} AS gross_amount,
  {_pounds('tax_pence')} AS tax_amount, {_pounds('total_pence')} AS total_amount FROM stg_orders"""
_LEAP = "DATE '2021-02-28'"
ORACLE["customer_ages"] = f"""{DIRTY} SELECT customer_id, {S('date_of_birth')} AS date_of_birth,
  {D(_completed('date_of_birth', TODAY))} AS completed_2025,
  {D(f"date_diff('year', date_of_birth, {TODAY})")} AS calendar_2025,
  {D(_completed('date_of_birth', _LEAP))} AS completed_2021,
  {D(f"date_diff('year', date_of_birth, {_LEAP})")} AS calendar_2021
  FROM raw_customers WHERE date_of_birth IS NOT NULL"""
ORACLE["email_addresses"] = """SELECT c_custkey, lower(c_mktsegment) || '.sorby.oz.' ||
  replace(lower(c_name), ' ', '.') || '_' || c_custkey || '@example.com' AS email FROM customer"""
ORACLE["missing_labels"] = f"""{DIRTY} SELECT region, coalesce(region, 'Unknown') AS region_filled,
  'Unknown' AS loyalty_tier, count(*) AS customers FROM raw_customers GROUP BY 1, 2, 3"""

# Keys, hashes and masks.

ORACLE["pii_hashes"] = f"""{DIRTY} SELECT customer_id, sha256(customer_email) AS email_hash,
  sha256('pepper' || customer_email) AS salted_hash FROM raw_customers"""
_NONE = f"'{domain.NULL_KEY_TOKEN}'"
ORACLE["hash_keys"] = f"""{DIRTY} SELECT order_id, md5(coalesce(order_id, {_NONE})) AS order_key,
  md5(coalesce(order_id, {_NONE}) || '-' || coalesce(customer_id, {_NONE})) AS pair_key
  FROM raw_orders"""
ORACLE["sequence_keys_customers"] = f"""{CLEAN} SELECT
  {I('row_number() OVER (ORDER BY customer_id)')} AS customer_key, customer_id, region
  FROM dim_customers"""
ORACLE["sequence_keys_orders"] = f"""{CLEAN} SELECT
  {I('row_number() OVER (ORDER BY order_id)')} AS order_key, order_id, {D('quantity')} AS quantity
  FROM raw_orders"""


def _email(c: str) -> str:
    whole = rf"regexp_matches({c}, '(?s)\A[a-zA-Z0-9].*@[^@\s]+\z')"
    shown = f"substr({c}, 1, 1) || '***@' || list_last(string_split({c}, '@'))"
    return f"CASE WHEN {whole} THEN {shown} WHEN {c} IS NOT NULL THEN '***' END"


def _phone(c: str) -> str:
    pattern = r"'\A\s*(\+\d{1,3})\s+\d{3,}\s+\d{3,}\s+(\d{4})\s*\z'"
    shown = f"regexp_extract({c}, {pattern}, 1) || ' *** *** ' || right(trim({c}), 4)"
    return f"CASE WHEN regexp_matches({c}, {pattern}) THEN {shown} WHEN {c} IS NOT NULL THEN '***' END"


def _name(c: str) -> str:
    return (
        rf"CASE WHEN regexp_matches({c}, '\A\p{{L}}') THEN substr({c}, 1, 1) || '***'"
        f" WHEN {c} IS NOT NULL THEN '***' END"
    )


def _loose(c: str, pattern: str, replacement: str) -> str:
    return f"regexp_replace({c}, '{pattern}', '{replacement}')"


_LOOSE = {
    "customer_email": _loose("customer_email", domain.EMAIL_PATTERN, r"\1***\2"),
    "customer_phone": _loose("customer_phone", domain.PHONE_PATTERN, r"\1 *** *** \2"),
    "customer_full_name": _loose("customer_full_name", domain.NAME_PATTERN, r"\1***"),
}
_STRICT = {
    "customer_email": _email("customer_email"),
    "customer_phone": _phone("customer_phone"),
    "customer_full_name": _name("customer_full_name"),
}
for _query, _column in (
    ("mask_emails", "customer_email"),
    ("mask_phones", "customer_phone"),
    ("mask_full_names", "customer_full_name"),
):
    ORACLE[_query] = f"""{DIRTY} SELECT customer_id, {_STRICT[_column]} AS strict_mask,
  {_LOOSE[_column]} AS loose_mask FROM raw_customers"""

# Access by role.

_FCT_OUT = f"order_key, customer_key, {_STG_ORDER_OUT}, order_region"
ORACLE["insert_fct_orders"] = f"""{DIRTY} SELECT {_FCT_OUT} FROM (
    SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY order_date, created_at) AS r
    FROM fct_orders WHERE order_id IS NOT NULL
      AND order_id NOT IN (SELECT order_id FROM o0 WHERE order_date < DATE '{HISTORY_END}'))
  WHERE r = 1"""
ORACLE["insert_late_orders"] = f"{CLEAN} SELECT {_FCT_OUT} FROM fct_orders"
ORACLE["insert_sequence_keys"] = f"""{CLEAN}, first AS (
    SELECT customer_id, row_number() OVER (ORDER BY customer_id) AS k FROM raw_customers
    WHERE created_at < TIMESTAMP '{SINCE_END}'),
  later AS (
    SELECT customer_id, (SELECT count(*) FROM first) + row_number() OVER (ORDER BY customer_id) AS k
    FROM raw_customers WHERE created_at >= TIMESTAMP '{SINCE_END}')
  SELECT {I('k')} AS customer_key, customer_id, total_orders FROM
    (SELECT * FROM first UNION ALL SELECT * FROM later) LEFT JOIN
    (SELECT customer_id, count(*) AS total_orders FROM stg_orders GROUP BY 1) USING (customer_id)
  WHERE total_orders IS NOT NULL"""
ORACLE["interrupted_refresh"] = ORACLE["insert_late_orders"]
_VISIBLE = dict(zip(SHORT_ROLES, ("TRUE", "{} = 'UK'", "{} = 'EU'", "FALSE")))


def _dim_as(short: str, masks: dict[str, str]) -> str:
    out = _DIM_OUT
    for column, mask in masks.items():
        shown = {"engineer": column, "other_role": "'***'"}.get(short, mask)
        out = out.replace(f" {column},", f" {shown} AS {column},")
    return f"{DIRTY} SELECT {out} FROM dim_customers WHERE {_VISIBLE[short].format('region')}"


for _short in SHORT_ROLES:
    ORACLE[f"dim_customers_as_{_short}"] = _dim_as(_short, _STRICT)
    ORACLE[f"fct_orders_as_{_short}"] = f"""{DIRTY} SELECT {_FCT_OUT} FROM fct_orders
  WHERE {_VISIBLE[_short].format('order_region')}"""
ORACLE["dim_customers_loose_masks"] = _dim_as("uk_analyst", _LOOSE)
ORACLE["dim_customers_by_function"] = DIRTY + " UNION ALL ".join(
    _dim_as(short, masks).replace(f"{DIRTY} SELECT ", f"SELECT '{short}' AS role, {strict} AS strict, ")
    for short in SHORT_ROLES
    for strict, masks in (("TRUE", _STRICT), ("FALSE", _LOOSE))
)


def _policy_report(table: str, region: str) -> str:
    """What each role can select, region by region; a role that can select nothing gets a 0."""
    parts = []
    for short, role in SHORT_ROLES.items():
        allowed = f"FROM {table} WHERE {_VISIBLE[short].format(region)}"
        parts.append(
            f"""SELECT '{table}' AS table_name, '{role}' AS role, {region} AS region,
    count(*) AS visible_rows {allowed} GROUP BY {region}"""
        )
        parts.append(
            f"SELECT '{table}', '{role}', NULL, 0 WHERE NOT EXISTS (SELECT 1 {allowed})"
        )
    return DIRTY + " UNION ALL ".join(parts)


ORACLE["policy_report_customers"] = _policy_report("dim_customers", "region")
ORACLE["policy_report_orders"] = _policy_report("fct_orders", "order_region")


def _samples() -> str:
    parts = []
    for short, role in SHORT_ROLES.items():
        shown = [
            f"{ {'engineer': c}.get(short, _STRICT[c]) } AS {c}" for c in _STRICT
        ]
        parts.append(
            f"""(SELECT '{role}' AS role, customer_id, {', '.join(shown)} FROM dim_customers
    WHERE {_VISIBLE[short].format('region')} ORDER BY customer_id LIMIT 5)"""
        )
    return CLEAN + " UNION ALL ".join(parts)


ORACLE["masked_samples"] = _samples()


def _by_region(where: str) -> str:
    return f"""{CLEAN} SELECT order_region, count(*) AS total_orders,
  {I('sum(quantity)')} AS total_items_sold, {_pounds('sum(pence)')} AS gross_revenue,
  {_pounds('sum(tax_pence)')} AS tax_collected, {_pounds('sum(total_pence)')} AS total_revenue,
  {_mean('sum(total_pence)', 'count(*)')} AS avg_order_value
  FROM fct_orders WHERE {where} GROUP BY order_region"""


def _top_customers(where: str) -> str:
    return f"""{CLEAN} SELECT d.customer_id, d.customer_full_name, d.country, d.region,
  {D('d.customer_age')} AS customer_age, count(*) AS total_orders,
  {_pounds('sum(total_pence)')} AS total_spend,
  {_mean('sum(total_pence)', 'count(*)')} AS avg_order_value,
  {S('max(order_date)')} AS last_order_date
  FROM dim_customers d JOIN fct_orders f ON d.customer_key = f.customer_key WHERE {where}
  GROUP BY 1, 2, 3, 4, 5 ORDER BY sum(total_pence) DESC, d.customer_id LIMIT 10"""


ORACLE["uk_analyst_revenue"] = _by_region("order_region = 'UK'")
_INITIAL = "substr(d.customer_full_name, 1, 1) || '***' AS customer_full_name"
ORACLE["eu_analyst_top_customers"] = _top_customers(
    "d.region = 'EU' AND f.order_region = 'EU'"
).replace("d.customer_full_name, d.country", f"{_INITIAL}, d.country")
ORACLE["sql_over_secured_views"] = f"""{CLEAN} SELECT d.country, count(*) AS orders,
  {_pounds('sum(total_pence)')} AS spend
  FROM dim_customers d JOIN fct_orders f ON d.customer_key = f.customer_key
  WHERE d.region = 'EU' AND f.order_region = 'EU' GROUP BY d.country"""

ORACLE["sql_over_functions"] = ORACLE["sql_over_secured_views"].replace("AS spend", "AS spend, 'x***@z.example' AS shown, FALSE AS uk")
ORACLE["older_versions"] = f"""{CLEAN} SELECT version, order_region, count(*) AS total_orders, {_pounds('sum(total_pence)')} AS total_revenue
  FROM fct_orders JOIN (SELECT 'second' AS version, customer_id FROM raw_customers UNION ALL
    SELECT 'first', customer_id FROM raw_customers WHERE created_at < TIMESTAMP '{SINCE_END}') USING (customer_id)
  GROUP BY version, order_region"""

# Marts and joins.

ORACLE["dim_customers"] = f"""{DIRTY} SELECT {_DIM_OUT}, {S('date_of_birth')} AS date_of_birth,
  {S('updated_at')} AS updated_at FROM dim_customers"""
ORACLE["fct_orders"] = f"{DIRTY} SELECT {_FCT_OUT} FROM fct_orders"
ORACLE["split_fct_orders"] = ORACLE["fct_orders"]
ORACLE["orphan_raw_orders"] = f"""{DIRTY} SELECT order_id, customer_id, {S('order_date')} AS order_date
  FROM raw_orders o WHERE NOT EXISTS
    (SELECT 1 FROM raw_customers c WHERE c.customer_id = o.customer_id)"""
ORACLE["orphan_customer_ids"] = f"""{DIRTY} SELECT customer_id, count(*) AS rows FROM raw_orders o
  WHERE NOT EXISTS (SELECT 1 FROM raw_customers c WHERE c.customer_id = o.customer_id)
  GROUP BY customer_id"""

# Reports over the marts.

ORACLE["revenue_by_region"] = _by_region("TRUE")
ORACLE["revenue_by_category_and_region"] = f"""{CLEAN} SELECT product_category, order_region,
  count(*) AS order_count, {I('sum(quantity)')} AS items_sold,
  {_pounds('sum(total_pence)')} AS revenue,
  {_mean('sum(total_pence)', 'count(*)')} AS avg_order_value
  FROM fct_orders GROUP BY product_category, order_region"""
ORACLE["customer_spend"] = f"""{CLEAN} SELECT d.country, d.region,
  count(DISTINCT d.customer_id) AS unique_customers, count(f.order_id) AS total_orders,
  {_pounds('sum(total_pence)')} AS total_spend,
  {_mean('sum(total_pence)', 'count(*)')} AS avg_spend_per_order,
  {_pounds('max(total_pence)')} AS largest_order
  FROM dim_customers d JOIN fct_orders f ON d.customer_key = f.customer_key
  GROUP BY d.country, d.region"""
ORACLE["bucketed_customer_spend"] = ORACLE["customer_spend"]
ORACLE["exact_buyers_of_a_year"] = f"""{CLEAN} SELECT order_region, count(*) AS orders, count(DISTINCT customer_key) AS buyers
  FROM fct_orders WHERE order_date BETWEEN DATE '{BUYERS_FROM}' AND DATE '{BUYERS_TO}' GROUP BY order_region"""
ORACLE["buyers_of_a_year"] = f"SELECT order_region, orders, TRUE AS near FROM ({ORACLE['exact_buyers_of_a_year']})"
ORACLE["monthly_revenue"] = f"""{CLEAN} SELECT strftime(order_date, '%Y-%m') AS month, order_region,
  count(*) AS orders, {_pounds('sum(total_pence)')} AS revenue FROM fct_orders GROUP BY 1, 2"""
ORACLE["status_distribution"] = f"""{CLEAN} SELECT order_status, order_count,
  {_share('order_count', I('sum(order_count) OVER ()'))} AS pct_of_total, revenue
  FROM (SELECT order_status, count(*) AS order_count, {_pounds('sum(total_pence)')} AS revenue
        FROM fct_orders GROUP BY order_status)"""
ORACLE["top_customers"] = _top_customers("TRUE")
_LOST = """SELECT f.order_id, f.customer_id, f.customer_key FROM fct_orders f
  LEFT JOIN {} d ON f.customer_key = d.customer_key WHERE d.customer_key IS NULL"""
ORACLE["orphan_orders"] = CLEAN + _LOST.format("dim_customers")
ORACLE["orphan_mart_orders"] = CLEAN + _LOST.format(
    f"(SELECT * FROM dim_customers WHERE customer_since >= DATE '{SINCE_END}')"
)


def _counts(names: dict[str, str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{shown}' AS table_name, count(*) AS row_count FROM {table}"
        for table, shown in names.items()
    )


ORACLE["hierarchy_counts"] = DIRTY + _counts(
    {
        "raw_customers": "raw_customers",
        "raw_orders": "raw_orders",
        "dim_customers": "dim_customers (mart)",
        "fct_orders": "fct_orders (mart)",
    }
)

# Reports over the raw tables.

for _column in ("region", "country"):
    ORACLE[f"customers_by_{_column}"] = f"""{CLEAN} SELECT {_column}, count(*) AS customers
  FROM raw_customers GROUP BY {_column}"""
ORACLE["customers_by_gender"] = f"""{CLEAN} SELECT gender, customers,
  {_share('customers', I('sum(customers) OVER ()'))} AS pct_of_total
  FROM (SELECT gender, count(*) AS customers FROM raw_customers GROUP BY gender)"""
ORACLE["top_countries"] = f"""{CLEAN} SELECT country, count(*) AS customers FROM raw_customers
  GROUP BY country ORDER BY customers DESC, country LIMIT 10"""
for _name_, _column in (
    ("orders_by_status", "order_status"),
    ("orders_by_payment_method", "payment_method"),
):
    ORACLE[_name_] = f"""{CLEAN} SELECT {_column}, count(*) AS orders FROM raw_orders
  GROUP BY {_column}"""
_NET = D("sum(quantity * unit_price)")
ORACLE["net_revenue_by_region"] = f"""{CLEAN} SELECT region, count(*) AS orders,
  {_NET} AS net_revenue FROM raw_orders GROUP BY region"""
_CATEGORIES = f"""SELECT product_category, count(*) AS orders, {_NET} AS net_revenue FROM raw_orders
  GROUP BY product_category"""
ORACLE["net_revenue_by_category"] = CLEAN + _CATEGORIES
ORACLE["top_categories"] = (
    DIRTY + _CATEGORIES + " ORDER BY orders DESC, product_category NULLS FIRST LIMIT 8"
)
ORACLE["net_revenue_by_month"] = f"""{CLEAN} SELECT strftime(order_date, '%Y-%m') AS month, region,
  {_NET} AS net_revenue FROM raw_orders GROUP BY 1, 2"""
ORACLE["net_revenue_by_month_pivot"] = f"""{DIRTY} SELECT month,
  {D('uk')} AS uk_revenue, {D('eu')} AS eu_revenue, {D('uk + eu')} AS total_revenue FROM (
    SELECT coalesce(strftime(order_date, '%Y-%m'), '') AS month,
      coalesce(sum(quantity * unit_price) FILTER (region = 'UK'), 0) AS uk,
      coalesce(sum(quantity * unit_price) FILTER (region = 'EU'), 0) AS eu
    FROM raw_orders GROUP BY 1)"""
ORACLE["months"] = f"{CLEAN} SELECT DISTINCT strftime(order_date, '%Y-%m') AS month FROM raw_orders"
ORACLE["quantity_histogram"] = f"""{CLEAN} SELECT {D('position')} AS position, bucket,
  count(*) AS orders FROM (
    SELECT CASE WHEN quantity <= 1 THEN '1' WHEN quantity <= 3 THEN '2-3'
        WHEN quantity <= 6 THEN '4-6' WHEN quantity <= 12 THEN '7-12'
        WHEN quantity <= 24 THEN '13-24' ELSE '25+' END AS bucket,
      CASE WHEN quantity <= 1 THEN 1 WHEN quantity <= 3 THEN 2 WHEN quantity <= 6 THEN 3
        WHEN quantity <= 12 THEN 4 WHEN quantity <= 24 THEN 5 ELSE 6 END AS position
    FROM raw_orders) GROUP BY position, bucket"""
_BUCKET = """CASE WHEN quantity <= 1 THEN '1' WHEN quantity <= 3 THEN '2-3' WHEN quantity <= 6 THEN '4-6'
  WHEN quantity <= 12 THEN '7-12' WHEN quantity <= 24 THEN '13-24' WHEN quantity > 24 THEN '25+' END"""
_MONTH = "coalesce(strftime(order_date, '%Y-%m'), '')"


def _distribution(table: str, name: str, label: str, label_2: str | None, measures: str) -> str:
    second = f", {label_2 or 'CAST(NULL AS VARCHAR)'} AS label_2" if label_2 != "" else ""
    groups = "" if label == "CAST(NULL AS VARCHAR)" else f" GROUP BY {label}{f', {label_2}' if label_2 else ''}"
    return f"SELECT '{name}' AS distribution, {label} AS label{second}, {measures} FROM {table}{groups}"


ORACLE["order_distributions"] = DIRTY + " UNION ALL ".join(
    _distribution("raw_orders", name, label, label_2, f"count(*) AS orders, {_NET} AS net_revenue")
    for name, label, label_2 in (
        *((c, c, None) for c in ("region", "product_category", "order_status", "payment_method")),
        ("quantity", _BUCKET, None),
        ("month", _MONTH, "region"),
        ("all", "CAST(NULL AS VARCHAR)", None),
    )
)
ORACLE["customer_distributions"] = DIRTY + " UNION ALL ".join(
    _distribution("raw_customers", name, label, "", "count(*) AS customers")
    for name, label in (*((c, c) for c in ("region", "country", "gender")), ("all", "CAST(NULL AS VARCHAR)"))
)
ORACLE["kpis"] = f"""{CLEAN} SELECT c.n AS total_customers, o.n AS total_orders,
  {_pounds('o.pence')} AS total_revenue, {_mean('o.pence', 'o.n')} AS avg_order_value
  FROM (SELECT count(*) AS n FROM raw_customers) c,
    (SELECT count(*) AS n, {I('sum(quantity * unit_price * 100)')} AS pence FROM raw_orders) o"""
ORACLE["table_counts"] = CLEAN + _counts({n: n for n in ("raw_customers", "raw_orders")})

# Data quality.

ORACLE["failing_emails"] = f"""{DIRTY} SELECT customer_id, customer_email FROM raw_customers
  WHERE customer_email IS NULL OR position('@' IN customer_email) = 0"""
ORACLE["failing_regions"] = f"""{DIRTY} SELECT customer_id, region FROM raw_customers
  WHERE region IS NULL OR region NOT IN ('UK', 'EU')"""
ORACLE["failing_statuses"] = f"""{DIRTY} SELECT order_id, order_status FROM stg_orders
  WHERE order_status NOT IN ('Pending', 'Shipped', 'Delivered', 'Cancelled', 'Refunded')"""
ORACLE["failing_ages"] = f"""{DIRTY} SELECT customer_id, {D('customer_age')} AS customer_age
  FROM dim_customers WHERE customer_age < 18 OR customer_age > 100"""
_BAD_TOTAL = "coalesce(abs(total_pence - pence - tax_pence) >= 3, TRUE)"
ORACLE["failing_totals"] = f"""{CLEAN}{SPOILT} SELECT order_id, {_pounds('pence')} AS gross_amount,
  {_pounds('tax_pence')} AS tax_amount, {_pounds('total_pence')} AS total_amount FROM spoilt
  WHERE {_BAD_TOTAL}"""
_BAD_TAX = "pence > 0 AND abs(100 * tax_pence - 20 * pence) >= pence"
ORACLE["failing_tax_rates"] = f"""{DIRTY} SELECT order_id, {_pounds('pence')} AS gross_amount,
  {_pounds('tax_pence')} AS tax_amount FROM fct_orders WHERE {_BAD_TAX}"""
ORACLE["repeated_keys"] = DIRTY + " UNION ALL ".join(
    f"""SELECT '{c}' AS column_name, {c} AS value, count(*) AS rows FROM raw_orders
  GROUP BY {c} HAVING count(*) > 1"""
    for c in ("order_id", "customer_id")
)


def _check(name: str, table: str, column: str, broken: str, source: str | None = None) -> str:
    failed = f"(SELECT count(*) FROM {source or table} WHERE {broken})"
    return _checked(name, table, column, failed)


def _checked(name: str, table: str, column: str, failed: str) -> str:
    return f"""SELECT '{name}' AS check_name, '{table}' AS table_name, '{column}' AS column_name,
  failed_rows, CASE WHEN failed_rows = 0 THEN 'PASS' ELSE 'FAIL' END AS status
  FROM (SELECT {I(failed)} AS failed_rows)"""


def _unique(table: str, column: str) -> str:
    return _checked(
        "unique", table, column,
        f"""(SELECT count(*) FROM (SELECT {column} FROM {table} WHERE {column} IS NOT NULL
    GROUP BY {column} HAVING count(*) > 1))""",
    )


def _different(table: str, column: str) -> str:
    distinct = f"(SELECT count(*) FROM (SELECT DISTINCT {column} FROM {table}))"
    return _checked(
        "all_different", table, column, f"((SELECT count(*) FROM {table}) - {distinct})"
    )


def _missing(table: str, *columns: str) -> list[str]:
    return [_check("not_null", table, c, f"{c} IS NULL") for c in columns]


_REGION = "NOT IN ('UK', 'EU')"
_STATUS = "NOT IN ('Pending', 'Shipped', 'Delivered', 'Cancelled', 'Refunded')"


def _reference(name: str, table: str, column: str, parent: str, nulls: str) -> str:
    return _check(
        name, table, column,
        f"""({nulls} AND NOT EXISTS
    (SELECT 1 FROM {parent} p WHERE p.{column} = x.{column}))""",
        f"{table} x",
    )


_PRESENT = "x.customer_id IS NOT NULL"
_SOURCE_CHECKS = [
    _unique("raw_customers", "customer_id"),
    *_missing("raw_customers", "customer_id", "customer_email", "country"),
    _check("accepted_values", "raw_customers", "region", f"region {_REGION}"),
    _unique("raw_orders", "order_id"),
    *_missing("raw_orders", "order_id", "quantity", "unit_price"),
    _reference("relationship", "raw_orders", "customer_id", "raw_customers", _PRESENT),
    _check("accepted_range", "raw_orders", "quantity", "quantity < 1"),
    _check("accepted_range", "raw_orders", "unit_price", "unit_price < 0"),
    _check("accepted_values", "raw_orders", "region", f"region {_REGION}"),
]
_STAGING_CHECKS = [
    _unique("stg_customers", "customer_id"),
    *_missing("stg_customers", "customer_id"),
    _check("accepted_values", "stg_customers", "region", f"region {_REGION}"),
    _unique("stg_orders", "order_id"),
    *_missing("stg_orders", "order_id", "customer_id"),
    _check("accepted_range", "stg_orders", "quantity", "quantity < 1"),
    _check("accepted_range", "stg_orders", "total_amount", "total_pence < 0"),
]
_MART_CHECKS = [
    _unique("dim_customers", "customer_key"),
    _unique("dim_customers", "customer_id"),
    *_missing(
        "dim_customers", "customer_key", "customer_id", "customer_email", "region", "country",
        "customer_since",
    ),
    _check("accepted_values", "dim_customers", "region", f"region {_REGION}"),
    _check("accepted_range", "dim_customers", "customer_age", "customer_age NOT BETWEEN 18 AND 100"),
    _unique("fct_orders", "order_key"),
    _unique("fct_orders", "order_id"),
    *_missing(
        "fct_orders", "order_key", "order_id", "customer_key", "customer_id", "order_status",
        "quantity", "unit_price", "order_region", "order_date",
    ),
    _check("not_null", "fct_orders", "total_amount", "total_pence IS NULL", "spoilt"),
    _reference(
        "relationship", "fct_orders", "customer_key", "dim_customers", "x.customer_key IS NOT NULL"
    ),
    _check("accepted_values", "fct_orders", "order_status", f"order_status {_STATUS}"),
    _check("accepted_range", "fct_orders", "quantity", "quantity NOT BETWEEN 1 AND 1000"),
    _check("accepted_range", "fct_orders", "unit_price", "unit_price NOT BETWEEN 0 AND 1000"),
    _check(
        "accepted_range", "fct_orders", "total_amount", "total_pence NOT BETWEEN 0 AND 10000000",
        "spoilt",
    ),
    _check("accepted_values", "fct_orders", "order_region", f"order_region {_REGION}"),
]


def _empty(table: str) -> str:
    failed = f"(SELECT CASE WHEN count(*) = 0 THEN 1 ELSE 0 END FROM {table})"
    return _checked("non_empty", table, "*", failed)


_ASSERTED_RAW = [
    _different("raw_customers", "customer_id"),
    *_missing("raw_customers", "customer_id"),
    _check(
        "contains", "raw_customers", "customer_email",
        "customer_email IS NULL OR customer_email NOT LIKE '%@%'",
    ),
    _check(
        "not_blank", "raw_customers", "customer_email",
        "customer_email IS NULL OR customer_email = ''",
    ),
    _check("accepted_values_strict", "raw_customers", "region", f"region IS NULL OR region {_REGION}"),
    _check("not_blank", "raw_customers", "country", "country IS NULL OR country = ''"),
    _empty("raw_customers"),
    _different("raw_orders", "order_id"),
    *_missing("raw_orders", "order_id", "order_date"),
    _check("positive", "raw_orders", "quantity", "quantity IS NULL OR quantity <= 0"),
    _check("non_negative", "raw_orders", "unit_price", "unit_price IS NULL OR unit_price < 0"),
    _check("accepted_values_strict", "raw_orders", "region", f"region IS NULL OR region {_REGION}"),
    _check(
        "accepted_values_strict", "raw_orders", "order_status",
        f"order_status IS NULL OR order_status {_STATUS}",
    ),
    _reference("relationship_strict", "raw_orders", "customer_id", "raw_customers", "TRUE"),
    _empty("raw_orders"),
]


def _asserted_marts(fact: str) -> list[str]:
    return [
        _different("dim_customers", "customer_key"),
        _different("dim_customers", "customer_id"),
        _check(
            "accepted_range_strict", "dim_customers", "customer_age",
            "customer_age IS NULL OR customer_age NOT BETWEEN 18 AND 100",
        ),
        _check("accepted_values_strict", "dim_customers", "region", f"region IS NULL OR region {_REGION}"),
        *_missing("dim_customers", "customer_since"),
        _empty("dim_customers"),
        _empty("fct_orders"),
        _different("fct_orders", "order_key"),
        _different("fct_orders", "order_id"),
        _reference("relationship_strict", "fct_orders", "customer_key", "dim_customers", "TRUE"),
        _check(
            "non_negative", "fct_orders", "total_amount",
            "total_pence IS NULL OR total_pence < 0", fact,
        ),
        _check("total_is_sum", "fct_orders", "total_amount", _BAD_TOTAL, fact),
        _check("tax_rate", "fct_orders", "tax_amount", _BAD_TAX, fact),
        _check(
            "accepted_values_strict", "fct_orders", "order_region",
            f"order_region IS NULL OR order_region {_REGION}",
        ),
    ]


_BOTH = DIRTY + SPOILT
ORACLE["declared_source_checks"] = DIRTY + " UNION ALL ".join(_SOURCE_CHECKS)
ORACLE["declared_staging_checks"] = DIRTY + " UNION ALL ".join(_STAGING_CHECKS)
ORACLE["declared_mart_checks"] = _BOTH + " UNION ALL ".join(_MART_CHECKS)
ORACLE["asserted_raw_checks"] = DIRTY + " UNION ALL ".join(_ASSERTED_RAW)
ORACLE["asserted_mart_checks"] = _BOTH + " UNION ALL ".join(_asserted_marts("spoilt"))
ORACLE["clean_mart_checks"] = CLEAN + " UNION ALL ".join(_asserted_marts("fct_orders"))
ORACLE["guarded_refresh"] = LOADED + " UNION ALL ".join(_asserted_marts("fct_orders"))
_DEFINED = {
    "raw_customers": (
        "customer_id customer_full_name customer_email country region", "customer_id=20 region=4 gender=4"
    ),
    "raw_orders": (
        "order_id customer_id order_date order_status quantity unit_price region",
        "order_id=20 customer_id=20 order_status=20 payment_method=20 product_category=50 region=4",
    ),
    "dim_customers": ("customer_id", "customer_id=20 region=4 gender=4"),
    "fct_orders": (
        "order_id customer_id order_date order_status quantity unit_price order_region",
        "order_id=20 customer_id=20 order_status=20 payment_method=20 product_category=50 order_region=4",
    ),
}
_DEFINED_CHECKS = [
    check
    for table, (needed, longest) in _DEFINED.items()
    for check in _missing(table, *needed.split())
    + [
        _check("max_length", table, c, f"length({c}) > {n}")
        for c, n in (pair.split("=") for pair in longest.split())
    ]
] + [
    _check("not_null", "fct_orders", f"{shown}_amount", f"{pence} IS NULL", "spoilt")
    for shown, pence in (("gross", "pence"), ("tax", "tax_pence"), ("total", "total_pence"))
]
ORACLE["defined_checks"] = _BOTH + " UNION ALL ".join(_DEFINED_CHECKS)
_ROLES_SEE = {"engineer": "TRUE", "uk_analyst": "{} = 'UK'", "eu_analyst": "{} = 'EU'", "other_role": "FALSE"}
_LAYERS = {
    "raw_customers": None, "raw_orders": None, "stg_customers": None, "stg_orders": None,
    "dim_customers": "region", "fct_orders": "order_region",
}
ORACLE["layer_gate"] = DIRTY + " UNION ALL ".join(
    f"SELECT '{table}' AS table_name, '{SHORT_ROLES[short]}' AS role, {allowed} AS allowed, {rows} AS visible_rows"
    for table, region in _LAYERS.items()
    for short, sees in _ROLES_SEE.items()
    for allowed in [str(region is not None or short == "engineer").upper()]
    for rows in [
        f"(SELECT count(*) FROM {table} WHERE {sees.format(region) if region else 'TRUE'})" if allowed == "TRUE" else "0"
    ]
)
_DICTIONARY = {"raw_customers": CUSTOMER_COLUMNS, "raw_orders": ORDER_COLUMNS}
ORACLE["data_dictionary"] = DIRTY + " UNION ALL ".join(
    f"""SELECT '{table}' AS table_name, {D(str(i))} AS position, '{c}' AS column_name,
  (SELECT count({c}) FROM {table}) AS known_rows"""
    for table, names in _DICTIONARY.items()
    for i, c in enumerate(names, 1)
)
_PLAIN = {
    "customer_age": "int", "quantity": "int", "date_of_birth": "date", "order_date": "date", "customer_since": "date",
    "created_at": "timestamp", "updated_at": "timestamp", "unit_price": "decimal(10,2)",
    "gross_amount": "decimal(12,2)", "tax_amount": "decimal(12,2)", "total_amount": "decimal(12,2)",
}
_STORED = _DICTIONARY | {
    "dim_customers": "customer_key customer_id customer_full_name customer_email customer_phone country region gender customer_age customer_since updated_at".split(),
    "fct_orders": (
        "order_key order_id customer_key customer_id order_date order_status payment_method product_category product_description "
        "quantity unit_price gross_amount tax_amount total_amount order_region created_at"
    ).split(),
}
_KEYS = {
    ("raw_customers", "customer_id"): "'primary'", ("raw_orders", "order_id"): "'primary'", ("dim_customers", "customer_key"): "'primary'",
    ("fct_orders", "order_key"): "'primary'", ("raw_orders", "customer_id"): "'references raw_customers.customer_id'",
    ("fct_orders", "customer_key"): "'references dim_customers.customer_key'",
}
_IN_PENCE = {"gross_amount": "pence", "tax_amount": "tax_pence", "total_amount": "total_pence"}
ORACLE["catalog_dictionary"] = CLEAN + " UNION ALL ".join(
    f"""SELECT '{table}' AS table_name, {D(str(i))} AS position, '{c}' AS column_name, '{_PLAIN.get(c, 'string')}' AS data_type,
  {_KEYS.get((table, c), 'CAST(NULL AS VARCHAR)')} AS key, (SELECT count({_IN_PENCE.get(c, c)}) FROM {table}) AS known_rows"""
    for table, names in _STORED.items()
    for i, c in enumerate(names, 1)
)
_ALL = dict.fromkeys(
    _SOURCE_CHECKS + _STAGING_CHECKS + _MART_CHECKS + _ASSERTED_RAW + _asserted_marts("spoilt")
)
ORACLE["quality_report"] = _BOTH + " UNION ALL ".join(_ALL)
ORACLE["quality_summary"] = f"""{_BOTH} SELECT table_name, count(*) AS checks,
  count(*) FILTER (status = 'PASS') AS passed, count(*) FILTER (status = 'FAIL') AS failed
  FROM ({' UNION ALL '.join(_ASSERTED_RAW + _asserted_marts('spoilt'))}) GROUP BY table_name"""
