"""The derived messages in SQL, for comparison only: envelopes, parsed records and rule verdicts."""

ASOF = "TIMESTAMP '2024-02-01 00:00:00'"
ASOF_MS = "1706745600000"
ASOF_2001 = "TIMESTAMP '2001-08-02 00:00:00'"
ASOF_2001_MS = "996710400000"

# ---- user events ----------------------------------------------------------------------------
UE = """
ue0 AS (
  SELECT event_id AS n, ts, user_id AS uid, props,
    strftime(ts, '%Y-%m-%dT%H:%M:%S.%g') AS iso,
    CAST(CAST(value AS DECIMAL(12,2)) AS VARCHAR) AS money,
    CASE WHEN event_id % 83 = 11 THEN 'u' || user_id ELSE printf('user-%05d', user_id) END AS usr,
    CASE WHEN event_id % 89 = 7 THEN event_type ELSE upper(event_type) END AS kind,
    CASE WHEN event_id % 79 = 13 THEN '2024-03-01' WHEN event_id % 73 = 17 THEN '2024/01/15'
         WHEN event_id % 71 = 19 THEN '2018-12-31' ELSE strftime(ts, '%Y-%m-%d') END AS cobt
  FROM events),
ue1 AS (
  SELECT *, CASE WHEN n % 67 = 23 THEN '1500000000000' WHEN n % 3 = 0 THEN CAST((epoch_us(ts) // 1000) AS VARCHAR)
                 WHEN n % 3 = 1 THEN iso || 'Z' ELSE iso END AS stamp FROM ue0),
ue2 AS (
  SELECT *,
    '{' || CASE WHEN n % 61 = 3 THEN '"cob_date":"' || cobt || '",' WHEN n % 59 = 4 THEN '' ELSE '"cob":"' || cobt || '",' END
    || '"data":"value=' || money || '","event_type":"' || kind || '","note":"not in the schema","properties":' || props
    || ',"timestamp":' || CASE WHEN regexp_full_match(stamp, '[0-9]+') THEN stamp ELSE '"' || stamp || '"' END
    || ',"user_id":' || CASE WHEN n % 97 = 5 THEN 'null' ELSE '"' || usr || '"' END || '}' AS js,
    cobt || ', ' || CASE WHEN n % 97 = 5 THEN 'null' ELSE usr END || ' ,' || kind || ',' || stamp || ',"value=' || money || ', from csv"' AS csv
  FROM ue1),
ue AS (
  SELECT 'user.events.v1' AS topic, CAST(n % 8 AS INTEGER) AS partition, n // 8 AS "offset", CAST(uid AS VARCHAR) AS key,
    CASE WHEN n % 211 = 0 THEN '' WHEN n % 223 = 1 THEN NULL WHEN n % 227 = 2 THEN '[1, 2, 3]' WHEN n % 10 = 0 THEN csv
         WHEN n % 10 = 1 THEN left(js, length(js) - 9) ELSE js END AS value, ts
  FROM ue2)
"""

# Format, parsed fields and parse error of the user events.
UP = UE + f""",
up0 AS (
  SELECT *, CASE WHEN (value LIKE '{{%}}' OR value LIKE '[%]') IS NOT TRUE AND value LIKE '%,%' AND value NOT LIKE '%{{%' AND value NOT LIKE '%[%'
                 THEN 'CSV' ELSE 'JSON' END AS format FROM ue),
up1 AS (
  SELECT *, CASE WHEN format = 'JSON' AND value <> '' AND json_valid(value) AND json_type(value) = 'OBJECT' THEN CAST(value AS JSON) END AS doc,
         CASE WHEN format = 'CSV' THEN string_split(value, ',') END AS cells FROM up0),
up2 AS (
  SELECT *,
    CASE WHEN format = 'CSV' THEN trim(cells[1]) ELSE coalesce(json_extract_string(doc, '$.cob'), json_extract_string(doc, '$.cob_date'), '2024-02-01') END AS cob,
    CASE WHEN format = 'CSV' THEN nullif(trim(cells[2]), 'null') ELSE json_extract_string(doc, '$.user_id') END AS user_id,
    CASE WHEN format = 'CSV' THEN cells[3] ELSE json_extract_string(doc, '$.event_type') END AS event_type,
    CASE WHEN format = 'CSV' THEN cells[4] ELSE json_extract_string(doc, '$.timestamp') END AS stamp,
    CASE WHEN format = 'CSV' THEN trim(cells[5] || ',' || cells[6], '"') ELSE json_extract_string(doc, '$.data') END AS data,
    CASE WHEN format = 'JSON' THEN json_extract_string(doc, '$.properties.k') END AS k,
    CASE WHEN value IS NULL THEN 'null_value' WHEN value = '' THEN 'empty_message'
         WHEN format = 'JSON' AND doc IS NULL THEN 'malformed_json' END AS parse_error
  FROM up1),
up AS (
  SELECT topic, partition, "offset", key, value, ts, format, cob, user_id, event_type, data, k, parse_error,
    CASE WHEN regexp_full_match(stamp, '[+-]?[0-9]+') THEN TRY_CAST(stamp AS BIGINT)
         WHEN stamp IS NOT NULL THEN coalesce(epoch_ms(TRY_CAST(replace(stamp, 'Z', '') AS TIMESTAMP)), {ASOF_MS}) END AS ms
  FROM up2)
"""

COB_CASES = """WHEN NOT (regexp_full_match(cob, '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}') AND TRY_CAST(cob AS DATE) IS NOT NULL) THEN 'cob_format'
    WHEN TRY_CAST(cob AS DATE) > CAST({asof} AS DATE) THEN 'cob_future'
    WHEN TRY_CAST(cob AS DATE) < CAST(CAST({asof} AS DATE) - INTERVAL 60 MONTH AS DATE) THEN 'cob_too_old'"""
FORMAT_CASES = """WHEN user_id IS NULL THEN 'user_id_required'
    WHEN event_type IS NULL THEN 'event_type_required'
    WHEN NOT regexp_full_match(event_type, '[A-Z_]+') THEN 'event_type_format'
    WHEN NOT regexp_full_match(user_id, '[a-zA-Z0-9-]{{8,}}') THEN 'user_id_format'
    WHEN ms < {asof_ms} - 157680000000 THEN 'timestamp_too_old'
    WHEN ms > {asof_ms} + 86400000 THEN 'timestamp_future'"""

# Verdicts; the user events have no product_id column, so purchases lack it.
UC = UP + f""",
uc AS (
  SELECT *, CASE WHEN parse_error IS NOT NULL THEN 'parse'
    {COB_CASES.format(asof=ASOF)}
    {FORMAT_CASES.format(asof_ms=ASOF_MS)}
    WHEN event_type IN ('PRODUCT_VIEW', 'ADD_TO_CART', 'PURCHASE') THEN 'product_required' END AS reject_rule
  FROM up)
"""

# ---- commerce events ------------------------------------------------------------------------
CE = """
ce0 AS (
  SELECT l_orderkey AS o, l_partkey AS p, l_linenumber AS ln, l_suppkey AS s, l_shipdate AS d, CAST(l_quantity AS INTEGER) AS units,
    CAST(round(l_extendedprice * 100) AS BIGINT) AS cents FROM lineitem),
ce1 AS (SELECT *, (2 * cents + units) // (2 * units) AS pc FROM ce0),
ce2 AS (
  SELECT *, CASE WHEN o % 41 = 5 THEN '-12.50' WHEN o % 43 = 6 THEN '1000000.01' WHEN o % 47 = 7 THEN 'NaN' WHEN o % 53 = 8 THEN NULL
      WHEN o % 59 = 9 THEN printf('%d.%02d', (pc * units + 100) // 100, (pc * units) % 100)
      ELSE printf('%d.%02d', (pc * units) // 100, (pc * units) % 100) END AS amount,
    CASE WHEN o % 61 = 10 THEN '-1' WHEN o % 67 = 11 THEN '10001' WHEN o % 71 = 12 THEN '1.0' WHEN o % 73 = 13 THEN ' 7 ' ELSE CAST(units AS VARCHAR) END AS quantity,
    CASE WHEN p % 37 = 3 THEN NULL WHEN p % 31 = 4 THEN 'p-' || p ELSE printf('PROD-%06d', p) END AS product_id,
    CASE WHEN s % 5 = 0 THEN NULL ELSE 's-' || s END AS session_id,
    (['PURCHASE','ORDER','PAYMENT','REFUND','USER_ACTION','PRODUCT_VIEW','ADD_TO_CART','PAGE_VIEW','SECURITY_ALERT','LOGIN_FAILED','LOGIN','FRAUD_DETECTED'])[CAST((p + ln) % 12 AS INTEGER) + 1] AS event_type,
    (['USD','EUR','GBP','JPY','CAD','AUD','CHF'])[CAST(p % 7 AS INTEGER) + 1] AS currency,
    strftime(d, '%Y-%m-%d') AS cob, epoch_ms(d + to_hours(CAST(o % 24 AS INTEGER))) AS ms,
    printf('%d.%02d', pc // 100, pc % 100) AS unit_price, printf('user-%05d', o) AS user_id
  FROM ce1),
ce AS (
  SELECT 'commerce.events.v1' AS topic, CAST(o % 16 AS INTEGER) AS partition, (o // 16) * 8 + ln AS "offset", CAST(o AS VARCHAR) AS key, d AS ts,
    '{' || CASE WHEN amount IS NULL THEN '' ELSE '"amount":"' || amount || '",' END || '"cob":"' || cob || '","currency":"' || currency || '","event_type":"' || event_type || '"'
    || CASE WHEN product_id IS NULL THEN '' ELSE ',"product_id":"' || product_id || '"' END || ',"quantity":"' || quantity || '"'
    || CASE WHEN session_id IS NULL THEN '' ELSE ',"session_id":"' || session_id || '"' END
    || ',"timestamp":' || ms || ',"unit_price":"' || unit_price || '","user_id":"' || user_id || '"}' AS value FROM ce2)
"""

NUM = "(CASE WHEN regexp_full_match({0}, '\\s*[+-]?(NaN|Infinity|([0-9]+(\\.[0-9]*)?|\\.[0-9]+)([eE][+-]?[0-9]+)?[fFdD]?)\\s*') THEN TRY_CAST(trim({0}) AS DOUBLE) END)"
INT = "(CASE WHEN regexp_full_match({0}, '[+-]?[0-9]+') THEN TRY_CAST({0} AS INTEGER) END)"

# Parsed fields with numbers (n*) beside their text.
CP = CE + f""",
cp0 AS (
  SELECT topic, partition, "offset", key, value, ts,
    json_extract_string(value, '$.cob') AS cob, json_extract_string(value, '$.user_id') AS user_id, json_extract_string(value, '$.event_type') AS event_type,
    CAST(json_extract_string(value, '$.timestamp') AS BIGINT) AS ms, json_extract_string(value, '$.amount') AS amount,
    json_extract_string(value, '$.quantity') AS quantity, json_extract_string(value, '$.unit_price') AS unit_price,
    json_extract_string(value, '$.product_id') AS product_id, json_extract_string(value, '$.currency') AS currency, json_extract_string(value, '$.session_id') AS session_id
  FROM ce),
cp AS (SELECT *, {NUM.format('amount')} AS namount, {INT.format('quantity')} AS nquantity, {NUM.format('unit_price')} AS nprice FROM cp0)
"""

NUMERIC_CASES = """WHEN amount IS NOT NULL AND namount IS NULL THEN 'amount_format'
    WHEN namount < 0 THEN 'amount_negative'
    WHEN namount > 1000000 AND NOT isnan(namount) THEN 'amount_limit'
    WHEN quantity IS NOT NULL AND nquantity IS NULL THEN 'quantity_format'
    WHEN nquantity < 0 THEN 'quantity_negative'
    WHEN nquantity > 10000 THEN 'quantity_limit'"""
CROSS_CASES = """WHEN event_type IN ('PURCHASE', 'ORDER') AND amount IS NOT NULL AND quantity IS NOT NULL AND unit_price IS NOT NULL AND nprice IS NULL THEN 'unit_price_format'
    WHEN event_type IN ('PURCHASE', 'ORDER') AND abs(namount - nquantity * nprice) > 0.01 AND NOT isnan(namount) THEN 'amount_mismatch'"""
CONDITIONAL_CASES = """WHEN event_type = 'USER_ACTION' AND (user_id IS NULL OR session_id IS NULL) THEN 'session_required'
    WHEN event_type IN ('PRODUCT_VIEW', 'ADD_TO_CART', 'PURCHASE') AND product_id IS NULL THEN 'product_required'
    WHEN event_type IN ('PRODUCT_VIEW', 'ADD_TO_CART', 'PURCHASE') AND NOT regexp_full_match(product_id, '[A-Z0-9_-]{6,20}') THEN 'product_format'
    WHEN event_type IN ('PAYMENT', 'REFUND') AND (amount IS NULL OR currency IS NULL) THEN 'money_fields_required'
    WHEN event_type IN ('PAYMENT', 'REFUND') AND currency NOT IN ('USD', 'EUR', 'GBP', 'JPY', 'CAD', 'AUD') THEN 'currency_code'"""

CC = CP + f""",
cc AS (
  SELECT *, CASE {COB_CASES.format(asof=ASOF_2001)}
    {FORMAT_CASES.format(asof_ms=ASOF_2001_MS)}
    {NUMERIC_CASES}
    {CROSS_CASES}
    {CONDITIONAL_CASES} END AS reject_rule FROM cp)
"""

# ---- order events ---------------------------------------------------------------------------
OE = """
oe0 AS (
  SELECT o_orderkey AS k, o_custkey AS c, o_orderdate AS d, CAST(round(o_totalprice * 100) AS BIGINT) AS cents,
    CASE WHEN o_orderkey % 23 = 1 THEN 'lost' WHEN o_orderstatus = 'F' THEN 'delivered' WHEN o_orderstatus = 'O' THEN 'created' WHEN o_orderstatus = 'P' THEN 'paid' END AS status
  FROM orders),
oe1 AS (
  SELECT *, CASE WHEN k % 29 = 2 THEN '-5' WHEN k % 31 = 3 THEN '"12.50"' ELSE printf('%d.%02d', cents // 100, cents % 100) END AS total,
    CASE WHEN k % 37 = 4 THEN 'usd' ELSE (['USD','EUR','GBP','JPY','CAD','AUD','CHF'])[CAST(k % 7 AS INTEGER) + 1] END AS currency,
    CASE WHEN k % 41 = 5 THEN strftime(d, '%Y-%m-%d') ELSE strftime(d, '%Y-%m-%dT%H:%M:%SZ') END AS stamp,
    array_to_string([ '{"product_id":"PROD-' || (k % 1000 + i) || '"' || CASE WHEN k % 43 = 6 AND i = 2 THEN '' ELSE ',"quantity":' ||
        CASE WHEN k % 47 = 7 AND i = 1 THEN '0' WHEN k % 53 = 8 AND i = 1 THEN '2.5' ELSE CAST(i AS VARCHAR) END END
        || ',"unit_price":' || printf('%d.%02d', ((cents + 5) // 10 + 100 * i) // 100, ((cents + 5) // 10) % 100) || '}' for i in range(1, k % 3 + 2)], ',') AS items
  FROM oe0),
oe AS (
  SELECT 'orders.lifecycle.v2' AS topic, CAST(k % 12 AS INTEGER) AS partition, k // 12 AS "offset", CAST(c AS VARCHAR) AS key, d AS ts, k,
    '{"cob":"' || strftime(d, '%Y-%m-%d') || '","currency":"' || currency || '"' || CASE WHEN k % 59 = 9 THEN '' ELSE ',"customer_id":"CUST-' || c || '"' END
    || ',"items":[' || items || '],"order_id":"ORD-' || k || '","order_status":"' || status || '","timestamp":"' || stamp || '","total_amount":' || total || '}' AS value
  FROM oe1)
"""

# Items of the orders, and the parse error: a fractional quantity is no integer.
OP = OE + f""",
op0 AS (SELECT *, json_extract(value, '$.items[*]') AS items, json_extract_string(value, '$.timestamp') AS stamp FROM oe),
op AS (
  SELECT *, CASE WHEN len(list_filter([json_extract_string(i, '$.quantity') for i in items], lambda q: q IS NOT NULL AND NOT regexp_full_match(q, '[+-]?[0-9]+'))) > 0 THEN 'bad_field:items' END AS parse_error,
    json_extract_string(value, '$.cob') AS cob, json_extract_string(value, '$.order_id') AS order_id, json_extract_string(value, '$.customer_id') AS customer_id,
    json_extract_string(value, '$.order_status') AS order_status, json_extract_string(value, '$.currency') AS currency,
    CAST(json_extract_string(value, '$.total_amount') AS DOUBLE) AS total_amount,
    CASE WHEN stamp LIKE '%T%' THEN epoch_ms(CAST(replace(stamp, 'Z', '') AS TIMESTAMP)) ELSE {ASOF_2001_MS} END AS ms
  FROM op0),
oc AS (
  SELECT *, CASE WHEN parse_error IS NOT NULL THEN 'parse' {COB_CASES.format(asof=ASOF_2001)}
    WHEN order_id IS NULL THEN 'order_id_required' WHEN order_status IS NULL THEN 'order_status_required'
    WHEN ms < {ASOF_2001_MS} - 157680000000 THEN 'timestamp_too_old' WHEN ms > {ASOF_2001_MS} + 86400000 THEN 'timestamp_future' END AS reject_rule FROM op)
"""

# ---- page events ----------------------------------------------------------------------------
PE = """
pe0 AS (
  SELECT event_id AS n, user_id, ts, '{"event_type":"' || event_type || '","page_url":"https://shop.example.com/' || CASE WHEN event_id % 23 = 5 THEN 'a b' ELSE 'p/' || event_id END
    || '","properties":' || CASE WHEN event_id % 37 = 8 THEN '"none"' ELSE props END || CASE WHEN event_id % 31 = 7 THEN ',"referrer":null' ELSE '' END
    || ',"session_id":"s-' || (event_id % 100) || '","timestamp":"' || strftime(ts, '%Y-%m-%dT%H:%M:%S.%g') || CASE WHEN event_id % 29 = 6 THEN '"' ELSE 'Z"' END
    || CASE WHEN event_id % 17 = 3 THEN '' WHEN event_id % 19 = 4 THEN ',"user_id":' || user_id ELSE ',"user_id":"' || printf('user-%05d', user_id) || '"' END || '}' AS t FROM events),
pe AS (SELECT 'page.events.v1' AS topic, CAST(n % 8 AS INTEGER) AS partition, n // 8 AS "offset", ts,
    CASE WHEN n % 41 = 9 THEN left(t, length(t) - 4) WHEN n % 43 = 10 THEN '[' || t || ']' ELSE t END AS value FROM pe0)
"""


def sql(*parts: str, select: str) -> str:
    """A statement from message tables and a final SELECT."""
    return "WITH " + ", ".join(p.strip() for p in parts) + "\n" + select.strip()
