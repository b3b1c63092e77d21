"""The registered queries once more, as SQL over the given tables."""

from __future__ import annotations

from .operators.quality import (GRAINS, NOT_NULL, RELATIONSHIPS, SAME_COUNT, UNIQUE)
from .schemas import (ENTITIES, EVENT_FIELDS, EVENT_TYPE, MASTER_PIPELINE, NON_NEGATIVE_FIELDS,
                      NUMERIC_FIELDS, SALES_PIPELINE, TRANSACTION_FIELDS)

# Common table expressions in dependency order; DuckDB runs only the ones a query uses.
CTES: dict[str, str] = {}

CTES["lines"] = """
SELECT l.*, o_custkey, c_nationkey, o_orderdate,
       CAST(o_orderdate AS DATE) AS sales_date,
       CAST(l_quantity AS INTEGER) AS quantity,
       CAST(p_retailprice AS DECIMAL(18,2)) AS unit_price,
       CAST(l_discount AS DECIMAL(10,6)) AS discount_pct,
       CAST(l_extendedprice AS DECIMAL(18,2)) AS gross_sales,
       l_orderkey * 1000 + row_number() OVER (PARTITION BY l_orderkey
         ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity) AS line
FROM lineitem l
JOIN orders ON l_orderkey = o_orderkey
JOIN customer ON o_custkey = c_custkey
JOIN part ON l_partkey = p_partkey"""

CTES["priced"] = """
SELECT *, CAST(gross_sales * discount_pct AS DECIMAL(18,2)) AS discount_amount,
       CAST(unit_price * CAST(0.6 AS DECIMAL(2,1)) AS DECIMAL(18,2)) AS unit_cogs
FROM lines"""

CTES["sold"] = """
SELECT *, CAST(gross_sales - discount_amount AS DECIMAL(18,2)) AS net_sales,
       CAST(quantity * unit_cogs AS DECIMAL(18,2)) AS total_cogs,
       'DST' || l_suppkey AS distributor_id, 'SP' || c_nationkey AS salesperson_id,
       'OUT' || o_custkey AS outlet_id, 'P' || l_partkey AS product_id,
       'INV' || l_orderkey AS invoice_id,
       CAST(l_orderkey % 8 AS INTEGER) AS kafka_partition,
       CAST(line * 2 AS BIGINT) AS kafka_offset
FROM priced"""

_MONEY = ("unit_price, discount_pct, discount_amount, gross_sales, net_sales, "
          "unit_cogs, total_cogs")
_IDS = "distributor_id, salesperson_id, outlet_id, product_id, invoice_id"

CTES["stg_sales"] = f"""
SELECT sales_date, {_IDS}, quantity, {_MONEY},
       CAST(line AS BIGINT) AS raw_record_id,
       'FactSales_' || year(sales_date) || '_Q' || quarter(sales_date) || '.csv'
         AS source_file,
       CAST(l_linenumber + 1 AS BIGINT) AS source_row_number,
       CAST(year(sales_date) * 10 + quarter(sales_date) AS BIGINT) AS pipeline_run_id,
       CAST(l_shipdate AS TIMESTAMP) AS ingested_at
FROM sold"""


def _master(sheet: str, run: int, key: str) -> str:
    return f"""CAST({key} AS BIGINT) AS raw_record_id, 'MasterData.csv' AS source_file,
       '{sheet}' AS source_sheet, CAST({key} + 2 AS BIGINT) AS source_row_number,
       CAST({run} AS BIGINT) AS pipeline_run_id,
       TIMESTAMP '2024-01-01 00:00:00' AS ingested_at"""


CTES["stg_product"] = f"""
SELECT 'P' || p_partkey AS product_id, p_type AS category, p_brand AS brand,
       p_name AS product_name, CAST(NULL AS VARCHAR) AS variant,
       p_size || ' PCS' AS pack_size,
       CAST(p_retailprice AS DECIMAL(18,2)) AS unit_price,
       CAST(CAST(p_retailprice AS DECIMAL(18,2)) * CAST(0.6 AS DECIMAL(2,1))
            AS DECIMAL(18,2)) AS unit_cogs,
       {_master('DimProduct', 1, 'p_partkey')}
FROM part"""

CTES["stg_distributor"] = f"""
SELECT 'DST' || s_suppkey AS distributor_id, s_name AS distributor_name,
       r_name AS region, n_name AS province, 'City ' || s_nationkey AS city,
       CASE WHEN s_acctbal < 0 THEN NULL ELSE 'Main' END AS distributor_type,
       CAST(1990 + s_nationkey + 1 AS INTEGER) AS start_year,
       {_master('DimDistributor', 2, 's_suppkey')}
FROM supplier JOIN nation ON s_nationkey = n_nationkey
JOIN region ON n_regionkey = r_regionkey"""

CTES["stg_salesperson"] = f"""
SELECT 'SP' || n_nationkey AS salesperson_id, n_name AS salesperson_name,
       r_name AS supervisor, 'DST' || n_nationkey AS distributor_id,
       n_name AS territory, CAST(2000 + n_nationkey AS INTEGER) AS join_year,
       {_master('DimSalesperson', 3, 'n_nationkey')}
FROM nation JOIN region ON n_regionkey = r_regionkey"""

CTES["stg_outlet"] = f"""
SELECT 'OUT' || c_custkey AS outlet_id, c_name AS outlet_name, c_mktsegment AS channel,
       CASE WHEN c_acctbal > 5000 THEN 'A' ELSE 'B' END AS outlet_tier,
       'DST' || c_nationkey AS distributor_id, 'SP' || c_nationkey AS salesperson_id,
       'City ' || c_nationkey AS city, n_name AS province, r_name AS region,
       CAST(2000 + c_nationkey AS INTEGER) AS open_year,
       {_master('DimOutlet', 4, 'c_custkey')}
FROM customer JOIN nation ON c_nationkey = n_nationkey
JOIN region ON n_regionkey = r_regionkey"""

CTES["monthly"] = """
SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS month_start, c_nationkey,
       CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DECIMAL(18,2)) AS target_sales,
       CAST(count(DISTINCT o_custkey) AS INTEGER) AS target_active_outlets
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
JOIN customer ON o_custkey = c_custkey
GROUP BY 1, 2"""

CTES["stg_target"] = f"""
SELECT month_start, 'SP' || c_nationkey AS salesperson_id, target_sales,
       target_active_outlets,
       {_master('FactTarget', 5,
                '(year(month_start) * 10000 + month(month_start) * 100 + c_nationkey)')}
FROM monthly"""

CTES["stock"] = """
SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS month_start, l_suppkey, l_partkey,
       sum(CAST(l_quantity AS INTEGER)) AS sold,
       sum(CASE WHEN l_returnflag = 'R' THEN CAST(l_quantity AS INTEGER) ELSE 0 END)
         AS returned,
       100 + (l_suppkey * 7 + l_partkey) % 50 AS opening,
       20 + (l_suppkey + l_partkey * 3) % 40 AS received
FROM lineitem GROUP BY 1, 2, 3"""

CTES["stg_inventory"] = """
SELECT month_start, 'DST' || l_suppkey AS distributor_id, 'P' || l_partkey AS product_id,
       CAST(opening AS INTEGER) AS opening_stock, CAST(received AS INTEGER) AS stock_received,
       CAST(sold AS INTEGER) AS units_sold,
       CAST(opening + received - sold + returned AS INTEGER) AS closing_stock,
       CAST((opening + received - sold + returned) * CAST(12.5 AS DECIMAL(3,1))
            AS DECIMAL(18,2)) AS stock_value,
       CAST(((year(month_start) * 12 + month(month_start)) * 10000000 + l_suppkey) * 10000000
            + l_partkey AS BIGINT) AS raw_record_id,
       'MasterData.csv' AS source_file, 'FactInventory' AS source_sheet,
       CAST(2 AS BIGINT) AS source_row_number, CAST(6 AS BIGINT) AS pipeline_run_id,
       TIMESTAMP '2024-01-01 00:00:00' AS ingested_at
FROM stock"""

CTES["corrections"] = """
SELECT * EXCLUDE (quantity, kafka_offset),
       'E' || l_orderkey || '-' || l_partkey AS event_id,
       CAST(quantity + 1 + copy AS INTEGER) AS quantity, kafka_offset + copy AS kafka_offset
FROM sold, (SELECT 0 AS copy UNION ALL SELECT 1)
WHERE l_returnflag = 'R' AND (copy = 0 OR l_linenumber % 2 = 0)"""

CTES["first_copies"] = """
SELECT event_id, quantity, kafka_partition, kafka_offset FROM corrections WHERE copy = 0
QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY kafka_partition, kafka_offset) = 1"""

CTES["stg_sales_streaming"] = f"""
SELECT CAST(kafka_partition AS BIGINT) * 17592186044416 + kafka_offset
         AS streaming_record_id,
       event_id, '{EVENT_TYPE}' AS event_type,
       CAST(l_shipdate AS TIMESTAMP) AS event_timestamp, 'till' AS source,
       'corrections.csv' AS source_file, sales_date, {_IDS},
       quantity, {_MONEY},
       'sales.events' AS kafka_topic, kafka_partition, kafka_offset,
       CAST(l_shipdate AS TIMESTAMP) AS ingested_at
FROM corrections
QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY kafka_partition, kafka_offset) = 1"""

_BUSINESS = f"sales_date, {_IDS}, quantity, {_MONEY}"

CTES["stg_sales_unified"] = f"""
SELECT {_BUSINESS}, record_source, source_record_id, source_file,
       source_event_timestamp, ingested_at
FROM (
  SELECT *, row_number() OVER (
      PARTITION BY invoice_id, product_id
      ORDER BY priority DESC, source_event_timestamp DESC NULLS LAST, ingested_at DESC,
               source_record_id DESC) AS rn
  FROM (
    SELECT {_BUSINESS}, 'batch' AS record_source,
           CAST(raw_record_id AS VARCHAR) AS source_record_id, source_file,
           CAST(NULL AS TIMESTAMP) AS source_event_timestamp, ingested_at, 1 AS priority
    FROM stg_sales
    UNION ALL
    SELECT {_BUSINESS}, 'streaming', event_id, source_file, event_timestamp,
           ingested_at, 2
    FROM stg_sales_streaming))
WHERE rn = 1"""

CTES["dim_date"] = """
SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, d AS date_day,
       CAST(day(d) AS INTEGER) AS day_of_month, CAST(month(d) AS INTEGER) AS month_number,
       monthname(d) AS month_name, CAST(quarter(d) AS INTEGER) AS quarter_number,
       CAST(year(d) AS INTEGER) AS year, CAST(date_trunc('month', d) AS DATE) AS month_start,
       strftime(d, '%Y-%m') AS year_month, CAST(isodow(d) AS INTEGER) AS day_of_week_number,
       dayname(d) AS day_name, d = CAST(date_trunc('month', d) AS DATE) AS is_month_start
FROM (
  SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS d
  FROM (
    SELECT CAST(min(lo) AS TIMESTAMP) AS lo, CAST(max(hi) AS TIMESTAMP) AS hi FROM (
      SELECT min(sales_date) AS lo, max(sales_date) AS hi FROM stg_sales
      UNION ALL SELECT min(month_start), max(month_start) FROM stg_target
      UNION ALL SELECT min(month_start), max(month_start) FROM stg_inventory)))"""

for _name, _columns in {
    "product": "product_id, category, brand, product_name, variant, pack_size, "
               "unit_price, unit_cogs",
    "distributor": "distributor_id, distributor_name, distributor_type, city, province, "
                   "region, start_year",
    "salesperson": "salesperson_id, salesperson_name, supervisor, distributor_id, "
                   "territory, join_year",
    "outlet": "outlet_id, outlet_name, channel, outlet_tier, distributor_id, "
              "salesperson_id, city, province, region, open_year",
}.items():
    CTES[f"dim_{_name}"] = (
        f"SELECT md5('{_name}|' || {_name}_id) AS {_name}_key, {_columns} FROM stg_{_name}")

CTES["fact_sales"] = f"""
SELECT md5('sales|' || s.invoice_id || '|' || s.product_id) AS sales_key,
       date_key, product_key, distributor_key, salesperson_key, outlet_key,
       s.invoice_id, s.product_id, s.distributor_id, s.salesperson_id, s.outlet_id,
       s.sales_date, s.quantity, {", ".join("s." + c for c in _MONEY.split(", "))},
       s.net_sales - s.total_cogs AS gross_profit,
       CASE WHEN s.net_sales <> 0 THEN CAST(s.net_sales - s.total_cogs AS DOUBLE)
            / CAST(s.net_sales AS DOUBLE) END AS gross_margin_pct,
       s.record_source, s.source_record_id, s.source_file, s.source_event_timestamp,
       s.ingested_at
FROM stg_sales_unified s
LEFT JOIN dim_date ON s.sales_date = date_day
LEFT JOIN dim_product p ON s.product_id = p.product_id
LEFT JOIN dim_distributor d ON s.distributor_id = d.distributor_id
LEFT JOIN dim_salesperson sp ON s.salesperson_id = sp.salesperson_id
LEFT JOIN dim_outlet o ON s.outlet_id = o.outlet_id"""

_LINEAGE = ("raw_record_id, source_file, source_sheet, source_row_number, "
            "pipeline_run_id, ingested_at")

CTES["fact_inventory"] = f"""
SELECT md5('inventory|' || CAST(i.month_start AS VARCHAR) || '|' || i.distributor_id
           || '|' || i.product_id) AS inventory_key,
       date_key, distributor_key, product_key, i.month_start, i.distributor_id,
       i.product_id, opening_stock, stock_received, units_sold, closing_stock, stock_value,
       opening_stock + stock_received - units_sold AS calculated_closing_stock, {_LINEAGE}
FROM stg_inventory i
LEFT JOIN dim_date ON i.month_start = date_day
LEFT JOIN dim_distributor d ON i.distributor_id = d.distributor_id
LEFT JOIN dim_product p ON i.product_id = p.product_id"""

CTES["fact_sales_target"] = f"""
SELECT md5('sales_target|' || CAST(t.month_start AS VARCHAR) || '|' || t.salesperson_id)
         AS sales_target_key,
       date_key, salesperson_key, t.month_start, t.salesperson_id, target_sales,
       target_active_outlets, {_LINEAGE}
FROM stg_target t
LEFT JOIN dim_date ON t.month_start = date_day
LEFT JOIN dim_salesperson s ON t.salesperson_id = s.salesperson_id"""

# ---------------------------------------------------------------- ledger

CTES["runs"] = f"""
SELECT o_orderkey AS run_id,
       CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN '{MASTER_PIPELINE}'
            ELSE '{SALES_PIPELINE}' END AS pipeline_name,
       'FactSales_' || o_custkey || '.csv' AS source_name,
       CASE WHEN o_orderpriority <> '4-NOT SPECIFIED'
            THEN md5(o_custkey || '|' || year(o_orderdate)) END AS source_hash,
       CASE WHEN o_orderpriority <> '4-NOT SPECIFIED' THEN o_custkey + 1000 END
         AS source_size_bytes,
       CASE WHEN o_orderpriority <> '4-NOT SPECIFIED' THEN CAST(o_orderdate AS TIMESTAMP)
            END AS source_modified_at,
       CAST(o_orderdate AS TIMESTAMP) AS started_at,
       CASE WHEN o_orderstatus <> 'O' AND o_orderpriority <> '5-LOW'
            THEN CAST(o_orderdate AS TIMESTAMP) + INTERVAL 1 HOUR END AS finished_at,
       CASE WHEN o_orderstatus = 'F' THEN CAST(floor(o_totalprice) AS BIGINT) ELSE 0 END
         AS records_received,
       CASE WHEN o_orderstatus = 'F' THEN CAST(floor(o_totalprice) AS BIGINT) ELSE 0 END
         AS records_inserted,
       CAST(0 AS BIGINT) AS records_rejected,
       CASE o_orderstatus WHEN 'F' THEN 'SUCCESS' WHEN 'P' THEN 'FAILED'
            ELSE 'RUNNING' END AS status,
       CASE WHEN o_orderstatus = 'P' THEN 'order ' || o_orderkey END AS error_message
FROM orders"""

CTES["active"] = """
SELECT pipeline_name, source_name, run_id AS active_run_id,
       source_hash AS active_source_hash, started_at AS last_observed_at
FROM runs WHERE status = 'SUCCESS' AND source_hash IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY pipeline_name, source_name
                           ORDER BY run_id DESC) = 1"""

CTES["found"] = f"""
SELECT '{SALES_PIPELINE}' AS pipeline_name, 'FactSales_' || c_custkey || '.csv' AS source_name, md5(c_custkey || '|1998') AS sha256,
       c_custkey + 2000 AS size_bytes, TIMESTAMP '2024-01-01 00:00:00' AS modified_at
FROM customer WHERE c_mktsegment <> 'BUILDING'"""

# ---------------------------------------------------------------- event contract


def _missing(fields: list[str], test: str) -> str:
    """The fields for which the test fails, printed as ['a', 'b']; NULL if none."""
    cases = ", ".join(f"CASE WHEN {test.format(f=f)} THEN '{f}' END" for f in fields)
    listed = f"array_to_string(list_filter([{cases}], lambda x: x IS NOT NULL), ''', ''')"
    return f"CASE WHEN {listed} <> '' THEN '[''' || {listed} || ''']' END"


def _contract(messages: str) -> str:
    tx = "json_extract_string(j, '$.transaction.{f}')"
    number = f"TRY_CAST({tx} AS DOUBLE)"
    faults = [
        ("UnprocessableEvent", "payload IS NULL", "'message has no value'"),
        ("JSONDecodeError", "j IS NULL", "'message is not JSON'"),
        ("EventValidationError", "absent IS NOT NULL", "'Missing event fields: ' || absent"),
        ("EventValidationError",
         f"json_extract_string(j, '$.event_type') IS DISTINCT FROM '{EVENT_TYPE}'",
         "'Unsupported event type: ' || json_extract_string(j, '$.event_type')"),
        ("EventValidationError", "json_type(j, '$.transaction') <> 'OBJECT'",
         "'transaction must be an object'"),
        ("EventValidationError", "blank IS NOT NULL",
         "'Missing transaction fields: ' || blank"),
        *[("EventValidationError", f"{number.format(f=f)} IS NULL",
           f"'Invalid numeric value for {f}: ' || {tx.format(f=f)}")
          for f in NUMERIC_FIELDS],
        ("UnprocessableEvent", f"NOT isfinite({number.format(f='quantity')})",
         "'quantity is not a finite number'"),
        ("EventValidationError", f"{number.format(f='quantity')} < 1",
         "'quantity must be greater than 0'"),
        *[("EventValidationError", f"{number.format(f=f)} < 0", f"'{f} cannot be negative'")
          for f in NON_NEGATIVE_FIELDS],
    ]
    types = " ".join(f"WHEN {c} THEN '{t}'" for t, c, _ in faults)
    texts = " ".join(f"WHEN {c} THEN {m}" for _, c, m in faults)
    absent = _missing(EVENT_FIELDS, "NOT json_exists(j, '$.{f}')")
    blank = _missing(TRANSACTION_FIELDS, f"coalesce({tx}, '') = ''")
    return f"""
SELECT *, CASE {types} END AS error_type, CASE {texts} END AS error_message
FROM (SELECT *, {absent} AS absent, {blank} AS blank
      FROM (SELECT *, CASE WHEN json_valid(payload) THEN CAST(payload AS JSON) END AS j
            FROM {messages}))"""


_AS_TEXT = {
    "date": "CAST(sales_date AS VARCHAR)",
    **{c: c for c in _IDS.split(", ")},
    "quantity": """CASE d WHEN '3R' THEN 'ABC' WHEN '3A' THEN '0' WHEN '5A' THEN '0.5'
        WHEN '5N' THEN '2.5' WHEN '7A' THEN 'NaN' ELSE CAST(quantity AS VARCHAR) END""",
    **{c: f"CAST({c} AS VARCHAR)" for c in _MONEY.split(", ")},
}
_AS_TEXT["net_sales"] = "CASE d WHEN '3N' THEN '-100' ELSE CAST(net_sales AS VARCHAR) END"
_AS_TEXT["unit_price"] = "CASE d WHEN '7N' THEN '1e3' ELSE CAST(unit_price AS VARCHAR) END"
_AS_TEXT["discount_pct"] = (
    "CASE d WHEN '2A' THEN '1d' ELSE CAST(discount_pct AS VARCHAR) END")
_AS_TEXT["invoice_id"] = "CASE WHEN d <> '4R' THEN invoice_id END"
_AS_TEXT["outlet_id"] = "CASE d WHEN '4R' THEN '' ELSE outlet_id END"
_AS_TEXT["product_id"] = "CASE d WHEN '7R' THEN ' ' ELSE product_id END"
_TX = ", ".join(f"'{f}', {_AS_TEXT[f]}" for f in TRANSACTION_FIELDS)
_ENVELOPE = f"""'event_id', 'E' || l_orderkey || '-' || l_partkey,
    'event_type', CASE d WHEN '5R' THEN 'inventory_transaction' ELSE '{EVENT_TYPE}' END,
    'event_timestamp', strftime(l_shipdate, '%Y-%m-%dT%H:%M:%S') || '+00:00'"""

CTES["defective"] = f"""
SELECT kafka_partition, kafka_offset, 'E' || l_orderkey || '-' || l_partkey AS event_id,
       CASE d WHEN '6R' THEN '{{bad' WHEN '6A' THEN '[]' WHEN '6N' THEN NULL
         WHEN '4N' THEN CAST(json_object({_ENVELOPE}) AS VARCHAR)
         WHEN '4A' THEN CAST(json_object({_ENVELOPE}, 'transaction', 'invalid') AS VARCHAR)
         ELSE CAST(json_object({_ENVELOPE}, 'transaction', json_object({_TX})) AS VARCHAR)
       END AS payload
FROM (SELECT *, l_linenumber || l_returnflag AS d FROM sold)"""

CTES["judged"] = _contract("defective")

CTES["envelopes"] = f"""
SELECT CAST(user_id AS VARCHAR) AS original_key, event_id AS kafka_offset,
  '{{"event_id":"EV' || event_id || '","event_type":"'
  || CASE event_type WHEN 'purchase' THEN '{EVENT_TYPE}' ELSE event_type END
  || '","event_timestamp":"'
  || regexp_replace(strftime(ts, '%Y-%m-%dT%H:%M:%S.%f'), '\\.000000$', '')
  || '+00:00","source":"web","transaction":{{"date":"' || CAST(CAST(ts AS DATE) AS VARCHAR)
  || '","distributor_id":"DST' || user_id || '","salesperson_id":"SP' || user_id
  || '","outlet_id":"OUT' || user_id || '","product_id":"P' || event_id
  || '","invoice_id":"INV' || event_id
  || '","quantity":' || json_extract_string(props, '$.k')
  || ',"unit_price":' || amount || ',"discount_pct":0,"discount_amount":0,"gross_sales":'
  || amount || ',"net_sales":' || CAST(amount - 5 AS DECIMAL(18,2))
  || ',"unit_cogs":' || amount || ',"total_cogs":' || amount || '}}}}' AS payload
FROM (SELECT *, CAST(value AS DECIMAL(18,2)) AS amount FROM events)"""

CTES["enveloped"] = _contract("envelopes")


#: Every line again in up to three revisions; see bindings.revision_messages.
_REVISED = f"""
SELECT sales_date, {_IDS}, CAST(quantity + 1 + rev AS INTEGER) AS quantity, {_MONEY},
       'streaming' AS record_source,
       'V-' || line || '-' || rev AS source_record_id,
       'revisions.csv' AS source_file,
       CAST(CAST(l_shipdate AS DATE)
            + CAST((l_linenumber + 2 * rev) % 3 AS INTEGER) AS TIMESTAMP)
         AS source_event_timestamp, rev
FROM sold, (SELECT 0 AS rev UNION ALL SELECT 1 UNION ALL SELECT 2)
WHERE rev < 2 OR l_returnflag = 'R'"""

_UNIFIED_REVISIONS = f"""
SELECT * FROM (
  SELECT {_BUSINESS}, 'batch' AS record_source,
         CAST(raw_record_id AS VARCHAR) AS source_record_id, source_file,
         CAST(NULL AS TIMESTAMP) AS source_event_timestamp, ingested_at, -1 AS rev
  FROM stg_sales
  UNION ALL
  SELECT {_BUSINESS}, record_source, source_record_id, source_file,
         source_event_timestamp, NULL, rev FROM ({_REVISED}))
QUALIFY row_number() OVER (
  PARTITION BY invoice_id, product_id
  ORDER BY rev < 0, source_event_timestamp DESC NULLS LAST, rev DESC, ingested_at DESC,
           source_record_id DESC) = 1"""


def select(final: str) -> str:
    chain = ",\n".join(f"{name} AS ({body})" for name, body in CTES.items())
    return f"WITH {chain}\n{final}"


def _tests_sql() -> str:
    """Every declared data test, one SELECT each."""
    parts = []

    def add(model: str, test: str, column: str | None, failing: str) -> None:
        name = f"'{column}'" if column else "CAST(NULL AS VARCHAR)"
        parts.append(f"SELECT '{model}' AS model, '{test}' AS test, {name} AS \"column\", "
                     f"CAST(count(*) AS BIGINT) AS failures FROM ({failing})")

    for model, columns in NOT_NULL.items():
        for c in columns:
            add(model, "not_null", c, f"SELECT 1 FROM {model} WHERE {c} IS NULL")
    for model, columns in UNIQUE.items():
        for c in columns:
            add(model, "unique", c, f"SELECT {c} FROM {model} WHERE {c} IS NOT NULL "
                                    f"GROUP BY {c} HAVING count(*) > 1")
    for model, columns in RELATIONSHIPS.items():
        for c, (parent, pc) in columns.items():
            add(model, "relationships", c,
                f"SELECT 1 FROM {model} a WHERE a.{c} IS NOT NULL AND NOT EXISTS "
                f"(SELECT 1 FROM {parent} b WHERE b.{pc} = a.{c})")
    for model, keys in GRAINS.items():
        k = ", ".join(keys)
        add(model, "grain", None, f"SELECT {k} FROM {model} GROUP BY {k} HAVING count(*) > 1")
    for staged, fact in SAME_COUNT:
        add(fact, "row_count", None,
            f"SELECT 1 WHERE (SELECT count(*) FROM {staged}) <> (SELECT count(*) FROM {fact})")
    add("fact_inventory", "balance", None,
        "SELECT 1 FROM fact_inventory WHERE closing_stock <> calculated_closing_stock")
    union = "\nUNION ALL ".join(parts)
    return (f"SELECT *, CASE WHEN failures = 0 THEN 'pass' ELSE 'fail' END AS status "
            f"FROM ({union})")


_LAYER_COUNTS = ", ".join(f"(SELECT count(*) FROM {t}) AS {n}" for n, t in [
    ("raw_sales", "lineitem"), ("staging_sales", "stg_sales"),
    ("raw_streaming_sales", "stg_sales_streaming"),
    ("staging_streaming_sales", "stg_sales_streaming"),
    ("unified_sales", "stg_sales_unified"), ("warehouse_sales", "fact_sales"),
    ("raw_inventory", "stock"), ("staging_inventory", "stg_inventory"),
    ("warehouse_inventory", "fact_inventory"), ("raw_target", "monthly"),
    ("staging_target", "stg_target"), ("warehouse_target", "fact_sales_target")])

_DONE = ("Batch, streaming, unified, and warehouse reconciliation completed successfully.")
_RAW_TEXT = ", ".join(
    f"{'sales_date' if c == 'date' else c}" if c.endswith("_id")
    else f"CAST({'sales_date' if c == 'date' else c} AS VARCHAR) AS {c}"
    for c in TRANSACTION_FIELDS)


def _profiles_sql() -> str:
    """Rows and the columns that have values, of each entity's staging table."""
    parts = []
    for sheet, feed in ENTITIES.items():
        filled = ", ".join(f"CASE WHEN count({feed.renamed.get(c, c)}) > 0 THEN '{c}' END"
                           for c in feed.raw_columns)
        parts.append(
            f"SELECT '{sheet}' AS entity, n AS \"rows\", CAST(len(f) AS INTEGER) AS column_count, "
            f"array_to_string(f, ', ') AS fields FROM (SELECT count(*) AS n, "
            f"list_filter([{filled}], lambda x: x IS NOT NULL) AS f FROM stg_{feed.table})")
    return "\nUNION ALL ".join(parts)


def _count_line(line: str, raw: str | None, staged: str | None, final: str | None) -> str:
    cells = [f"CAST({c or 'NULL'} AS BIGINT) AS {a}" for c, a in (
        (raw, "raw_rows"), (staged, "staging_rows"), (final, "warehouse_rows"))]
    return f"SELECT '{line}' AS line, {', '.join(cells)} FROM c"


def all_sql() -> dict[str, str]:
    models = [n for n in CTES if n.startswith(("stg_", "dim_", "fact_"))]
    out = {n: select(f"SELECT * FROM {n}") for n in models}
    report = " UNION ALL ".join([
        _count_line("Batch Sales", "raw_sales", "staging_sales", None),
        _count_line("Streaming Sales", "raw_streaming_sales", "staging_streaming_sales", None),
        _count_line("Unified Sales", None, "unified_sales", None),
        _count_line("Warehouse Sales", None, None, "warehouse_sales"),
        _count_line("Inventory", "raw_inventory", "staging_inventory", "warehouse_inventory"),
        _count_line("Target", "raw_target", "staging_target", "warehouse_target")])
    finals = {
        "run_ledger": "SELECT * FROM runs",
        "latest_versions": """
            SELECT pipeline_name, source_name, run_id, source_hash, source_size_bytes,
                   source_modified_at, started_at, finished_at
            FROM runs WHERE status = 'SUCCESS'
            QUALIFY row_number() OVER (PARTITION BY pipeline_name, source_name
              ORDER BY finished_at DESC NULLS FIRST, run_id DESC) = 1""",
        "seed_active": """
            SELECT pipeline_name, source_name, run_id AS active_run_id,
                   source_hash AS active_source_hash
            FROM runs WHERE status = 'SUCCESS' AND source_hash IS NOT NULL
            QUALIFY row_number() OVER (PARTITION BY pipeline_name, source_name
              ORDER BY finished_at DESC NULLS LAST, run_id DESC) = 1""",
        "active_state": "SELECT * FROM active",
        "skip_decisions": f"""
            SELECT f.pipeline_name, f.source_name, f.sha256, f.size_bytes, f.modified_at,
                   max(r.run_id) AS known_run,
                   CASE WHEN max(r.run_id) IS NULL THEN 'LOAD' ELSE 'SKIP' END AS decision
            FROM found f LEFT JOIN runs r ON r.source_name = f.source_name
              AND r.source_hash = f.sha256 AND r.status = 'SUCCESS'
              AND r.pipeline_name = '{SALES_PIPELINE}'
            GROUP BY 1, 2, 3, 4, 5""",
        "backfill_runs": """
            SELECT run_id, r.pipeline_name, r.source_name, sha256, size_bytes, modified_at,
                   CASE WHEN sha256 IS NULL THEN 'SKIP' ELSE 'UPDATE' END AS decision
            FROM runs r LEFT JOIN found f ON r.source_name = f.source_name
              AND r.pipeline_name = f.pipeline_name
            WHERE status = 'SUCCESS' AND source_hash IS NULL""",
        "current_raw_sales": f"""
            SELECT invoice_id, product_id, CAST(gross_sales AS VARCHAR) AS gross_sales,
                   CAST(l_linenumber AS BIGINT) AS source_row_number,
                   l_orderkey AS pipeline_run_id
            FROM sold JOIN active ON l_orderkey = active_run_id
            WHERE pipeline_name = '{SALES_PIPELINE}'""",
        "ledger_integrity": """
            SELECT l_orderkey AS run_id, count(*) AS row_count FROM lineitem
            WHERE l_orderkey NOT IN (SELECT run_id FROM runs WHERE status = 'SUCCESS')
            GROUP BY 1""",
        "event_contract": """
            SELECT kafka_partition AS "partition", kafka_offset AS "offset",
                   error_type, error_message FROM judged""",
        "event_contract_mixed": """
            SELECT kafka_offset AS "offset", payload, error_type, error_message
            FROM enveloped""",
        "dlq_events": """
            SELECT CAST(CAST(md5('sales.events/0/' || kafka_offset) AS UUID) AS VARCHAR)
                     AS dlq_event_id,
                   'sales-sink' AS consumer_group, 'sales.events' AS source_topic,
                   0 AS source_partition, kafka_offset AS source_offset, error_type,
                   error_message, original_key, payload AS original_payload
            FROM enveloped WHERE error_type IS NOT NULL""",
        "dedup_events": """
            SELECT event_id, kafka_topic, kafka_partition, kafka_offset
            FROM stg_sales_streaming""",
        "event_sink_state": """
            SELECT event_id, quantity, kafka_partition, kafka_offset
            FROM stg_sales_streaming""",
        "event_sink_index": """
            SELECT event_id, quantity, kafka_partition, kafka_offset FROM corrections
            QUALIFY row_number() OVER (PARTITION BY event_id
              ORDER BY l_linestatus DESC, kafka_partition, kafka_offset) = 1""",
        "event_sink_positions": """
            SELECT * FROM first_copies UNION ALL
            SELECT * FROM (
              SELECT event_id || '-b' AS event_id, quantity, kafka_partition,
                     kafka_offset - 1 AS kafka_offset
              FROM corrections WHERE copy = 1) r
            WHERE NOT EXISTS (SELECT 1 FROM first_copies f
              WHERE f.kafka_partition = r.kafka_partition AND f.kafka_offset = r.kafka_offset)
            QUALIFY row_number() OVER (PARTITION BY event_id
              ORDER BY kafka_partition, kafka_offset) = 1""",
        "event_sink_new_checkpoint": """
            SELECT event_id, quantity, kafka_partition, kafka_offset FROM corrections
            QUALIFY row_number() OVER (PARTITION BY event_id
              ORDER BY l_linestatus DESC, kafka_partition, kafka_offset) = 1""",
        "stream_counters": """
            SELECT CAST(count(*) AS BIGINT) AS processed,
                   count(DISTINCT CASE WHEN error_type IS NULL THEN event_id END) AS inserted,
                   count(CASE WHEN error_type IS NULL THEN 1 END)
                     - count(DISTINCT CASE WHEN error_type IS NULL THEN event_id END)
                     AS duplicates,
                   count(error_type) AS dead_letters
            FROM judged""",
        "entity_scan": """
            SELECT strftime(l_shipdate, '%Y-%m-%dT%H:%M:%S') AS month_start,
                   'DST' || l_suppkey AS distributor_id, 'P' || l_partkey AS product_id,
                   regexp_replace(CAST(CAST(l_quantity AS DOUBLE) AS VARCHAR), '\\.0$', '')
                     AS opening_stock,
                   regexp_replace(CAST(CAST(l_extendedprice AS DOUBLE) AS VARCHAR), '\\.0$', '')
                     AS stock_received,
                   CAST(CAST(l_orderkey AS BIGINT) * 1000000000 AS VARCHAR) AS units_sold,
                   rtrim(rtrim(CAST(CAST(l_linenumber AS DECIMAL(18,10)) * 0.0009765625
                     AS VARCHAR), '0'), '.') AS closing_stock,
                   CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) AS stock_value
            FROM lineitem""",
        "dedup_within_horizon": """
            SELECT CASE WHEN batch IN (2, 3) THEN 'M-' ELSE 'L-' END || line AS event_id,
                   TIMESTAMP '2024-01-01 00:00:00' + INTERVAL (day) DAY
                     + INTERVAL (batch) MINUTE AS event_timestamp,
                   CAST(line * 5 + batch AS BIGINT) AS kafka_offset
            FROM sold JOIN (VALUES (0, 0, NULL), (2, 10, 'A'), (3, 20, 'N'), (4, 30, 'R'))
              AS b(batch, day, flag) ON flag IS NULL OR flag = l_returnflag""",
        "audit_failed": f"""
            SELECT 'sales_batch' AS pipeline, 'lost' AS run_label,
                   COLUMNS(c.*) AS "\\0_rows",
                   'FAILED' AS validation_status,
                   'Inventory row counts do not match.' AS validation_message
            FROM (SELECT * REPLACE ((SELECT count(*) FROM fact_inventory
                    WHERE closing_stock = calculated_closing_stock) AS warehouse_inventory)
                  FROM (SELECT {_LAYER_COUNTS})) c""",
        "stream_sync_incremental": CTES["fact_sales"].replace(
            "FROM stg_sales_unified s", f"FROM ({_UNIFIED_REVISIONS}) s").replace(
            "SELECT md5", "SELECT * EXCLUDE (ingested_at, gross_margin_pct) FROM (SELECT md5", 1)
            + ")",
        "stream_sync_counts": f"""
            SELECT name, n AS held, n AS counted FROM (
              SELECT 'sales_events' AS name, count(*) AS n FROM ({_REVISED})
              UNION ALL SELECT 'stg_sales_streaming', count(*) FROM ({_REVISED})
              UNION ALL SELECT 'stg_sales_unified', count(*) FROM stg_sales_unified
              UNION ALL SELECT 'fact_sales', count(*) FROM stg_sales_unified)""",
        "sales_to_events": f"""
            SELECT invoice_id AS "key", '{EVENT_TYPE}' AS event_type, source_file,
                   {_RAW_TEXT} FROM stg_sales""",
        "ingest_sales": f"SELECT {_RAW_TEXT} FROM sold",
        "ingest_twice": """
            SELECT count(*) AS rows_loaded, count(*) AS rows_current,
                   count(*) AS distinct_records, true AS all_skipped FROM lineitem""",
        "grain_violations_sales": """
            SELECT invoice_id, product_id, count(*) AS row_count FROM stg_sales
            GROUP BY 1, 2 HAVING count(*) > 1""",
        "grain_violations_unified": """
            SELECT invoice_id, product_id, count(*) AS row_count FROM stg_sales_unified
            GROUP BY 1, 2 HAVING count(*) > 1""",
        "grain_violations_inventory": """
            SELECT month_start, distributor_id, product_id, count(*) AS row_count
            FROM stg_inventory GROUP BY 1, 2, 3 HAVING count(*) > 1""",
        "inventory_imbalance": """
            SELECT inventory_key, opening_stock, stock_received, units_sold, closing_stock,
                   calculated_closing_stock
            FROM fact_inventory WHERE closing_stock <> calculated_closing_stock""",
        "unique_violations": """
            SELECT 'unique' AS test, 'raw_record_id' AS "column", count(*) AS failures
            FROM (SELECT 1 FROM stg_sales GROUP BY raw_record_id HAVING count(*) > 1)
            UNION ALL
            SELECT 'unique', 'invoice_id', count(*)
            FROM (SELECT 1 FROM stg_sales GROUP BY invoice_id HAVING count(*) > 1)""",
        "null_counts": """
            SELECT 'not_null' AS test, 'product_id' AS "column",
                   count(*) - count(product_id) AS failures FROM stg_product
            UNION ALL SELECT 'not_null', 'variant', count(*) - count(variant)
            FROM stg_product""",
        "orphans": """
            SELECT 'relationships' AS test, 'outlet_id' AS "column", count(*) AS failures
            FROM stg_sales WHERE outlet_id NOT IN
              (SELECT outlet_id FROM stg_outlet WHERE channel = 'BUILDING')
            UNION ALL
            SELECT 'relationships', 'distributor_id', count(*) FROM stg_sales
            WHERE distributor_id NOT IN (SELECT distributor_id FROM stg_distributor)""",
        "row_count_pairs": """
            SELECT (SELECT count(*) FROM stg_sales) AS staging_rows,
                   (SELECT count(*) FROM fact_sales) AS warehouse_rows
            WHERE (SELECT count(*) FROM stg_sales) <> (SELECT count(*) FROM fact_sales)""",
        "run_tests": _tests_sql(),
        "reconcile": f"""
            SELECT *, 'SUCCESS' AS validation_status, '{_DONE}' AS validation_message
            FROM (SELECT {_LAYER_COUNTS})""",
        "count_report": f"SELECT * FROM (WITH c AS (SELECT {_LAYER_COUNTS}) {report})",
        "profile_entities": _profiles_sql(),
        "gross_margin": """
            SELECT md5('sales|' || invoice_id || '|' || product_id) AS sales_key,
                   CASE WHEN net_sales <> 0 THEN CAST(floor(
                     CAST((net_sales - total_cogs) * 1000000 AS DOUBLE)
                     / CAST(net_sales AS DOUBLE)) AS BIGINT) END AS margin_millionths
            FROM stg_sales_unified""",
        "profile_files": """
            SELECT count(*) AS "rows", 14 AS column_count, true AS same_schema
            FROM lineitem""",
    }
    out.update({name: select(final) for name, final in finals.items()})
    return out
