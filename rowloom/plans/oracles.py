"""The queries in SQL, over the same tables and with the same rules."""

from __future__ import annotations

# ---- inputs

CUSTOMER_DELTA = """
customer_delta AS (
  SELECT c_custkey, c_name, c_nationkey, c_acctbal,
         CASE WHEN c_custkey % 13 = 0 THEN NULL WHEN c_custkey % 7 = 0 THEN 'CHANGED' ELSE c_mktsegment END AS c_mktsegment
  FROM customer WHERE c_custkey % 10 <> 0
  UNION ALL
  SELECT -c_custkey - 1, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer WHERE c_custkey % 50 = 0
)"""

CUSTOMER_DIMENSION = """
dimension AS (
  SELECT *, '2024-01-01' AS eff_dt, '9999-12-31' AS end_dt, 'Y' AS act_in FROM customer
  UNION ALL
  SELECT c_custkey, c_name, c_nationkey, c_acctbal, 'BEFORE', '2023-01-01', '2024-01-01', 'N'
  FROM customer WHERE c_custkey % 9 = 0
)"""

ORDER_SIDES = """
master AS (SELECT o_orderkey, o_custkey, o_orderstatus, o_orderpriority, o_totalprice FROM orders),
delta AS (
  SELECT o_orderkey, o_custkey,
         CASE WHEN o_orderkey % 7 = 0 THEN 'X' ELSE o_orderstatus END AS o_orderstatus,
         CASE WHEN o_orderkey % 13 <> 0 THEN o_orderpriority END AS o_orderpriority,
         CASE WHEN o_orderkey % 17 = 0 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice
  FROM orders WHERE o_orderkey % 11 <> 0
  UNION ALL
  SELECT -o_orderkey - 1, o_custkey, o_orderstatus, o_orderpriority, o_totalprice FROM orders WHERE o_orderkey % 40 = 0
)"""

ORDER_CLASSES = """
classified AS (
  SELECT coalesce(m.o_orderkey, d.o_orderkey) AS o_orderkey,
         CASE WHEN m.o_orderkey IS NULL THEN 'N' WHEN d.o_orderkey IS NULL THEN 'D'
              WHEN m.o_orderstatus IS NOT DISTINCT FROM d.o_orderstatus
               AND m.o_orderpriority IS NOT DISTINCT FROM d.o_orderpriority
               AND m.o_totalprice IS NOT DISTINCT FROM d.o_totalprice THEN 'C' ELSE 'U' END AS status,
         m.o_orderstatus AS old_status, d.o_orderstatus AS new_status,
         m.o_totalprice AS old_price, d.o_totalprice AS new_price
  FROM master m FULL JOIN delta d ON m.o_orderkey = d.o_orderkey
)"""

LINE_SIDES = """
lines AS (SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, l_returnflag, l_linestatus FROM lineitem),
line_changes AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_quantity,
         CASE WHEN l_partkey % 7 = 0 THEN 'X' ELSE l_returnflag END AS l_returnflag, l_linestatus
  FROM lineitem WHERE l_orderkey % 10 <> 0
  UNION ALL
  SELECT -l_orderkey - 1, l_linenumber, l_partkey, l_quantity, l_returnflag, l_linestatus
  FROM lineitem WHERE l_orderkey % 25 = 0
)"""

# rows of keys that occur once on both sides are paired, all others stand alone
LINE_CLASSES = f"""
{LINE_SIDES},
copies AS (
  SELECT l_orderkey, l_linenumber, sum(m) AS n_m, sum(d) AS n_d FROM (
    SELECT l_orderkey, l_linenumber, 1 AS m, 0 AS d FROM lines
    UNION ALL SELECT l_orderkey, l_linenumber, 0, 1 FROM line_changes)
  GROUP BY ALL
),
m AS (SELECT l.*, n_m, n_d FROM lines l JOIN copies USING (l_orderkey, l_linenumber)),
d AS (SELECT l.*, n_m, n_d FROM line_changes l JOIN copies USING (l_orderkey, l_linenumber)),
classified AS (
  SELECT m.l_orderkey, m.l_linenumber, CASE WHEN m.l_returnflag = d.l_returnflag THEN 'C' ELSE 'U' END AS status,
         m.l_partkey AS m_partkey, m.l_quantity AS m_quantity, m.l_returnflag AS m_flag,
         d.l_partkey AS d_partkey, d.l_quantity AS d_quantity, d.l_returnflag AS d_flag
  FROM m JOIN d USING (l_orderkey, l_linenumber) WHERE m.n_m = 1 AND m.n_d = 1
  UNION ALL
  SELECT l_orderkey, l_linenumber, CASE WHEN n_d = 0 THEN 'D' ELSE 'R' END,
         l_partkey, l_quantity, l_returnflag, NULL, NULL, NULL
  FROM m WHERE NOT (n_m = 1 AND n_d = 1)
  UNION ALL
  SELECT l_orderkey, l_linenumber, CASE WHEN n_m = 0 AND n_d = 1 THEN 'N' ELSE 'R' END,
         NULL, NULL, NULL, l_partkey, l_quantity, l_returnflag
  FROM d WHERE NOT (n_m = 1 AND n_d = 1)
)"""

LANDED = """
landed AS (
  SELECT o_orderkey AS Sale_ID, o_custkey AS Product_ID,
         CASE WHEN o_orderkey % 4 <> 0 THEN o_custkey % 50 END AS Quantity_Sold,
         CASE WHEN o_orderkey % 6 <> 0 THEN o_orderpriority END AS Vendor_ID
  FROM orders
)"""

REPAIRED = f"""
{LANDED},
held AS (SELECT * FROM landed WHERE Quantity_Sold IS NULL OR Vendor_ID IS NULL),
today AS (
  SELECT o_orderkey AS Sale_ID, o_custkey AS Product_ID,
         CASE WHEN o_orderkey % 8 <> 0 THEN o_custkey % 50 + 100 END AS Quantity_Sold,
         CASE WHEN o_orderkey % 7 <> 0 THEN 'today ' || o_orderpriority END AS Vendor_ID
  FROM orders WHERE o_orderkey % 5 <> 0
),
repaired AS (
  SELECT t.Sale_ID, t.Product_ID, coalesce(t.Quantity_Sold, h.Quantity_Sold) AS Quantity_Sold,
         coalesce(t.Vendor_ID, h.Vendor_ID) AS Vendor_ID
  FROM today t LEFT JOIN held h ON t.Sale_ID = h.Sale_ID
)"""
REPAIRED_VALID = "SELECT * FROM repaired WHERE Quantity_Sold IS NOT NULL AND Vendor_ID IS NOT NULL"
REPAIRED_HOLD = """
SELECT * FROM repaired WHERE Quantity_Sold IS NULL OR Vendor_ID IS NULL
UNION ALL SELECT * FROM held WHERE Sale_ID NOT IN (SELECT Sale_ID FROM today)"""

QUANTITY_TEXT = "CAST(Quantity_Sold AS VARCHAR) AS Quantity_Sold"

PRODUCTS = """
known AS (
  SELECT p_partkey AS Product_ID, p_name AS Product_Name, p_retailprice AS Product_Price
  FROM part WHERE p_partkey % 5 <> 0
),
once AS (SELECT * FROM known WHERE Product_ID % 11 <> 0)"""

LOADS = """
daily AS (SELECT event_id, user_id, event_type, value, CAST(ts AS DATE) AS event_date FROM events),
corrected AS (
  SELECT event_id, user_id, event_type, value + 1000 AS value, event_date FROM daily WHERE day(event_date) % 2 = 0
),
late AS (SELECT -event_id - 1 AS event_id, user_id, event_type, value, event_date FROM daily WHERE event_id % 5 = 0),
second_state AS (SELECT * FROM daily WHERE day(event_date) % 2 <> 0 UNION ALL SELECT * FROM corrected),
third_state AS (SELECT * FROM second_state UNION ALL SELECT * FROM late)"""
EVENT_COLUMNS = "event_id, user_id, event_type, value, CAST(event_date AS VARCHAR) AS event_date"


def merged(dimension: str, delta: str, run: str, key: str, compare: list[str], missing: str = "keep") -> str:
    """The dimension after a merge, for keys that are unique on both sides."""
    same = " AND ".join(f"m.{c} IS NOT DISTINCT FROM d.{c}" for c in compare)
    attributes = "c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment"
    from_master = ", ".join(f"m.{c}" for c in attributes.split(", "))
    from_delta = ", ".join(f"d.{c}" for c in attributes.split(", "))
    gone = f"'{run}', 'N'" if missing == "expire" else "m.end_dt, m.act_in"
    active = f"(SELECT * FROM {dimension} WHERE act_in = 'Y')"
    on = " AND ".join(f"m.{k} = d.{k}" for k in key.split(", "))
    return f"""
  SELECT * FROM {dimension} WHERE act_in <> 'Y'
  UNION ALL
  SELECT m.* FROM {active} m JOIN {delta} d ON {on} WHERE {same}
  UNION ALL
  SELECT {from_master}, m.eff_dt, '{run}', 'N' FROM {active} m JOIN {delta} d ON {on} WHERE NOT ({same})
  UNION ALL
  SELECT {from_delta}, '{run}', '9999-12-31', 'Y' FROM {active} m JOIN {delta} d ON {on} WHERE NOT ({same})
  UNION ALL
  SELECT {from_delta}, '{run}', '9999-12-31', 'Y' FROM {delta} d
  WHERE NOT EXISTS (SELECT 1 FROM {active} m WHERE {on})
  UNION ALL
  SELECT {from_master}, m.eff_dt, {gone} FROM {active} m WHERE NOT EXISTS (SELECT 1 FROM {delta} d WHERE {on})
"""


FIRST_MERGE = merged("dimension", "customer_delta", "2024-12-01", "c_custkey", ["c_mktsegment"])
SECOND_MERGE = merged("first_state", "customer", "2025-03-01", "c_custkey", ["c_mktsegment"])
AFTER_SECOND = f"{CUSTOMER_DELTA}, {CUSTOMER_DIMENSION}, first_state AS ({FIRST_MERGE}), second_merge AS ({SECOND_MERGE})"

ORACLES: dict[str, str] = {}

# ---- changes

ORACLES["classify_changes"] = f"""
WITH {CUSTOMER_DELTA}
SELECT coalesce(m.c_custkey, d.c_custkey) AS c_custkey,
       CASE WHEN m.c_custkey IS NULL THEN 'N' WHEN d.c_custkey IS NULL THEN 'D'
            WHEN m.c_mktsegment IS NOT DISTINCT FROM d.c_mktsegment THEN 'C' ELSE 'U' END AS status,
       m.c_mktsegment AS old_segment, d.c_mktsegment AS new_segment
FROM customer m FULL JOIN customer_delta d ON m.c_custkey = d.c_custkey"""

ORACLES["classify_orders"] = f"WITH {ORDER_SIDES}, {ORDER_CLASSES} SELECT * FROM classified"

ORACLES["classify_repeated_keys"] = f"""
WITH {LINE_CLASSES}
SELECT l_orderkey, l_linenumber, status, CAST(m_partkey AS VARCHAR) AS old_part, CAST(d_partkey AS VARCHAR) AS new_part
FROM classified"""

ORACLES["rejected_rows"] = f"""
WITH {LINE_CLASSES}
SELECT l_orderkey, l_linenumber, coalesce(m_partkey, d_partkey) AS l_partkey,
       coalesce(m_quantity, d_quantity) AS l_quantity, coalesce(m_flag, d_flag) AS l_returnflag,
       CASE WHEN m_partkey IS NULL THEN 'delta' ELSE 'master' END AS side
FROM classified WHERE status = 'R'"""

ORACLES["change_summary"] = f"""
WITH {ORDER_SIDES}, {ORDER_CLASSES} SELECT status, count(*) AS n_rows FROM classified GROUP BY status"""

ORACLES["control_total"] = f"""
WITH {LINE_CLASSES}
SELECT (SELECT count(*) FROM lines) AS master_rows, (SELECT count(*) FROM line_changes) AS delta_rows,
       count(*) FILTER (status = 'C') AS common_rows, count(*) FILTER (status = 'N') AS new_rows,
       count(*) FILTER (status = 'U') AS updated_rows, count(*) FILTER (status = 'D') AS deleted_rows,
       count(*) FILTER (status = 'R' AND m_partkey IS NOT NULL) AS rejected_master_rows,
       count(*) FILTER (status = 'R' AND m_partkey IS NULL) AS rejected_delta_rows,
       TRUE AS balanced
FROM classified"""

ORACLES["control_total_written"] = f"""
WITH {LINE_CLASSES}
SELECT count(*) AS n_rows,
       count(*) FILTER (m_partkey IS NOT NULL) AS master_rows, count(*) FILTER (d_partkey IS NOT NULL) AS delta_rows,
       count(*) FILTER (status = 'C') AS common_rows, count(*) FILTER (status = 'N') AS new_rows,
       count(*) FILTER (status = 'U') AS updated_rows, count(*) FILTER (status = 'D') AS deleted_rows,
       count(*) FILTER (status = 'R' AND m_partkey IS NOT NULL) AS rejected_master_rows,
       count(*) FILTER (status = 'R' AND m_partkey IS NULL) AS rejected_delta_rows
FROM classified"""

# ---- dimensions

ORACLES["scd2_single"] = f"WITH {CUSTOMER_DELTA}, {CUSTOMER_DIMENSION} {FIRST_MERGE}"
ORACLES["scd2_replay"] = ORACLES["scd2_single"]
ORACLES["scd2_composite"] = f"WITH {CUSTOMER_DELTA}, {CUSTOMER_DIMENSION} " + merged(
    "dimension",
    "customer_delta",
    "2024-12-01",
    "c_custkey, c_name",
    ["c_nationkey", "c_acctbal", "c_mktsegment"],
    missing="expire",
)
ORACLES["scd2_second_load"] = f"WITH {AFTER_SECOND} SELECT * FROM second_merge"
ORACLES["scd2_repeated_keys"] = f"""
WITH {LINE_CLASSES}
SELECT l_orderkey, l_linenumber, m_partkey AS l_partkey, m_quantity AS l_quantity, m_flag AS l_returnflag,
       '2024-01-01' AS eff_dt, CASE WHEN status = 'U' THEN '2024-12-01' ELSE '9999-12-31' END AS end_dt,
       CASE WHEN status = 'U' THEN 'N' ELSE 'Y' END AS act_in
FROM classified WHERE m_partkey IS NOT NULL
UNION ALL
SELECT l_orderkey, l_linenumber, d_partkey, d_quantity, d_flag, '2024-12-01', '9999-12-31', 'Y'
FROM classified WHERE status IN ('N', 'U')"""
# in the right order of days: the first extract, then the later one
ORACLES["scd2_history_insert"] = f"""
WITH {CUSTOMER_DELTA},
opened AS (SELECT *, '2024-01-01' AS eff_dt, '9999-12-31' AS end_dt, 'Y' AS act_in FROM customer),
later AS (SELECT * REPLACE (CASE WHEN c_custkey % 7 = 0 THEN 'LATER' ELSE c_mktsegment END AS c_mktsegment) FROM customer),
first_state AS ({merged("opened", "customer_delta", "2024-12-01", "c_custkey", ["c_mktsegment"], missing="expire")}),
second_state AS ({merged("first_state", "later", "2025-03-01", "c_custkey", ["c_mktsegment"], missing="expire")})
SELECT * FROM second_state"""

# what each customer looked like on each day, and the days on which that began and ended
ORACLES["scd2_many_extracts"] = f"""
WITH {CUSTOMER_DIMENSION},
days AS (SELECT unnest(range(0, 30)) AS n),
extracts AS (
  SELECT c_custkey, c_name, c_nationkey, c_acctbal, n,
         CASE WHEN (c_custkey + n) % 11 = 0 THEN NULL WHEN (c_custkey * 7 + n) % 9 < 2 THEN 'CHANGED' ELSE c_mktsegment END AS c_mktsegment
  FROM customer, days WHERE (c_custkey * 3 + n) % 13 <> 0
  UNION ALL
  SELECT -c_custkey - 1, c_name, c_nationkey, c_acctbal, n, c_mktsegment
  FROM customer, days WHERE c_custkey % 40 = 0 AND n % 4 <> 1),
seen AS (  -- the day before the first extract is the version that was open then
  SELECT * FROM extracts UNION ALL SELECT c_custkey, c_name, c_nationkey, c_acctbal, -1, c_mktsegment FROM customer),
marked AS (
  SELECT *, CASE WHEN lag(n) OVER k IS DISTINCT FROM n - 1 OR lag(c_mktsegment) OVER k IS DISTINCT FROM c_mktsegment
                 THEN 1 ELSE 0 END AS begins
  FROM seen WINDOW k AS (PARTITION BY c_custkey ORDER BY n)),
numbered AS (SELECT *, sum(begins) OVER (PARTITION BY c_custkey ORDER BY n) AS island FROM marked),
spans AS (
  SELECT c_custkey, min(c_name) AS c_name, min(c_nationkey) AS c_nationkey, min(c_acctbal) AS c_acctbal,
         min(c_mktsegment) AS c_mktsegment, min(n) AS first_n, max(n) AS last_n
  FROM numbered GROUP BY c_custkey, island)
SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment,
       CASE WHEN first_n < 0 THEN '2024-01-01' ELSE CAST(DATE '2024-06-01' + first_n::INT AS VARCHAR) END AS eff_dt,
       CASE WHEN last_n = 29 THEN '9999-12-31' ELSE CAST(DATE '2024-06-01' + (last_n + 1)::INT AS VARCHAR) END AS end_dt,
       CASE WHEN last_n = 29 THEN 'Y' ELSE 'N' END AS act_in
FROM spans
UNION ALL SELECT * FROM dimension WHERE act_in = 'N'"""

ORACLES["latest_version"] = f"""
WITH {AFTER_SECOND}
SELECT * FROM second_merge
QUALIFY row_number() OVER (PARTITION BY c_custkey, act_in ORDER BY eff_dt DESC, end_dt DESC) = 1"""
ORACLES["scd2_as_of"] = f"""
WITH {AFTER_SECOND} SELECT * FROM second_merge WHERE eff_dt <= '2024-12-01' AND '2024-12-01' < end_dt"""

# ---- change data capture

OPEN_END = "'9999-12-31 23:59:00'"

ORACLES["cdc_initial"] = f"""
WITH {ORDER_SIDES}
SELECT *, '2024-01-01 00:00:00' AS eff_start_date, {OPEN_END} AS eff_end_date FROM master"""

ORACLES["cdc_merge"] = f"""
WITH {ORDER_SIDES}, {ORDER_CLASSES}
SELECT d.*, CASE WHEN c.status = 'C' THEN '2024-01-01 00:00:00' ELSE '2024-12-01 00:00:00' END AS eff_start_date,
       {OPEN_END} AS eff_end_date
FROM delta d JOIN classified c ON d.o_orderkey = c.o_orderkey"""

ORACLES["cdc_deleted"] = f"""
WITH {ORDER_SIDES} SELECT * FROM master m WHERE NOT EXISTS (SELECT 1 FROM delta d WHERE d.o_orderkey = m.o_orderkey)"""

ORACLES["cdc_outcome"] = f"""
WITH {LINE_CLASSES}
SELECT l_orderkey, l_linenumber,
       CASE WHEN status IN ('N', 'U') OR m_partkey IS NULL THEN d_partkey ELSE m_partkey END AS l_partkey,
       CASE WHEN status IN ('N', 'U') OR m_partkey IS NULL THEN d_quantity ELSE m_quantity END AS l_quantity,
       CASE WHEN status IN ('N', 'U') OR m_partkey IS NULL THEN d_flag ELSE m_flag END AS l_returnflag,
       CASE WHEN status IN ('N', 'U') THEN '2024-12-01 00:00:00' WHEN m_partkey IS NOT NULL THEN '2024-01-01 00:00:00' END
         AS eff_start_date,
       CASE WHEN status IN ('N', 'U') OR m_partkey IS NOT NULL THEN {OPEN_END} END AS eff_end_date,
       CASE WHEN status IN ('N', 'U', 'C') THEN 'current' WHEN status = 'D' THEN 'deleted'
            WHEN m_partkey IS NOT NULL THEN 'current' ELSE 'rejected' END AS outcome
FROM classified"""

# ---- reconciliation

ORACLES["reconcile_presence"] = f"""
WITH {ORDER_SIDES}
SELECT o_orderkey, o_custkey, o_orderstatus, o_orderpriority, 'left' AS side, 'left_only' AS presence
FROM master m WHERE NOT EXISTS (SELECT 1 FROM delta d WHERE d.o_orderkey = m.o_orderkey)
UNION ALL
SELECT o_orderkey, o_custkey, o_orderstatus, o_orderpriority, 'right', 'right_only'
FROM delta d WHERE NOT EXISTS (SELECT 1 FROM master m WHERE d.o_orderkey = m.o_orderkey)"""

ORACLES["reconcile_presence_repeated"] = f"""
WITH {LINE_CLASSES}
SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, l_returnflag, 'left' AS side,
       CASE WHEN n_d = 0 THEN 'left_only' ELSE 'repeated_key' END AS presence
FROM m WHERE NOT (n_m = 1 AND n_d = 1)
UNION ALL
SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, l_returnflag, 'right',
       CASE WHEN n_m = 0 THEN 'right_only' ELSE 'repeated_key' END
FROM d WHERE NOT (n_m = 1 AND n_d = 1)"""

PRICE_TEXT = "CAST(CAST({} AS DECIMAL(18,2)) AS VARCHAR)"
M_PRICE, D_PRICE = PRICE_TEXT.format("m.o_totalprice"), PRICE_TEXT.format("d.o_totalprice")

ORACLES["reconcile_wide"] = f"""
WITH {ORDER_SIDES}
SELECT * FROM (
  SELECT m.o_orderkey,
         CASE WHEN m.o_orderstatus IS DISTINCT FROM d.o_orderstatus
              THEN coalesce(m.o_orderstatus, 'null') || ' vs ' || coalesce(d.o_orderstatus, 'null') END AS o_orderstatus_mismatch,
         CASE WHEN m.o_orderpriority IS DISTINCT FROM d.o_orderpriority
              THEN coalesce(m.o_orderpriority, 'null') || ' vs ' || coalesce(d.o_orderpriority, 'null') END AS o_orderpriority_mismatch,
         CASE WHEN {M_PRICE} IS DISTINCT FROM {D_PRICE} THEN {M_PRICE} || ' vs ' || {D_PRICE} END AS o_totalprice_mismatch
  FROM master m JOIN delta d ON m.o_orderkey = d.o_orderkey)
WHERE coalesce(o_orderstatus_mismatch, o_orderpriority_mismatch, o_totalprice_mismatch) IS NOT NULL"""

ORACLES["reconcile_long"] = f"""
WITH {ORDER_SIDES}, pairs AS (
  SELECT m.o_orderkey, m.o_orderstatus AS s1, d.o_orderstatus AS s2, m.o_orderpriority AS p1, d.o_orderpriority AS p2,
         {M_PRICE} AS t1, {D_PRICE} AS t2
  FROM master m JOIN delta d ON m.o_orderkey = d.o_orderkey)
SELECT o_orderkey, 'o_orderstatus' AS mismatched_col_name, s1 AS value_from_t1, s2 AS value_from_t2
FROM pairs WHERE s1 IS DISTINCT FROM s2
UNION ALL SELECT o_orderkey, 'o_orderpriority', p1, p2 FROM pairs WHERE p1 IS DISTINCT FROM p2
UNION ALL SELECT o_orderkey, 'o_totalprice', t1, t2 FROM pairs WHERE t1 IS DISTINCT FROM t2"""

ORACLES["reconcile_long_active"] = f"""
WITH {ORDER_SIDES}, pairs AS (
  SELECT m.o_orderkey, m.o_custkey, m.o_orderstatus AS s1, d.o_orderstatus AS s2, m.o_orderpriority AS p1, d.o_orderpriority AS p2
  FROM master m JOIN delta d ON m.o_orderkey = d.o_orderkey AND m.o_custkey = d.o_custkey
  WHERE m.o_custkey % 3 <> 0)
SELECT o_orderkey, o_custkey, 'o_orderstatus' AS mismatched_col_name, s1 AS value_from_t1, s2 AS value_from_t2
FROM pairs WHERE s1 IS DISTINCT FROM s2
UNION ALL SELECT o_orderkey, o_custkey, 'o_orderpriority', p1, p2 FROM pairs WHERE p1 IS DISTINCT FROM p2"""

ORACLES["missing_rows"] = f"""
WITH {LINE_SIDES}
SELECT l_orderkey, l_returnflag, l_linestatus FROM lines
EXCEPT SELECT l_orderkey, l_returnflag, l_linestatus FROM line_changes"""

ORACLES["reconcile_rows"] = f"""
WITH {ORDER_SIDES}
SELECT *, 'TARGET' AS "MISSING_FROM" FROM (SELECT * FROM master EXCEPT SELECT * FROM delta)
UNION ALL
SELECT *, 'SOURCE' FROM (SELECT * FROM delta EXCEPT SELECT * FROM master)"""

ORACLES["rows_without_equal"] = f"""
WITH {LINE_SIDES}
SELECT l_orderkey, l_returnflag, l_linestatus FROM lines a
WHERE NOT EXISTS (
  SELECT 1 FROM line_changes b
  WHERE a.l_orderkey = b.l_orderkey AND a.l_returnflag = b.l_returnflag AND a.l_linestatus = b.l_linestatus)"""

# ---- daily ingestion

ORACLES["split_valid"] = f"""
WITH {LANDED} SELECT * FROM landed WHERE Quantity_Sold IS NOT NULL AND Vendor_ID IS NOT NULL"""
ORACLES["split_hold"] = f"""
WITH {LANDED} SELECT * REPLACE ({QUANTITY_TEXT}) FROM landed WHERE Quantity_Sold IS NULL OR Vendor_ID IS NULL"""
ORACLES["repair_valid"] = f"WITH {REPAIRED} {REPAIRED_VALID}"
ORACLES["repair_hold"] = f"WITH {REPAIRED} SELECT * REPLACE ({QUANTITY_TEXT}) FROM ({REPAIRED_HOLD})"
ORACLES["ingest_next_day"] = f"""
WITH {REPAIRED}
SELECT * REPLACE ({QUANTITY_TEXT}), 'valid' AS part FROM ({REPAIRED_VALID})
UNION ALL SELECT * REPLACE ({QUANTITY_TEXT}), 'hold' FROM ({REPAIRED_HOLD})"""
ORACLES["repair_repeated_keys"] = f"""
WITH landed AS (
  SELECT l_orderkey AS Sale_ID, l_partkey AS Product_ID, CASE WHEN l_partkey % 4 <> 0 THEN l_quantity END AS Quantity_Sold,
         CASE WHEN l_partkey % 6 <> 0 THEN CAST(l_suppkey AS VARCHAR) END AS Vendor_ID
  FROM lineitem),
held AS (SELECT * FROM landed WHERE Quantity_Sold IS NULL OR Vendor_ID IS NULL),
fill AS (SELECT Sale_ID, max(Quantity_Sold) AS q, max(Vendor_ID) AS v FROM held GROUP BY Sale_ID),
today AS (
  SELECT l_orderkey AS Sale_ID, l_partkey AS Product_ID, CASE WHEN l_partkey % 3 <> 0 THEN l_quantity END AS Quantity_Sold,
         CASE WHEN l_partkey % 7 <> 0 THEN CAST(l_suppkey AS VARCHAR) END AS Vendor_ID
  FROM lineitem WHERE l_orderkey % 5 <> 0),
repaired AS (
  SELECT t.Sale_ID, t.Product_ID, coalesce(t.Quantity_Sold, f.q) AS Quantity_Sold, coalesce(t.Vendor_ID, f.v) AS Vendor_ID
  FROM today t LEFT JOIN fill f ON t.Sale_ID = f.Sale_ID)
SELECT *, 'valid' AS part FROM ({REPAIRED_VALID}) UNION ALL SELECT *, 'hold' FROM ({REPAIRED_HOLD})"""

ORACLES["enrich_sales"] = f"""
WITH {PRODUCTS}
SELECT l_orderkey AS Sale_ID, l_partkey AS Product_ID, l_quantity AS Quantity_Sold, Product_Name, Product_Price,
       Product_Price * l_quantity AS Sale_Amount
FROM lineitem JOIN once ON l_partkey = Product_ID"""
ORACLES["enrich_unmatched"] = f"""
WITH {PRODUCTS}
SELECT l_orderkey AS Sale_ID, l_partkey AS Product_ID, l_quantity AS Quantity_Sold,
       CASE WHEN l_partkey IN (SELECT Product_ID FROM known) THEN 'ambiguous_product' ELSE 'unknown_product' END AS reason
FROM lineitem WHERE l_partkey NOT IN (SELECT Product_ID FROM once)"""

ORACLES["expected_count_check"] = """
WITH actual AS (
  SELECT 'orders.parquet' AS file_name, count(*) AS n FROM orders UNION ALL SELECT 'lineitem.parquet', count(*) FROM lineitem
  UNION ALL SELECT 'supplier.parquet', count(*) FROM supplier UNION ALL SELECT 'part.parquet', count(*) FROM part),
control AS (
  SELECT 'orders.parquet' AS file_name, count(*) * 10 AS n FROM customer
  UNION ALL SELECT 'lineitem.parquet', count(*) * 4 FROM orders
  UNION ALL SELECT 'supplier.parquet', count(*) FROM part UNION ALL SELECT 'returns.parquet', count(*) FROM events)
SELECT coalesce(c.file_name, a.file_name) AS file_name, CAST(c.n AS VARCHAR) AS expected_rows, CAST(a.n AS VARCHAR) AS actual_rows,
       CASE WHEN a.n IS NULL THEN 'missing' WHEN c.n IS NULL THEN 'unexpected' WHEN a.n = c.n THEN 'match' ELSE 'mismatch' END
         AS status
FROM control c FULL JOIN actual a ON c.file_name = a.file_name"""

# ---- cleansing

# two-digit years are years of this century
SHORT_YEAR_DAY = "'20' || strftime(o_orderdate, '%y-%m-%d')"

ORACLES["clean_statement"] = f"""
SELECT o_orderkey AS "AccountNo",
       CASE WHEN o_orderkey % 9 <> 0 THEN o_totalprice ELSE 0.0 END AS "WITHDRAWALAMT",
       CASE WHEN o_orderkey % 11 <> 0 THEN o_totalprice END AS "DEPOSITAMT",
       o_totalprice AS "BALANCEAMT",
       CASE WHEN o_orderkey % 6 <> 0 THEN {SHORT_YEAR_DAY} END AS "DATE",
       {SHORT_YEAR_DAY} AS "VALUEDATE",
       concat_ws(',', CASE WHEN o_orderkey % 11 = 0 THEN 'DEPOSITAMT' END, CASE WHEN o_orderkey % 6 = 0 THEN 'DATE' END)
         AS unparsed
FROM orders"""

ORACLES["clean_users"] = """
SELECT c_name AS "FNAME", '040' || c_nationkey || c_custkey AS "PHONE", TRUE AS "US_CITIZEN", TRUE AS "HAS_SSN",
       TRUE AS "EMPLOYEE_STATUS"
FROM customer
WHERE c_custkey % 4 <> 0 AND c_custkey % 9 <> 0 AND c_custkey % 5 <> 0 AND c_custkey % 11 <> 0 AND c_custkey % 6 <> 0"""

DAY = "strftime(o_orderdate, '%Y-%m-%d')"
ORACLES["parse_dates"] = f"""
SELECT o_orderkey, {DAY} AS a, {DAY} AS b, {DAY} AS c, {DAY} AS d, {SHORT_YEAR_DAY} AS e,
       CASE WHEN o_orderkey % 3 <> 0 THEN {DAY} END AS f
FROM orders"""

MICROS = "strftime(ts, '%Y-%m-%d %H:%M:%S.%f')"
MILLIS = "strftime(ts, '%Y-%m-%d %H:%M:%S.%g') || '000'"
ORACLES["parse_timestamps"] = f"""
SELECT event_id, {MILLIS} AS ts1, strftime(ts, '%Y-%m-%d %H:%M:%S') || '.000000' AS ts2, {MILLIS} AS ts3, {MICROS} AS ts4,
       {MILLIS} AS ts5
FROM events"""

ORACLES["recode"] = """
SELECT c_custkey, CASE c_mktsegment WHEN 'BUILDING' THEN 'B' WHEN 'MACHINERY' THEN 'M' ELSE 'Unknown' END AS c_mktsegment
FROM customer"""

ORACLES["transform_customers"] = """
SELECT o_orderkey + 1 AS id, strftime(o_orderdate + INTERVAL 2 DAY, '%Y-%m-%d') AS dob,
       CASE WHEN o_custkey % 2 = 0 THEN 'hyderabad' ELSE 'visakhapatnam' END AS city
FROM orders"""

ORACLES["split_contact"] = """
SELECT c_custkey,
       CASE WHEN c_custkey % 3 = 0 THEN split_part(c_name, '#', 2) WHEN c_custkey % 5 = 0 THEN split_part(c_name, '#', 1)
            ELSE c_name END AS contact,
       CASE WHEN c_custkey % 3 <> 0 THEN split_part(c_name, '#', 1) END AS "Address",
       CASE WHEN c_custkey % 3 = 0 OR c_custkey % 5 <> 0 THEN split_part(c_name, '#', 2) END AS "Phone"
FROM customer"""

ORACLES["semi_join_distinct"] = """
SELECT event_id, user_id, event_type, value FROM events
WHERE user_id IN (SELECT user_id FROM events WHERE event_type = 'purchase' AND user_id % 3 = 0)"""

ORACLES["ranked_by_score"] = """
SELECT * FROM customer WHERE c_mktsegment = 'BUILDING' AND c_acctbal > 500 ORDER BY c_acctbal DESC, c_custkey"""

ORACLES["word_count"] = """
SELECT word, count(*) AS n FROM (SELECT unnest(string_split(text, ' ')) AS word FROM documents) WHERE word <> '' GROUP BY word"""

ORACLES["word_count_normalized"] = """
SELECT word, count(*) AS n
FROM (SELECT unnest(regexp_split_to_array(lower(text), '[^a-z0-9]+')) AS word FROM documents) WHERE word <> '' GROUP BY word"""

# ---- files and tables

ORACLES["read_delimited"] = """
SELECT p_partkey,
       CASE WHEN p_partkey % 9 = 0 THEN '' WHEN p_partkey % 7 <> 0 THEN p_name END AS p_name, p_size,
       CAST(CAST(p_retailprice AS DECIMAL(18,2)) AS VARCHAR) AS p_retailprice,
       CASE WHEN p_partkey % 6 <> 0 THEN strftime(DATE '2024-01-01' + p_size, '%Y-%m-%d') END AS p_since,
       CASE WHEN p_partkey % 6 = 0 THEN 'p_since=soon' END AS problem
FROM part"""

ORACLES["parse_delimited_text"] = """
SELECT p_partkey, p_name, p_size,
       CASE WHEN p_partkey % 17 = 0 THEN concat_ws('|', p_partkey, p_name, p_size, 'more') END AS problem
FROM part"""

ORACLES["write_table"] = """
SELECT s_suppkey, s_name, CASE WHEN s_nationkey % 2 = 0 THEN s_acctbal + 1 ELSE s_acctbal END AS s_acctbal, s_nationkey
FROM supplier"""

# ---- loads

ORACLES["load_partition"] = f"WITH {LOADS} SELECT {EVENT_COLUMNS} FROM third_state"
ORACLES["read_as_of"] = f"WITH {LOADS} SELECT {EVENT_COLUMNS} FROM daily"
ORACLES["read_as_of_time"] = f"WITH {LOADS} SELECT {EVENT_COLUMNS} FROM second_state"

# a partition that has late rows consists of two loads
ORACLES["list_partitions"] = f"""
WITH {LOADS}
SELECT CAST(event_date AS VARCHAR) AS partition_value, CAST(1 + max(CASE WHEN event_id < 0 THEN 1 ELSE 0 END) AS BIGINT) AS n_loads,
       count(*) AS n_rows
FROM third_state GROUP BY event_date"""

ORACLES["list_snapshots"] = f"""
WITH {LOADS}
SELECT CAST(1 AS BIGINT) AS load_id, '2024-02-01 00:00:00' AS load_ts, 'append' AS operation,
       count(DISTINCT event_date) AS n_partitions, count(*) AS n_rows FROM daily
UNION ALL SELECT 2, '2024-02-02 00:00:00', 'replace', count(DISTINCT event_date), count(*) FROM corrected
UNION ALL SELECT 3, '2024-02-03 00:00:00', 'append', count(DISTINCT event_date), count(*) FROM late"""

ORACLES["restore_partition"] = f"""
WITH {LOADS}
SELECT {EVENT_COLUMNS} FROM third_state WHERE event_date <> DATE '2024-01-02'
UNION ALL SELECT {EVENT_COLUMNS} FROM daily WHERE event_date = DATE '2024-01-02'"""

ORACLES["update_rows"] = f"""
WITH {LOADS}, changed AS (
  SELECT event_id, user_id, CASE WHEN event_type = 'error' AND day(event_date) <= 10 THEN 'fixed' ELSE event_type END AS event_type,
         CASE WHEN event_type = 'error' AND day(event_date) <= 10 THEN 0.0 ELSE value END AS value, event_date
  FROM third_state)
SELECT {EVENT_COLUMNS} FROM changed"""

# ---- streams

ORACLES["stream_ingest"] = "SELECT event_id, user_id, event_type, value FROM events"
ORACLES["stream_messages"] = "SELECT CAST(event_id AS VARCHAR) AS key, event_type AS value FROM events"
ORACLES["stream_split"] = """
SELECT event_id, user_id, CASE WHEN event_id % 4 <> 0 THEN event_type END AS event_type, value, event_id % 4 <> 0 AS is_valid
FROM events"""

# ---- cases that must not lose or change rows

ORACLES["scd2_late_extract"] = f"""
WITH {CUSTOMER_DELTA},
joined AS (
  SELECT c.*, d.c_custkey AS found, d.c_name AS new_name, d.c_nationkey AS new_nation, d.c_acctbal AS new_balance,
         d.c_mktsegment AS new_segment, c.c_custkey % 2 = 0 AS is_late
  FROM customer c LEFT JOIN customer_delta d ON c.c_custkey = d.c_custkey),
judged AS (
  SELECT *, CASE WHEN is_late THEN 'stays' WHEN found IS NULL THEN 'expires'
                 WHEN c_mktsegment IS DISTINCT FROM new_segment THEN 'changes' ELSE 'stays' END AS verdict FROM joined)
SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment,
       CASE WHEN is_late THEN '2025-03-01' ELSE '2024-01-01' END AS eff_dt,
       CASE WHEN verdict = 'stays' THEN '9999-12-31' ELSE '2024-12-01' END AS end_dt,
       CASE WHEN verdict = 'stays' THEN 'Y' ELSE 'N' END AS act_in
FROM judged
UNION ALL
SELECT c_custkey, new_name, new_nation, new_balance, new_segment, '2024-12-01', '9999-12-31', 'Y'
FROM judged WHERE verdict = 'changes'
UNION ALL
SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment, '2024-12-01', '9999-12-31', 'Y'
FROM customer_delta WHERE c_custkey < 0"""

ORDER_DAY = "strftime(o_orderdate, '%Y-%m-%d')"
HIGH = "'9999-12-31 23:59:00'"
ORACLES["cdc_malformed_extract"] = f"""
WITH lines AS (
  SELECT o_orderkey, o_orderkey % 5 = 0 OR o_orderkey % 6 = 0 AS bad, o_orderkey % 7 = 0 AS updated, o_orderkey % 11 <> 0 AS sent,
         o_orderstatus, CASE WHEN o_orderkey % 7 = 0 THEN 'X' ELSE o_orderstatus END AS new_status, {ORDER_DAY} AS day
  FROM orders)
SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey,
       CASE WHEN sent AND NOT bad THEN new_status ELSE o_orderstatus END AS o_orderstatus, day AS o_orderdate,
       CASE WHEN sent AND NOT bad AND new_status <> o_orderstatus THEN '2024-12-01 00:00:00' ELSE '2024-01-01 00:00:00' END
         AS eff_start_date,
       {HIGH} AS eff_end_date, CAST(NULL AS VARCHAR) AS problem, CASE WHEN sent THEN 'current' ELSE 'deleted' END AS outcome
FROM lines
UNION ALL
SELECT CAST(o_orderkey AS VARCHAR), new_status, CASE WHEN o_orderkey % 5 <> 0 THEN day END, NULL, NULL,
       o_orderkey || ',' || new_status || ',' || CASE WHEN o_orderkey % 5 = 0 THEN '2020-13-01' ELSE day END
         || CASE WHEN o_orderkey % 6 = 0 THEN ',more' ELSE '' END, 'rejected'
FROM lines WHERE bad AND sent"""

ORACLES["cdc_after_empty_extract"] = f"""
SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, o_orderstatus, {ORDER_DAY} AS o_orderdate, '2024-12-01 00:00:00' AS eff_start_date,
       {HIGH} AS eff_end_date, CAST(NULL AS VARCHAR) AS problem, 'current' AS outcome
FROM orders"""

ORACLES["ingest_malformed"] = f"""
WITH {LANDED},
lines AS (
  SELECT *, Sale_ID % 9 = 0 OR Sale_ID % 10 = 0 AS bad,
         CASE WHEN Sale_ID % 9 = 0 THEN 'five' ELSE coalesce(CAST(Quantity_Sold AS VARCHAR), '') END AS quantity FROM landed)
SELECT CAST(Sale_ID AS VARCHAR) AS "Sale_ID", CAST(Quantity_Sold AS VARCHAR) AS "Quantity_Sold", Vendor_ID AS "Vendor_ID",
       CASE WHEN Quantity_Sold IS NULL OR Vendor_ID IS NULL THEN 'hold' ELSE 'valid' END AS part, CAST(NULL AS VARCHAR) AS line
FROM lines WHERE NOT bad
UNION ALL
SELECT NULL, NULL, NULL, 'unreadable', concat_ws('|', Sale_ID, Product_ID, quantity, coalesce(Vendor_ID, ''),
       CASE WHEN Sale_ID % 10 = 0 THEN 'extra' END)
FROM lines WHERE bad"""

ORACLES["ingest_without_holds"] = f"""
WITH {REPAIRED}
SELECT * REPLACE ({QUANTITY_TEXT}), CASE WHEN Quantity_Sold IS NULL OR Vendor_ID IS NULL THEN 'hold' ELSE 'valid' END AS part
FROM today"""

ORACLES["enrich_day"] = f"""
WITH {PRODUCTS},
sold AS (SELECT l_partkey AS Product_ID, CAST(l_quantity AS BIGINT) AS q FROM lineitem WHERE l_orderkey % 9 <> 0)
SELECT s.Product_ID AS "Product_ID", o.Product_Name AS "Product_Name",
       CASE WHEN o.Product_ID IS NOT NULL THEN 'enriched'
            WHEN s.Product_ID IN (SELECT Product_ID FROM known) THEN 'ambiguous_product' ELSE 'unknown_product' END AS outcome,
       count(*) AS n_sales, CAST(sum(q) AS BIGINT) AS quantity,
       CAST(sum(CAST(Product_Price * q AS DECIMAL(18,2))) AS VARCHAR) AS amount
FROM sold s LEFT JOIN once o ON s.Product_ID = o.Product_ID GROUP BY ALL"""

ORACLES["read_with_header"] = """
SELECT s_suppkey, s_name, CAST(s_nationkey AS INTEGER) AS s_nationkey, CAST(s_nationkey AS VARCHAR) AS as_text FROM supplier"""
ORACLES["read_without_header"] = "SELECT CAST(o_orderkey AS VARCHAR) AS _c0, o_orderstatus AS _c1, o_orderpriority AS _c2 FROM orders"
ORACLES["write_timestamps"] = """
SELECT CAST(event_id AS VARCHAR) AS _c0, strftime(ts, '%Y/%m/%d %H.%M.%S') AS _c1 FROM events"""
ORACLES["files_of_one_name"] = """
SELECT 'Sales.parquet' AS file_name, (SELECT CAST(count(*) AS VARCHAR) FROM nation) AS expected_rows,
       CAST(2 * count(*) AS VARCHAR) AS actual_rows, 'ambiguous' AS status FROM supplier
UNION ALL SELECT 'Nation.parquet', CAST(count(*) AS VARCHAR), CAST(count(*) AS VARCHAR), 'match' FROM nation"""
ORACLES["daily_partition"] = """
SELECT strftime(ts, '%Y-%m-%d') AS partition_date, count(*) AS n_rows FROM events GROUP BY 1"""
ORACLES["read_partitions_where"] = f"""
WITH {LOADS} SELECT {EVENT_COLUMNS} FROM third_state WHERE event_date <= DATE '2024-01-05'"""
ORACLES["load_with_new_column"] = f"""
WITH {LOADS}
SELECT {EVENT_COLUMNS}, CAST(NULL AS VARCHAR) AS origin FROM daily
UNION ALL SELECT {EVENT_COLUMNS}, 'late' FROM late"""
ORACLES["load_after_empty_load"] = f"""
WITH {LOADS}
SELECT CAST(1 AS BIGINT) AS load_id, '2024-03-01 00:00:00' AS load_ts, 'append' AS operation, CAST(0 AS BIGINT) AS n_partitions,
       CAST(0 AS BIGINT) AS n_rows
UNION ALL SELECT 2, '2024-03-02 00:00:00', 'append', count(DISTINCT event_date), count(*) FROM daily
UNION ALL SELECT 3, '2024-03-03 00:00:00', 'append', 0, 0
UNION ALL SELECT 4, '2024-03-04 00:00:00', 'append', count(DISTINCT event_date), count(*) FROM late"""
ORACLES["read_as_of_after_empty_load"] = f"WITH {LOADS} SELECT {EVENT_COLUMNS} FROM daily"
ORACLES["stream_in_intervals"] = ORACLES["stream_ingest"]


# ---- digests, repeated keys, headers, hidden partitions, loads

ORACLES["reconcile_rows_by_digest"] = """
WITH a AS (SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, l_returnflag FROM lineitem),
b AS (SELECT * REPLACE (CASE WHEN l_orderkey % 50 = 0 THEN l_quantity + 1 ELSE l_quantity END AS l_quantity) FROM a)
SELECT *, 'TARGET' AS MISSING_FROM FROM (SELECT * FROM a EXCEPT SELECT * FROM b)
UNION ALL SELECT *, 'SOURCE' FROM (SELECT * FROM b EXCEPT SELECT * FROM a)"""

ORACLES["reconcile_digested"] = """
WITH a AS (SELECT o_orderkey, o_custkey, o_orderstatus, o_orderpriority, o_totalprice FROM orders),
b AS (SELECT * REPLACE (CASE WHEN o_orderkey % 97 = 0 THEN 'X' ELSE o_orderstatus END AS o_orderstatus) FROM a)
SELECT *, 'TARGET' AS MISSING_FROM FROM (SELECT * FROM a EXCEPT SELECT * FROM b)
UNION ALL SELECT *, 'SOURCE' FROM (SELECT * FROM b EXCEPT SELECT * FROM a)"""

ORACLES["reconcile_repeated"] = f"""
WITH {LINE_SIDES},
a AS (SELECT l_orderkey, l_partkey, l_returnflag FROM lines),
b AS (SELECT l_orderkey, l_partkey, l_returnflag FROM line_changes WHERE l_partkey % 15 <> 0),
x AS (SELECT *, row_number() OVER o AS pair FROM (SELECT * FROM a EXCEPT ALL SELECT * FROM b)
      WINDOW o AS (PARTITION BY l_orderkey ORDER BY l_partkey, l_returnflag)),
y AS (SELECT *, row_number() OVER o AS pair FROM (SELECT * FROM b EXCEPT ALL SELECT * FROM a)
      WINDOW o AS (PARTITION BY l_orderkey ORDER BY l_partkey, l_returnflag)),
p AS (SELECT coalesce(x.l_orderkey, y.l_orderkey) AS l_orderkey, CAST(coalesce(x.pair, y.pair) AS VARCHAR) AS pair,
             x.l_partkey AS p1, x.l_returnflag AS f1, y.l_partkey AS p2, y.l_returnflag AS f2
      FROM x FULL JOIN y ON x.l_orderkey = y.l_orderkey AND x.pair = y.pair)
SELECT l_orderkey, pair, 'both' AS presence, 'l_partkey' AS mismatched_col_name,
       CAST(p1 AS VARCHAR) AS value_from_t1, CAST(p2 AS VARCHAR) AS value_from_t2
FROM p WHERE p1 IS NOT NULL AND p2 IS NOT NULL AND p1 <> p2
UNION ALL SELECT l_orderkey, pair, 'both', 'l_returnflag', f1, f2 FROM p WHERE p1 IS NOT NULL AND p2 IS NOT NULL AND f1 <> f2
UNION ALL SELECT l_orderkey, pair, 'left_only', NULL, p1 || ',' || f1, NULL FROM p WHERE p2 IS NULL
UNION ALL SELECT l_orderkey, pair, 'right_only', NULL, NULL, p2 || ',' || f2 FROM p WHERE p1 IS NULL"""

ORACLES["read_by_header"] = """
SELECT c_custkey, c_name, CASE WHEN c_custkey % 3 <> 2 THEN c_mktsegment END AS c_mktsegment FROM customer"""

ORACLES["read_time_range"] = """
SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts FROM events
WHERE ts >= TIMESTAMP '2024-01-03 06:00:00' AND ts < TIMESTAMP '2024-01-07' OR ts >= TIMESTAMP '2024-01-20 18:30:00'"""

ORACLES["load_counts"] = f"""
WITH {LOADS},
loads AS (SELECT 1::BIGINT AS load_id, * FROM daily UNION ALL SELECT 2, * FROM corrected UNION ALL SELECT 3, * FROM late)
SELECT load_id, count(*) AS n_rows, CAST(trunc(sum(CAST(value AS DECIMAL(18,2)))) AS BIGINT) AS total_value,
       count(*) FILTER (event_type = 'error') AS errors
FROM loads GROUP BY load_id"""

ORACLES["changes_between_loads"] = f"""
WITH {LOADS},
signed AS (SELECT *, 1 AS sign FROM third_state UNION ALL SELECT *, -1 FROM daily),
summed AS (SELECT event_id, user_id, event_type, value, event_date, sum(sign) AS n FROM signed GROUP BY ALL)
SELECT {EVENT_COLUMNS}, CASE WHEN n > 0 THEN 'added' ELSE 'removed' END AS change, abs(n)::BIGINT AS copies
FROM summed WHERE n <> 0"""

ORACLES["stream_load"] = f"WITH {LOADS} SELECT {EVENT_COLUMNS} FROM daily"

ORACLES["stream_repair"] = ORACLES["ingest_next_day"]
