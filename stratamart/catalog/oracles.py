"""The result of each registered query, stated in SQL that DuckDB runs on the same tables."""

from __future__ import annotations

FEED = """
SELECT
  CASE WHEN l_orderkey % 101 = 0 THEN 'X' || l_orderkey::VARCHAR
    WHEN l_orderkey % 103 = 0 THEN (l_orderkey + 3000000000)::VARCHAR
    ELSE l_orderkey::VARCHAR END AS OrderID,
  CASE WHEN l_orderkey % 97 = 0 THEN 'not-a-date'
    WHEN l_orderkey % 2 = 0 THEN strftime(o_orderdate::DATE, '%Y-%m-%d')
    ELSE strftime(o_orderdate::DATE, '%d-%m-%Y') END AS OrderDate,
  CASE WHEN l_orderkey % 73 <> 0 THEN 'C' || o_custkey::VARCHAR END AS CustomerID,
  c_name AS CustomerName,
  'P' || l_partkey::VARCHAR AS ProductID,
  p_name AS ProductName,
  p_type AS Category,
  CASE WHEN (l_orderkey + l_linenumber) % 83 = 0 THEN '0'
    WHEN (l_orderkey + l_linenumber) % 89 = 0 THEN 'abc'
    ELSE l_quantity::INTEGER::VARCHAR END AS Quantity,
  CASE WHEN (l_orderkey + l_linenumber) % 79 = 0 THEN 'N/A' ELSE p_retailprice::VARCHAR
    END AS UnitPrice,
  l_extendedprice::VARCHAR AS TotalPrice,
  'S' || l_suppkey::VARCHAR AS StoreID,
  n_name AS StoreLocation,
  o_orderpriority AS PaymentMethod
FROM lineitem
JOIN orders ON l_orderkey = o_orderkey
JOIN customer ON o_custkey = c_custkey
JOIN part ON l_partkey = p_partkey
JOIN supplier ON l_suppkey = s_suppkey
JOIN nation ON s_nationkey = n_nationkey"""

TYPED = """
SELECT *, strftime(OrderDate, '%d-%m-%Y') AS OrderDateStr
FROM (
  SELECT
    try_cast(OrderID AS BIGINT) AS OrderID,
    coalesce(try_strptime(OrderDate, '%Y-%m-%d'), try_strptime(OrderDate, '%d-%m-%Y'))::DATE
      AS OrderDate,
    CustomerID, CustomerName, ProductID, ProductName, Category,
    try_cast(Quantity AS INTEGER) AS Quantity,
    try_cast(UnitPrice AS DOUBLE) AS UnitPrice,
    try_cast(TotalPrice AS DOUBLE) AS TotalPrice,
    StoreID, StoreLocation, PaymentMethod
  FROM feed)"""

DEDUPED = """
SELECT * FROM typed
QUALIFY row_number() OVER (
  PARTITION BY OrderID
  ORDER BY OrderDate NULLS FIRST, CustomerID NULLS FIRST, CustomerName NULLS FIRST,
    ProductID NULLS FIRST, ProductName NULLS FIRST, Category NULLS FIRST,
    Quantity NULLS FIRST, UnitPrice NULLS FIRST, TotalPrice NULLS FIRST,
    StoreID NULLS FIRST, StoreLocation NULLS FIRST, PaymentMethod NULLS FIRST) = 1"""

CLEAN = """
SELECT * FROM deduped
WHERE OrderID IS NOT NULL AND OrderDate IS NOT NULL AND CustomerID IS NOT NULL
  AND ProductID IS NOT NULL AND Quantity > 0 AND UnitPrice IS NOT NULL
  AND TotalPrice IS NOT NULL"""

SILVER = (
    f"WITH feed AS ({FEED}),\ntyped AS ({TYPED}),\n"
    f"deduped AS ({DEDUPED}),\nclean AS ({CLEAN})"
)

FACT = """
SELECT row_number() OVER (ORDER BY OrderID) - 1 AS SalesID, OrderID, OrderDate, CustomerID,
  ProductID, StoreID, Quantity, UnitPrice, TotalPrice, PaymentMethod
FROM clean"""

DATES = """
SELECT DISTINCT OrderDate AS OrderDateParsed, day(OrderDate)::INTEGER AS "Day",
  month(OrderDate)::INTEGER AS "Month", year(OrderDate)::INTEGER AS "Year",
  monthname(OrderDate) AS MonthName, quarter(OrderDate)::INTEGER AS "Quarter"
FROM clean"""


def _kpi(condition: str = "true") -> str:
    return f"""
SELECT strftime(OrderDate, '%Y-%m') AS yearmonth, round(fsum(TotalPrice)) AS TotalRevenue,
  count(DISTINCT OrderID) AS TotalOrders,
  round(fsum(TotalPrice) / count(DISTINCT OrderID)) AS AverageOrderValue,
  count(DISTINCT CustomerID) AS UniqueCustomers
FROM clean WHERE {condition} GROUP BY 1"""


CUSTOMERS = """
WITH existing AS (
  SELECT c_custkey AS CustomerID, c_name AS CustomerName, c_mktsegment AS Segment,
    DATE '1996-01-01' AS valid_from, NULL::DATE AS valid_to, true AS is_current
  FROM customer WHERE c_custkey % 5 <> 0
  UNION ALL
  SELECT c_custkey, 'Old ' || c_name, c_mktsegment, DATE '1995-01-01', DATE '1996-01-01', false
  FROM customer WHERE c_custkey % 5 <> 0 AND c_custkey % 4 = 0),
incoming AS (
  SELECT c_custkey AS CustomerID,
    CASE WHEN c_custkey % 3 = 0 THEN c_name || ' Jr' WHEN c_custkey % 11 = 0 THEN NULL
      ELSE c_name END AS CustomerName,
    CASE WHEN c_custkey % 10 = 1 THEN 'RETAIL' ELSE c_mktsegment END AS Segment
  FROM customer WHERE c_custkey % 7 <> 0 OR c_custkey % 5 = 0)"""

FIRST_DAY = "DATE '1998-01-01'"
SECOND_DAY = "DATE '1998-06-01'"


def _versions(keys: list[str], attributes: list[str], null_safe: bool = True) -> str:
    """CTEs from ``existing`` and ``incoming`` to ``tagged``, the versions after a run."""
    using = ", ".join(keys)
    differs = " OR ".join(
        f"e.{a} IS DISTINCT FROM i.{a}" if null_safe else f"e.{a} <> i.{a}" for a in attributes
    )
    old = ", ".join(f"e.{name}" for name in [*keys, *attributes])
    new = ", ".join(f"i.{name}" for name in [*keys, *attributes])
    return f"""
changed AS (
  SELECT {using} FROM existing e JOIN incoming i USING ({using})
  WHERE e.is_current AND ({differs})),
tagged AS (
  SELECT {old}, e.valid_from, {SECOND_DAY} AS valid_to, false AS is_current,
    'expired' AS change
  FROM existing e SEMI JOIN changed USING ({using}) WHERE e.is_current
  UNION ALL
  SELECT {new}, {SECOND_DAY}, NULL, true, 'new version'
  FROM incoming i SEMI JOIN changed USING ({using})
  UNION ALL
  SELECT {old}, e.valid_from, e.valid_to, true, 'unchanged'
  FROM existing e ANTI JOIN changed USING ({using}) WHERE e.is_current
  UNION ALL
  SELECT {new}, {SECOND_DAY}, NULL, true, 'new key'
  FROM incoming i ANTI JOIN existing USING ({using})
  UNION ALL
  SELECT {old}, e.valid_from, e.valid_to, false, 'history'
  FROM existing e WHERE NOT e.is_current)"""


TAGGED = f"{CUSTOMERS},{_versions(['CustomerID'], ['CustomerName', 'Segment'])}"
COMPAT = f"{CUSTOMERS},{_versions(['CustomerID'], ['CustomerName', 'Segment'], False)}"

COUNTS = """count(*) AS Total, count(*) FILTER (is_current) AS Active,
  count(*) FILTER (NOT is_current) AS Historical"""


def _by_change(change: str) -> str:
    return f"{TAGGED} SELECT * EXCLUDE (change) FROM tagged WHERE change = '{change}'"


def _changed(null_safe: bool) -> str:
    compare = "IS DISTINCT FROM" if null_safe else "<>"
    return f"""{CUSTOMERS}
SELECT CustomerID, e.CustomerName AS old_CustomerName, e.Segment AS old_Segment,
  i.CustomerName AS new_CustomerName, i.Segment AS new_Segment
FROM existing e JOIN incoming i USING (CustomerID)
WHERE e.is_current AND (e.CustomerName {compare} i.CustomerName
  OR e.Segment {compare} i.Segment)"""


def _two_days(key: str, attributes: list[str]) -> str:
    columns = ", ".join([key, *attributes])
    order = ", ".join(f"{name} NULLS FIRST" for name in attributes)
    one = f"QUALIFY row_number() OVER (PARTITION BY {key} ORDER BY {order}) = 1"
    first, rest = attributes[0], "".join(f", {name}" for name in attributes[1:])
    return f"""{SILVER},
existing AS (
  SELECT {columns}, {FIRST_DAY} AS valid_from, NULL::DATE AS valid_to, true AS is_current
  FROM (SELECT * FROM clean WHERE OrderDate < {FIRST_DAY} AND {key} IS NOT NULL {one})),
incoming AS (
  SELECT {key}, CASE WHEN substr({key}, 2)::BIGINT % 9 = 0 THEN {first} || ' v2'
    ELSE {first} END AS {first}{rest}
  FROM (SELECT * FROM clean WHERE OrderDate >= {FIRST_DAY} AND {key} IS NOT NULL {one})),
{_versions([key], attributes)}"""


TWO_DAYS = {
    "customer": _two_days("CustomerID", ["CustomerName"]),
    "product": _two_days("ProductID", ["ProductName", "Category"]),
    "store": _two_days("StoreID", ["StoreLocation"]),
}

SUMMARY = " UNION ALL ".join(
    f"(SELECT '{name}' AS Dimension, {COUNTS} FROM ({with_tagged} SELECT * FROM tagged))"
    for name, with_tagged in TWO_DAYS.items()
)

REJECTS = f"""{SILVER},
unread AS (
  SELECT * REPLACE (NULL::BIGINT AS OrderID), OrderID AS RawOrderID FROM feed
  WHERE try_cast(OrderID AS BIGINT) IS NULL)
SELECT *,
  CASE WHEN OrderDate IS NULL THEN 'OrderDate is missing'
    WHEN CustomerID IS NULL THEN 'CustomerID is missing'
    WHEN ProductID IS NULL THEN 'ProductID is missing'
    WHEN Quantity IS NULL THEN 'Quantity is missing'
    WHEN Quantity <= 0 THEN 'Quantity is not positive'
    WHEN UnitPrice IS NULL THEN 'UnitPrice is missing'
    WHEN TotalPrice IS NULL THEN 'TotalPrice is missing' END AS failed_rule,
  OrderID::VARCHAR AS RawOrderID
FROM deduped WHERE OrderID IS NOT NULL AND failed_rule IS NOT NULL
UNION ALL BY NAME
SELECT * REPLACE (
    coalesce(try_strptime(OrderDate, '%Y-%m-%d'), try_strptime(OrderDate, '%d-%m-%Y'))::DATE
      AS OrderDate,
    try_cast(Quantity AS INTEGER) AS Quantity, try_cast(UnitPrice AS DOUBLE) AS UnitPrice,
    try_cast(TotalPrice AS DOUBLE) AS TotalPrice),
  strftime(coalesce(try_strptime(OrderDate, '%Y-%m-%d'), try_strptime(OrderDate, '%d-%m-%Y')),
    '%d-%m-%Y') AS OrderDateStr,
  CASE WHEN RawOrderID IS NULL THEN 'OrderID is missing' ELSE 'OrderID is unreadable' END
    AS failed_rule
FROM unread"""

STORE_VERSIONS = f"""
stores_before AS (
  SELECT StoreID, min(StoreLocation) AS StoreLocation FROM clean
  WHERE OrderDate < {FIRST_DAY} AND StoreID IS NOT NULL GROUP BY 1),
stores_after AS (
  SELECT StoreID, min(StoreLocation) || CASE WHEN substr(StoreID, 2)::BIGINT % 9 = 0 THEN ' v2'
    ELSE '' END AS StoreLocation
  FROM clean WHERE OrderDate >= {FIRST_DAY} AND StoreID IS NOT NULL GROUP BY 1)"""

# The orders of the first and of the second of two extracts.
EXTRACT = "(OrderID % 2 <> 0)::INTEGER"


def _newest(key: str, attributes: list[str], extract: int) -> str:
    """The attributes of a key's last order in an extract, the greatest ones on equal days."""
    order = ", ".join(f"{name} DESC NULLS LAST" for name in ["OrderDate", *attributes])
    return f"""
  SELECT {", ".join([key, *attributes])} FROM clean WHERE {EXTRACT} = {extract} AND {key} IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY {key} ORDER BY {order}) = 1"""


def _daily_history(key: str, attributes: list[str]) -> str:
    return f"""{SILVER},
existing AS (
  SELECT *, {FIRST_DAY} AS valid_from, NULL::DATE AS valid_to, true AS is_current
  FROM ({_newest(key, attributes, 0)})),
incoming AS ({_newest(key, attributes, 1)}),
{_versions([key], attributes)}
SELECT * EXCLUDE (change) FROM tagged"""


DAILY_HISTORY = " UNION ALL BY NAME ".join(
    f"SELECT * FROM ({_daily_history(key, attributes)})"
    for key, attributes in (
        ("CustomerID", ["CustomerName"]),
        ("ProductID", ["ProductName", "Category"]),
        ("StoreID", ["StoreLocation"]),
    )
)

ASOF = f"""{TAGGED}
SELECT o_orderkey, o_custkey, CustomerName, Segment, valid_from
FROM orders LEFT JOIN tagged ON o_custkey = CustomerID AND o_orderdate::DATE >= valid_from
  AND (valid_to IS NULL OR o_orderdate::DATE < valid_to)"""

# The lines of write_malformed and write_uneven, as text.
MALFORMED = f"""
SELECT concat_ws(',', o_orderkey, o_custkey, o_orderpriority) AS MalformedLine, 3 AS "Fields",
  'too few fields' AS Reason, unnest(['malformed', 'uneven']) AS "Folder" FROM orders
UNION ALL
SELECT s_suppkey::VARCHAR || repeat(',surplus', 19), 20, 'too many fields', 'malformed' FROM supplier
UNION ALL
SELECT concat_ws(',', s_suppkey, 'OrderDate', 'CustomerID', 'CustomerName', 'ProductID', 'ProductName', 'Category',
  'Quantity', 'UnitPrice', s_acctbal, 'StoreID', 'StoreLocation', 'PaymentMethod', 'surplus', 'surplus'),
  15, 'too many fields', 'uneven' FROM supplier"""

MIXED = f"""{CUSTOMERS},
moved AS (
  SELECT CustomerID FROM existing e JOIN incoming i USING (CustomerID)
  WHERE is_current AND e.Segment IS DISTINCT FROM i.Segment),
lasted AS (
  SELECT e.CustomerID, e.CustomerName, e.Segment, e.valid_from,
    CASE WHEN is_current AND m.CustomerID IS NOT NULL THEN {SECOND_DAY} ELSE valid_to END AS valid_to
  FROM existing e LEFT JOIN moved m USING (CustomerID)
  UNION ALL
  SELECT CustomerID, CustomerName, Segment, {SECOND_DAY}, NULL FROM incoming
  WHERE CustomerID IN (FROM moved) OR CustomerID NOT IN (SELECT CustomerID FROM existing)),
valued AS (
  SELECT l.CustomerID, CASE WHEN i.CustomerID IS NULL THEN l.CustomerName ELSE i.CustomerName END AS CustomerName,
    l.Segment, valid_from, valid_to, i.CustomerID IS NOT NULL AS came_in
  FROM lasted l LEFT JOIN incoming i USING (CustomerID)),
marked AS (
  SELECT *, (came_in AND lag(valid_to) OVER w = valid_from AND lag(Segment) OVER w IS NOT DISTINCT FROM Segment
    AND lag(CustomerName) OVER w IS NOT DISTINCT FROM CustomerName) IS TRUE AS goes_on
  FROM valued WINDOW w AS (PARTITION BY CustomerID ORDER BY valid_from)),
runs AS (
  SELECT *, sum((NOT goes_on)::INTEGER) OVER (PARTITION BY CustomerID ORDER BY valid_from) AS run FROM marked)
SELECT CustomerID, any_value(CustomerName) AS CustomerName, any_value(Segment) AS Segment, min(valid_from)::DATE AS valid_from,
  CASE WHEN bool_or(valid_to IS NULL) THEN NULL ELSE max(valid_to) END::DATE AS valid_to, bool_or(valid_to IS NULL) AS is_current
FROM runs GROUP BY CustomerID, run"""

HISTORY = f"""{SILVER},
daily AS (
  SELECT StoreID, ProductID, OrderDate, sum(Quantity)::BIGINT AS Units FROM clean
  WHERE StoreID IS NOT NULL GROUP BY ALL),
changes AS (
  SELECT * FROM daily
  QUALIFY lag(Units) OVER (PARTITION BY StoreID, ProductID ORDER BY OrderDate) IS DISTINCT FROM Units)
SELECT StoreID, ProductID, Units, OrderDate AS valid_from,
  lead(OrderDate) OVER (PARTITION BY StoreID, ProductID ORDER BY OrderDate) AS valid_to, valid_to IS NULL AS is_current
FROM changes"""

ORACLES = {
    "bronze_csv_scan": FEED,
    "bronze_csv_infer": f"""
SELECT * REPLACE (TotalPrice::DOUBLE AS TotalPrice) FROM ({FEED})
UNION ALL BY NAME
SELECT o_orderkey::VARCHAR AS OrderID, o_custkey::VARCHAR AS OrderDate,
  o_orderpriority AS CustomerID FROM orders
UNION ALL BY NAME
SELECT s_suppkey::VARCHAR AS OrderID, 'OrderDate' AS OrderDate, 'CustomerID' AS CustomerID,
  'CustomerName' AS CustomerName, 'ProductID' AS ProductID, 'ProductName' AS ProductName,
  'Category' AS Category, 'Quantity' AS Quantity, 'UnitPrice' AS UnitPrice,
  s_acctbal AS TotalPrice, 'StoreID' AS StoreID, 'StoreLocation' AS StoreLocation,
  'PaymentMethod' AS PaymentMethod FROM supplier""",
    "bronze_malformed": MALFORMED,
    "stream_malformed": f"""
SELECT 'good' AS "Folder", NULL::VARCHAR AS Reason, count(*) AS "Lines" FROM ({FEED})
UNION ALL
SELECT "Folder", Reason, count(*) FROM ({MALFORMED}) WHERE "Folder" = 'malformed' GROUP BY 1, 2""",
    "silver_partition_scan": f"""{SILVER} SELECT *, {SECOND_DAY} AS run_date FROM clean
WHERE OrderDate >= {FIRST_DAY}""",
    "stream_ingest": FEED,
    "ingest_archive": f"""
SELECT * FROM ({FEED}) WHERE regexp_extract(OrderID, '[0-9]+')::BIGINT % 4 < 3""",
    "silver_typed": f"{SILVER} SELECT * FROM typed",
    "silver_dedupe": f"{SILVER} SELECT * FROM deduped",
    "silver_clean": f"{SILVER} SELECT * FROM clean",
    "silver_rejects": REJECTS,
    "daily_rejects": REJECTS,
    "dim_customer": f"{SILVER} SELECT DISTINCT CustomerID, CustomerName FROM clean",
    "dim_product": f"{SILVER} SELECT DISTINCT ProductID, ProductName FROM clean",
    "dim_product_category": f"""{SILVER}
SELECT DISTINCT ProductID, ProductName, Category FROM clean""",
    "dim_store": f"{SILVER} SELECT DISTINCT StoreID, StoreLocation FROM clean",
    "dim_date": f"{SILVER} {DATES}",
    "fact_sales": f"{SILVER} {FACT}",
    "fact_yearmonth": f"""{SILVER}
SELECT OrderDate, strftime(OrderDate, '%Y-%m') AS yearmonth FROM clean""",
    "kpi_monthly": f"{SILVER} {_kpi()} ORDER BY 1",
    "regional_sales_trend": f"""{SILVER},{STORE_VERSIONS}
SELECT CASE WHEN OrderDate < {FIRST_DAY} THEN b.StoreLocation
    ELSE coalesce(a.StoreLocation, b.StoreLocation) END AS StoreLocation,
  strftime(OrderDate, '%Y-%m') AS yearmonth,
  round(fsum(TotalPrice), 2) AS TotalRevenue, sum(Quantity)::BIGINT AS UnitsSold
FROM (SELECT * EXCLUDE (StoreLocation) FROM clean)
LEFT JOIN stores_before b USING (StoreID) LEFT JOIN stores_after a USING (StoreID)
GROUP BY 1, 2""",
    "kpi_monthly_lines": f"""{SILVER}
SELECT strftime(OrderDate, '%Y-%m') AS yearmonth, round(fsum(TotalPrice)) AS TotalRevenue,
  count(DISTINCT OrderID) AS TotalOrders,
  round(fsum(TotalPrice) / count(DISTINCT OrderID)) AS AverageOrderValue,
  count(DISTINCT CustomerID) AS UniqueCustomers
FROM typed WHERE OrderDate IS NOT NULL AND TotalPrice IS NOT NULL GROUP BY 1""",
    "table_exists": f"""{SILVER}, early AS (SELECT * FROM clean WHERE OrderDate < {FIRST_DAY})
SELECT 'dim_customer' AS "Name", true AS "Found", count(*) AS "Rows"
FROM (SELECT DISTINCT CustomerID, CustomerName FROM early)
UNION ALL SELECT 'dim_product', true, count(*)
FROM (SELECT DISTINCT ProductID, ProductName FROM early)
UNION ALL SELECT 'dim_store', true, count(*)
FROM (SELECT DISTINCT StoreID, StoreLocation FROM early)
UNION ALL SELECT 'dim_date', true, count(DISTINCT OrderDate) FROM early
UNION ALL SELECT 'fact_sales', false, 0""",
    "sink_append": f"{SILVER} SELECT *, {FIRST_DAY} AS run_date FROM typed",
    "sink_overwrite_partition": f"""{SILVER}
SELECT *, {FIRST_DAY} AS run_date FROM typed WHERE (OrderDate >= {FIRST_DAY}) IS NOT TRUE
UNION ALL SELECT *, {SECOND_DAY} FROM clean WHERE OrderDate >= {FIRST_DAY}""",
    "sink_overwrite_table": f"""{SILVER},
fact AS ({FACT}), dates AS ({DATES})
SELECT fact.*, CustomerName, ProductName, StoreLocation, dates.* EXCLUDE (OrderDateParsed)
FROM fact
JOIN (SELECT DISTINCT CustomerID, CustomerName FROM clean) USING (CustomerID)
JOIN (SELECT DISTINCT ProductID, ProductName FROM clean) USING (ProductID)
JOIN (SELECT DISTINCT StoreID, StoreLocation FROM clean) USING (StoreID)
JOIN dates ON OrderDate = OrderDateParsed""",
    "sink_schema_merge": f"""{SILVER}
SELECT DISTINCT ProductID, ProductName, NULL::VARCHAR AS Category, {FIRST_DAY} AS run_date
FROM clean
UNION ALL
SELECT DISTINCT ProductID, ProductName, Category, {SECOND_DAY} FROM clean""",
    "sink_schema_log": f"""{SILVER}
SELECT DISTINCT ProductID, ProductName, NULL::VARCHAR AS Category, {FIRST_DAY} AS run_date
FROM clean
UNION ALL
SELECT DISTINCT ProductID, ProductName, Category, {SECOND_DAY} FROM clean""",
    "union_schema_merge": f"""{SILVER}
SELECT * FROM (SELECT DISTINCT ProductID, ProductName FROM clean)
UNION ALL BY NAME
SELECT * FROM (SELECT DISTINCT ProductID, ProductName, Category FROM clean)""",
    "kpi_upsert_month": f"{SILVER} {_kpi()}",
    "kpi_append": f"""{SILVER}
SELECT * FROM ({_kpi(f"OrderDate < {FIRST_DAY}")})
UNION ALL SELECT * FROM ({_kpi(f"OrderDate >= {FIRST_DAY}")})
UNION ALL SELECT * FROM ({_kpi(f"OrderDate >= {FIRST_DAY}")})""",
    "daily_run": f"{SILVER} {_kpi()}",
    "daily_two_extracts": f"{SILVER} {_kpi()}",
    "daily_fact": f"""{SILVER}
SELECT row_number() OVER (ORDER BY {EXTRACT}, OrderID) - 1 AS SalesID, OrderID, OrderDate,
  CustomerID, ProductID, StoreID, Quantity, UnitPrice, TotalPrice, PaymentMethod
FROM clean""",
    "daily_after_lost_day": f"""{SILVER}
SELECT row_number() OVER (ORDER BY OrderID % 3, OrderID) - 1 AS SalesID, OrderID, OrderDate,
  CustomerID, ProductID, StoreID, Quantity, UnitPrice, TotalPrice, PaymentMethod
FROM clean""",
    "fact_order_index": f"""{SILVER}
SELECT row_number() OVER (ORDER BY (OrderID % 3 = 0)::INTEGER, OrderID) - 1 AS SalesID, OrderID,
  strftime(OrderDate, '%Y-%m') AS yearmonth
FROM clean""",
    "kpi_incremental": f"{SILVER} {_kpi()}",
    "daily_history": DAILY_HISTORY,
    "daily_dimensions": f"""{SILVER}
SELECT * FROM (SELECT DISTINCT CustomerID, CustomerName FROM clean)
UNION ALL BY NAME SELECT * FROM (SELECT DISTINCT ProductID, ProductName FROM clean)
UNION ALL BY NAME SELECT * FROM (SELECT DISTINCT StoreID, StoreLocation FROM clean)
UNION ALL BY NAME SELECT * FROM ({DATES})""",
    "scd2_expired": _by_change("expired"),
    "scd2_new_versions": _by_change("new version"),
    "scd2_new_keys": _by_change("new key"),
    "scd2_unchanged": _by_change("unchanged"),
    "scd2_history": _by_change("history"),
    "scd2_bootstrap": f"""{CUSTOMERS}
SELECT *, {SECOND_DAY} AS valid_from, NULL::DATE AS valid_to, true AS is_current FROM incoming""",
    "scd2_current": f"{TAGGED} SELECT * EXCLUDE (change) FROM tagged WHERE is_current",
    "scd2_store_replay": f"{TAGGED} SELECT * EXCLUDE (change) FROM tagged",
    "scd2_store_buckets": f"""{TAGGED}
SELECT * EXCLUDE (change) REPLACE (
    CASE WHEN change IN ('new version', 'new key') AND CustomerID % 2 = 0 THEN {FIRST_DAY} + 1 ELSE valid_from
      END::DATE AS valid_from,
    CASE WHEN change = 'expired' AND CustomerID % 2 = 0 THEN {FIRST_DAY} + 1 ELSE valid_to END::DATE AS valid_to)
FROM tagged""",
    "scd2_changed": _changed(null_safe=False),
    "scd2_changed_nullsafe": _changed(null_safe=True),
    "scd2_apply": f"{TAGGED} SELECT * EXCLUDE (change) FROM tagged",
    "scd2_apply_compat": f"{COMPAT} SELECT * EXCLUDE (change) FROM tagged",
    "scd2_run_metrics": f"""{TAGGED}
SELECT count(*) FILTER (change = 'expired') AS Changed,
  count(*) FILTER (change = 'new key') AS New,
  count(*) FILTER (change = 'unchanged') AS Unchanged,
  count(*) FILTER (change = 'history') AS HistoryKept, {COUNTS}
FROM tagged""",
    "scd2_current_top10": f"""{TAGGED} SELECT * EXCLUDE (change) FROM tagged WHERE is_current
ORDER BY CustomerID LIMIT 10""",
    "scd2_history_top20": f"""{TAGGED} SELECT * EXCLUDE (change) FROM tagged
ORDER BY CustomerID, valid_from DESC LIMIT 20""",
    "scd2_customer": f"{TWO_DAYS['customer']} SELECT * EXCLUDE (change) FROM tagged",
    "scd2_product": f"{TWO_DAYS['product']} SELECT * EXCLUDE (change) FROM tagged",
    "scd2_store": f"{TWO_DAYS['store']} SELECT * EXCLUDE (change) FROM tagged",
    "scd2_composite_key": f"""{SILVER},
existing AS (
  SELECT StoreID, ProductID, sum(Quantity)::BIGINT AS Units, {FIRST_DAY} AS valid_from,
    NULL::DATE AS valid_to, true AS is_current
  FROM clean WHERE OrderDate < {FIRST_DAY} GROUP BY 1, 2),
incoming AS (
  SELECT StoreID, ProductID, sum(Quantity)::BIGINT AS Units
  FROM clean WHERE OrderDate >= {FIRST_DAY} GROUP BY 1, 2),
{_versions(["StoreID", "ProductID"], ["Units"])}
SELECT * EXCLUDE (change) FROM tagged""",
    "scd2_from_history": HISTORY,
    "scd_mixed_types": MIXED,
    "scd2_summary": SUMMARY,
    "scd1_upsert": f"""{CUSTOMERS}
SELECT CustomerID, CASE WHEN i.CustomerID IS NULL THEN e.CustomerName ELSE i.CustomerName END
    AS CustomerName,
  CASE WHEN i.CustomerID IS NULL THEN e.Segment ELSE i.Segment END AS Segment
FROM (SELECT * FROM existing WHERE is_current) e FULL JOIN incoming i USING (CustomerID)""",
    "asof_fact_dim": ASOF,
    "asof_fact_dim_split": ASOF,
    "asof_fact_dim_month": ASOF,
    "asof_carry_forward": ASOF,
}
