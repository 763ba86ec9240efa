"""DuckDB SQL for the registered queries of the retail workload.

The results are computed from their definitions, not the way the Spark plans
do: money is counted in whole cents, calendar labels come from a generated
calendar, a rank is one more than the number of greater totals, and gaps come
from joining each day of a customer to the next later one.
"""

from __future__ import annotations

# ---------------------------------------------------------------------
# Sales: ``fact`` (one row per order line) and ``person``, over either model.
# ---------------------------------------------------------------------

STAR = """
fact AS (
  SELECT o_custkey AS CustomerID, l_partkey AS ProductID, p_name AS ProductName,
         CAST(p_retailprice AS DOUBLE) AS Price, CAST(l_quantity AS BIGINT) AS Qty,
         CAST(o_orderdate AS DATE) AS Day,
         CAST(round(p_retailprice * 100) AS BIGINT) * CAST(l_quantity AS BIGINT) AS Cents
  FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN part ON p_partkey = l_partkey),
person AS (
  SELECT c_custkey AS CustomerID, c_name AS Name, c_name AS FirstName, '' AS LastName,
         n_name AS Country, r_name AS Region
  FROM customer JOIN nation ON n_nationkey = c_nationkey
                JOIN region ON r_regionkey = n_regionkey)"""

# What the round trip must build, by the rules of orderlens.plans.wide_fixture.
TABLES = """
entry AS (
  SELECT o_orderkey, o_custkey, CAST(o_orderdate AS DATE) AS Day, CAST(l_quantity AS BIGINT) AS Qty,
         row_number() OVER (PARTITION BY o_orderkey
                            ORDER BY l_linenumber, l_partkey, l_quantity) AS pos,
         count(*) OVER (PARTITION BY o_orderkey) AS n,
         p_name || ' ' || lpad(CAST(p_partkey AS VARCHAR), 8, '0') AS PName, p_type AS Cat,
         CAST(round(p_retailprice * 100) AS BIGINT)
           + CASE WHEN o_orderkey % 17 = 3 THEN 100 ELSE 0 END AS Cents
  FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN part ON p_partkey = l_partkey),
wide AS (
  SELECT o_orderkey,
         replace(c_name, '#', CASE o_custkey % 11 WHEN 4 THEN '  ' WHEN 6 THEN '-' ELSE ' ' END) AS Raw,
         c_mktsegment || ', ' || CAST(c_custkey AS VARCHAR) AS Address,
         'City ' || CAST(c_nationkey AS VARCHAR) AS City, n_name AS CountryName,
         CASE WHEN o_orderkey % 13 = 5 THEN 'Elsewhere' ELSE r_name END AS RegionName
  FROM (SELECT DISTINCT o_orderkey, o_custkey FROM entry) JOIN customer ON c_custkey = o_custkey
       JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey),
Region_t AS (
  SELECT CAST(row_number() OVER (ORDER BY RegionName) AS BIGINT) AS RegionID, RegionName AS Region
  FROM (SELECT DISTINCT RegionName FROM wide)),
Country_t AS (
  SELECT CAST(row_number() OVER (ORDER BY CountryName) AS BIGINT) AS CountryID,
         CountryName AS Country, RegionID
  FROM (SELECT CountryName, arg_min(RegionName, o_orderkey) AS first_region FROM wide GROUP BY 1)
       JOIN Region_t ON Region = first_region),
Customer_t AS (
  SELECT CAST(row_number() OVER (ORDER BY FirstName, LastName, o_orderkey) AS BIGINT) AS CustomerID,
         FirstName, LastName, Address, City, CountryID
  FROM (SELECT *, regexp_extract(Raw, '^[^ ]+') AS FirstName,
               ltrim(regexp_replace(Raw, '^[^ ]+', '')) AS LastName FROM wide)
       JOIN Country_t ON Country = CountryName),
Category_t AS (
  SELECT CAST(row_number() OVER (ORDER BY Cat) AS BIGINT) AS ProductCategoryID,
         Cat AS ProductCategory, 'Parts of type ' || Cat AS ProductCategoryDescription
  FROM (SELECT DISTINCT Cat FROM entry WHERE o_orderkey IN (SELECT o_orderkey FROM wide))),
Product_t AS (
  SELECT CAST(row_number() OVER (ORDER BY PName, seen) AS BIGINT) AS ProductID, PName AS ProductName,
         Cents / 100.0 AS ProductUnitPrice, ProductCategoryID
  FROM (SELECT PName, Cat, Cents, min(o_orderkey * 1000 + pos) AS seen FROM entry
        WHERE o_orderkey IN (SELECT o_orderkey FROM wide)
          AND NOT (o_orderkey % 23 = 9 AND n > 1 AND pos = n) GROUP BY ALL)
       JOIN Category_t ON ProductCategory = Cat),
CustomerName AS (
  SELECT FirstName || ' ' || LastName AS Name, max(CustomerID) AS CustomerID FROM Customer_t GROUP BY 1),
ProductKey AS (SELECT ProductName, max(ProductID) AS ProductID FROM Product_t GROUP BY 1),
OrderDetail_t AS (
  SELECT CAST(row_number() OVER (ORDER BY o_orderkey, pos) AS BIGINT) AS OrderID, CustomerID, ProductID,
         Day AS OrderDate, Qty AS QuantityOrdered
  FROM entry JOIN wide USING (o_orderkey) JOIN CustomerName ON Name = Raw
       JOIN ProductKey ON ProductName = PName
  WHERE NOT (o_orderkey % 29 = 11 AND n > 1 AND pos = n))"""

NORMALIZED = TABLES + """,
fact AS (
  SELECT d.CustomerID, d.ProductID, ProductName, ProductUnitPrice AS Price, QuantityOrdered AS Qty,
         OrderDate AS Day, CAST(round(ProductUnitPrice * 100) AS BIGINT) * QuantityOrdered AS Cents
  FROM OrderDetail_t d JOIN Product_t USING (ProductID)),
person AS (
  SELECT CustomerID, FirstName || ' ' || LastName AS Name, FirstName, LastName, Country, Region
  FROM Customer_t JOIN Country_t USING (CountryID) JOIN Region_t USING (RegionID))"""

_CALENDAR = """,
calendar AS (
  SELECT CAST(d AS DATE) AS Day, CAST(strftime(d, '%Y') AS BIGINT) AS Year, strftime(d, '%B') AS Month,
         'Q' || CAST(1 + date_diff('month', date_trunc('year', d), d) // 3 AS VARCHAR) AS Quarter
  FROM (SELECT unnest(generate_series(CAST(min(Day) AS TIMESTAMP), CAST(max(Day) AS TIMESTAMP),
                                      INTERVAL 1 DAY)) AS d FROM fact))"""

# Half a unit away from zero, from cents; amounts are positive.
_UNITS = "CAST((sum(Cents) + 50) // 100 AS DOUBLE)"
_MONEY = "CAST(sum(Cents) AS DOUBLE) / 100"

_COUNTRY_SUMS = """,
country_sum AS (
  SELECT Region, Country, sum(Cents) AS c, CAST((sum(Cents) + 50) // 100 AS DOUBLE) AS CountryTotal
  FROM fact JOIN person USING (CustomerID) GROUP BY Region, Country)"""

_QUARTER_SUMS = _CALENDAR + f""",
quarter_sum AS (
  SELECT Quarter, Year, CustomerID, {_UNITS} AS Total
  FROM fact JOIN calendar USING (Day) GROUP BY Quarter, Year, CustomerID)"""


def sales(base: str, customer: str) -> dict[str, str]:
    """The eleven sales queries over ``fact`` and ``person``."""
    chosen = f"(SELECT max(CustomerID) FROM person WHERE Name = '{customer}')"
    return {
        "customer_orders": f"""WITH {base}
SELECT Name, ProductName, Day AS OrderDate, Price AS ProductUnitPrice, Qty AS QuantityOrdered,
       CAST(Cents AS DOUBLE) / 100 AS Total
FROM fact JOIN person USING (CustomerID) WHERE CustomerID = {chosen}""",
        "customer_total": f"""WITH {base}
SELECT any_value(Name) AS Name, {_MONEY} AS Total
FROM fact JOIN person USING (CustomerID) WHERE CustomerID = {chosen} GROUP BY CustomerID""",
        "totals_by_customer": f"""WITH {base}
SELECT any_value(Name) AS Name, {_MONEY} AS Total
FROM fact JOIN person USING (CustomerID) GROUP BY CustomerID""",
        "totals_by_region": f"""WITH {base}
SELECT Region, {_MONEY} AS Total FROM fact JOIN person USING (CustomerID) GROUP BY Region""",
        "totals_by_country": f"""WITH {base}
SELECT Country, {_UNITS} AS CountryTotal
FROM fact JOIN person USING (CustomerID) GROUP BY Country""",
        "country_rank": f"""WITH {base}{_COUNTRY_SUMS}
SELECT Region, Country, CountryTotal,
       1 + (SELECT count(*) FROM country_sum o
            WHERE o.Region = s.Region AND o.CountryTotal > s.CountryTotal) AS CountryRegionalRank
FROM country_sum s""",
        "top_country": f"""WITH {base}{_COUNTRY_SUMS}
SELECT Region, Country, CountryTotal, CAST(1 AS BIGINT) AS CountryRegionalRank
FROM country_sum WHERE (Region, c) IN (SELECT Region, max(c) FROM country_sum GROUP BY Region)""",
        "customer_quarter_totals": f"""WITH {base}{_QUARTER_SUMS}
SELECT * FROM quarter_sum""",
        "top5_customers": f"""WITH {base}{_QUARTER_SUMS},
beaten AS (
  SELECT s.Quarter, s.Year, s.CustomerID, any_value(s.Total) AS Total, count(o.CustomerID) AS by_others
  FROM quarter_sum s LEFT JOIN quarter_sum o
    ON o.Quarter = s.Quarter AND o.Year = s.Year AND o.Total > s.Total
  GROUP BY s.Quarter, s.Year, s.CustomerID)
SELECT Quarter, Year, CustomerID, Total, by_others + 1 AS CustomerRank FROM beaten WHERE by_others < 5""",
        "month_rank": f"""WITH {base}{_CALENDAR},
month_sum AS (
  SELECT Month, CAST(sum((Cents + 50) // 100) AS DOUBLE) AS Total
  FROM fact JOIN calendar USING (Day) GROUP BY Month)
SELECT Month, Total,
       1 + (SELECT count(*) FROM month_sum o WHERE o.Total > s.Total) AS TotalRank FROM month_sum s""",
        "longest_gap": f"""WITH {base},
days AS (SELECT CustomerID, Day, count(*) AS n FROM fact GROUP BY CustomerID, Day),
step AS (
  SELECT e.CustomerID, e.Day AS PreviousOrderDate, min(l.Day) AS OrderDate
  FROM days e JOIN days l ON l.CustomerID = e.CustomerID AND l.Day > e.Day GROUP BY e.CustomerID, e.Day),
longest AS (
  SELECT * FROM step s WHERE NOT EXISTS (
    SELECT 1 FROM step o WHERE o.CustomerID = s.CustomerID
      AND (o.OrderDate - o.PreviousOrderDate > s.OrderDate - s.PreviousOrderDate
           OR (o.OrderDate - o.PreviousOrderDate = s.OrderDate - s.PreviousOrderDate
               AND o.OrderDate < s.OrderDate)))),
one_day AS (
  SELECT CustomerID, min(Day) AS Day, sum(n) AS n FROM days GROUP BY CustomerID HAVING count(*) = 1),
gap AS (
  SELECT CustomerID, OrderDate, PreviousOrderDate FROM longest
  UNION ALL
  SELECT CustomerID, Day, Day FROM (SELECT *, unnest(range(CAST(n - 1 AS BIGINT))) FROM one_day))
SELECT CustomerID, FirstName, LastName, Country, OrderDate, PreviousOrderDate,
       CAST(OrderDate - PreviousOrderDate AS DOUBLE) AS MaxDaysWithoutOrder
FROM gap JOIN person USING (CustomerID)""",
    }


SALES_NAMES = {
    "customer_orders": ("q01_customer_orders", "r01_customer_orders_normalized"),
    "customer_total": ("q02_customer_total", "r02_customer_total_normalized"),
    "totals_by_customer": ("q03_totals_by_customer", "r03_totals_by_customer_normalized"),
    "totals_by_region": ("q04_totals_by_region", "r04_totals_by_region_normalized"),
    "totals_by_country": ("q05_totals_by_country", "r05_totals_by_country_normalized"),
    "country_rank": ("q06_country_rank_in_region", "r06_country_rank_normalized"),
    "top_country": ("q07_top_country_per_region", "r07_top_country_per_region_normalized"),
    "customer_quarter_totals": ("q08_customer_quarter_totals",
                                "r08_customer_quarter_totals_normalized"),
    "top5_customers": ("q09_top5_customers_per_quarter", "r09_top5_customers_per_quarter_normalized"),
    "month_rank": ("q10_month_rank", "r10_month_rank_normalized"),
    "longest_gap": ("q11_longest_order_gap", "r11_longest_order_gap_normalized"),
}

_TABLE_OF = {"Region": "Region_t", "Country": "Country_t", "Customer": "Customer_t",
             "ProductCategory": "Category_t", "Product": "Product_t", "OrderDetail": "OrderDetail_t"}


def _tables_sql(body: str) -> str:
    return f"WITH {TABLES}\n{body}"


def _lookup(table: str, key: str, id_col: str) -> str:
    return _tables_sql(f"SELECT {key}, max({id_col}) AS {id_col} FROM {_TABLE_OF[table]} GROUP BY {key}")


def normalized(first_n: int) -> dict[str, str]:
    every = lambda t: _tables_sql(f"SELECT * FROM {_TABLE_OF[t]}")
    return {
        "n01_region": every("Region"),
        "n02_region_lookup": _lookup("Region", "Region", "RegionID"),
        "n03_country": every("Country"),
        "n04_country_lookup": _lookup("Country", "Country", "CountryID"),
        "n05_customer": every("Customer"),
        "n06_customer_lookup": _tables_sql("SELECT Name, CustomerID FROM CustomerName"),
        "n07_product_category": every("ProductCategory"),
        "n08_product_category_lookup": _lookup("ProductCategory", "ProductCategory", "ProductCategoryID"),
        "n09_product": every("Product"),
        "n10_product_lookup": _tables_sql("SELECT ProductName, ProductID FROM ProductKey"),
        "n11_order_detail": every("OrderDetail"),
        "n12_rejects": _tables_sql(
            "SELECT 'unknown customer: ' || Raw AS reason, count(*) AS n FROM wide "
            "WHERE NOT EXISTS (SELECT 1 FROM CustomerName WHERE Name = Raw) GROUP BY Raw "
            "UNION ALL "
            "SELECT CASE WHEN ProductID IS NULL THEN 'unknown product: ' || PName ELSE 'missing or bad date' END, count(*) "
            "FROM entry JOIN wide USING (o_orderkey) JOIN CustomerName ON Name = Raw "
            "LEFT JOIN ProductKey ON ProductName = PName "
            "WHERE ProductID IS NULL OR (o_orderkey % 29 = 11 AND entry.n > 1 AND pos = entry.n) GROUP BY 1"),
        "s5_published_rows": _tables_sql(" UNION ALL ".join(
            f"SELECT '{t}' AS table_name, count(*) AS n_rows FROM {of}" for t, of in _TABLE_OF.items())),
        "s8_csv_rejects": _tables_sql(
            "SELECT 'Product' AS table_name, CAST(ProductID AS VARCHAR) || ',' "
            "|| CASE WHEN contains(ProductName, ',') THEN '\"' || ProductName || '\"' ELSE ProductName END "
            "|| ',n/a,' || CAST(ProductCategoryID AS VARCHAR) AS line, 'ProductUnitPrice' AS bad_columns "
            "FROM Product_t WHERE ProductID % 37 = 5"),
        "w4_order_rank": "SELECT o_orderkey, o_totalprice, RANK() OVER (ORDER BY o_totalprice DESC) AS TotalRank FROM orders",
        "w1_order_rank_in_status": "SELECT o_orderkey, o_orderstatus, o_totalprice, "
                                   "RANK() OVER (PARTITION BY o_orderstatus ORDER BY o_totalprice DESC) AS StatusRank FROM orders",
        "w3_customer_rank_in_quarter": f"WITH {STAR}{_QUARTER_SUMS} SELECT Quarter, Year, CustomerID, Total, "
                                       "RANK() OVER (PARTITION BY Quarter, Year ORDER BY Total DESC) AS CustomerRank FROM quarter_sum",
        "a10_count": _tables_sql("SELECT count(*) AS n FROM OrderDetail_t"),
        "o4_first_n": _tables_sql(f"SELECT * FROM OrderDetail_t WHERE OrderID <= {first_n}"),
        "s8_golden_csv": every("Product"),
    }


def quality(columns: dict, keys: dict, foreign_keys, star_columns: dict, star_keys: dict,
            star_foreign_keys) -> dict[str, str]:
    """Integrity checks; columns, keys and foreign keys of the six tables and of the star schema."""
    def nulls(cols: dict, of=lambda t: t) -> str:
        return " UNION ALL ".join(
            f"SELECT '{t}' AS table_name, '{c}' AS column_name, count(*) - count({c}) AS null_count "
            f"FROM {of(t)}" for t, cs in cols.items() for c in cs)

    def duplicates(ks: dict, of=lambda t: t) -> str:
        return " UNION ALL ".join(
            f"SELECT '{t}' AS table_name, concat_ws('|', {', '.join(f'CAST({k} AS VARCHAR)' for k in k_)}) AS key, "
            f"count(*) AS n FROM {of(t)} GROUP BY {', '.join(k_)} HAVING count(*) > 1" for t, k_ in ks.items())

    def orphans(fks, of=lambda t: t) -> str:
        return " UNION ALL ".join(
            f"SELECT '{label}' AS relation, CAST(c.{cc} AS VARCHAR) AS key, count(*) AS n "
            f"FROM {of(c)} c WHERE c.{cc} IS NOT NULL AND NOT EXISTS "
            f"(SELECT 1 FROM {of(p)} p WHERE p.{pc} = c.{cc}) GROUP BY c.{cc}"
            for label, c, cc, p, pc in fks)

    own = _TABLE_OF.get
    return {
        "c1_nulls": _tables_sql(nulls(columns, own)),
        "c2_duplicates": _tables_sql(duplicates(keys, own)),
        "c3_orphans": _tables_sql(orphans(foreign_keys, own)),
        "c1_star_nulls": nulls(star_columns),
        "c1_order_totals": nulls({"order_totals": ["o_orderkey", "o_custkey", "o_orderdate", "n_lines", "quantity"]},
                                 lambda t: "(SELECT o_orderkey, o_custkey, o_orderdate, n_lines, quantity FROM orders LEFT JOIN "
                                           "(SELECT l_orderkey, count(*) AS n_lines, sum(l_quantity) AS quantity "
                                           "FROM lineitem GROUP BY l_orderkey) ON l_orderkey = o_orderkey)"),
        "c2_star_duplicates": duplicates(star_keys),
        "c3_star_orphans": orphans(star_foreign_keys),
    }
