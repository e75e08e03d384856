"""Raw-input views built from the driver's TPC-H-style tables.

The engine's inputs (landed trade exports, indicator rows, county business
files) are presented as views over the driver tables so that every query's
work grows with them. The same definitions exist twice -- as DataFrame code
(``trade_raw`` ...) and as SQL text (``SQL_VIEWS``) for the independent
oracle -- and must stay in step.

Malformed cells are injected on purpose (a value ``'N/A'``, a month ``13``,
a suppressed employment ``'D'``); those rows stay in the views and are
removed, or not, by the cleaning operators under test.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from importlens import config
from importlens.functions.columns import mean
from importlens.functions.exact import sql_exact_sum
from importlens.operators.joins import broadcast_if_small, hashed_if_large

# Fixture parameters: the driver tables know nations, not ISO codes.
BASELINE = "NATION_1"
TARGET = "NATION_2"
HOSTS = ["NATION_2", "NATION_3", "NATION_4"]
GDP = "purchase"
INDICATOR_NAMES = ["click", "error", "purchase", "signup", "view"]
PULL_PLAN = {BASELINE: [1995, 1996, 1997, 1998],
             **{h: [1999, 2000, 2001] for h in HOSTS}}
INDICATOR_YEARS = list(range(5, 26))
COVERAGE_YEARS = list(range(1, 32))
TREND_YEARS = [1996, 1997]
HOSTS_SELECTED = HOSTS + ["NATION_25"]
N_INDICATOR_COUNTRIES = 27          # two more than nations: they have no trade
MEASURE = "double"                  # as published; sums are order-free (functions.exact)
NATION_NAMES = [f"NATION_{i}" for i in range(25)]   # the nation table's fixed names
NAICS_CYCLE = ["23", "42", "44", "45", "48", "49", "71", "72", "31"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def trade_raw(spark: SparkSession, sf_dir: str, rebalance: bool = False) -> DataFrame:
    """Landed trade export: one row per line item, importer = customer's nation.

    Columns use the export's own names (``cmdCode``, ``primaryValue``,
    ``period``) and are all text; ``region_key`` is kept for slicing tests.
    Only numbers and the part's type go through the shuffles: what hangs on the
    order's key is worked out where that key is read, texts and the nation's
    columns come last. ``rebalance`` deals the rows by country before that.
    """
    order_key = F.col("l_orderkey")
    shipped = F.col("l_shipdate").cast("date")
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_extendedprice",
        F.when(order_key % 89 == 0, F.lit(201913)).otherwise(F.year(shipped) * 100 + F.month(shipped)).alias("period"))
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    cust = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_size", "p_type")
    order_nation = orders.join(hashed_if_large(cust), orders.o_custkey == cust.c_custkey).select("o_orderkey", "c_nationkey")
    ordered = li.join(order_nation.hint("shuffle_hash"), li.l_orderkey == order_nation.o_orderkey).select(
        "l_partkey", "l_extendedprice", "period", "c_nationkey", (order_key % 97 == 0).alias("unpriced"))
    joined = ordered.join(hashed_if_large(part), ordered.l_partkey == part.p_partkey).select(
        "c_nationkey", "p_size", "p_type", "l_extendedprice", "unpriced", "period")
    if rebalance:
        joined = joined.hint("rebalance", "c_nationkey")
    named = joined.join(broadcast_if_small(nation), joined.c_nationkey == nation.n_nationkey)
    return named.select(
        F.col("n_name").alias("country_iso3"),
        F.when(F.col("p_size") == 50, F.lit(config.ROLLUP_CODE))
         .otherwise(F.lpad(F.col("p_size").cast("string"), 2, "0")).alias("cmdCode"),
        F.col("p_type").alias("cmdDesc"),
        F.when(F.col("unpriced"), F.lit("N/A"))
         .otherwise(F.col("l_extendedprice").cast("decimal(18,2)").cast("string")).alias("primaryValue"),
        F.col("period").cast("string").alias("period"),
        F.col("n_regionkey").alias("region_key"),
    )


def indicator_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed indicator rows from events: country by user, indicator by event type."""
    ev = table(spark, sf_dir, "events")
    iso = F.concat(F.lit("NATION_"), (F.col("user_id") % N_INDICATOR_COUNTRIES).cast("string"))
    return ev.select(
        iso.alias("country_iso3"),
        F.concat(F.lit("Country "), iso).alias("country_name"),
        F.dayofmonth("ts").alias("year"),
        F.concat(F.lit("EV."), F.upper("event_type")).alias("indicator_code"),
        F.col("event_type").alias("indicator_name"),
        F.when(F.col("event_id") % 10 == 0, F.lit(None).cast("string"))
         .otherwise(F.col("value").cast("decimal(18,2)").cast("string")).alias("value"),
    )


def county_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """County business file from suppliers, with messy lower-case headers."""
    s = table(spark, sf_dir, "supplier")
    naics = F.element_at(F.array(*[F.lit(c) for c in NAICS_CYCLE]),
                         (F.col("s_suppkey") % len(NAICS_CYCLE) + 1).cast("int"))
    bal = F.col("s_acctbal").cast("decimal(18,2)")
    return s.select(
        F.col("s_nationkey").cast("string").alias(" fipstate "),
        (F.col("s_suppkey") % 5).cast("string").alias("fipscty"),
        F.concat(naics, F.lit("----")).alias("naics"),
        F.col("s_suppkey").cast("string").alias("est"),
        F.when(F.col("s_suppkey") % 13 == 0, F.lit("D")).otherwise(bal.cast("string")).alias("emp"),
        (bal * 10).cast("string").alias("ap"),
    )


def host_county_rows() -> list[tuple[str, str, str]]:
    """States 0-10 x counties 0-4 as host counties (55 rows, fixed)."""
    return [(f"City {s:02d}{c:03d}", f"S{s:02d}", f"{s:02d}{c:03d}")
            for s in range(11) for c in range(5)]


def indicator_dim_rows() -> list[tuple[str, str]]:
    return [(f"EV.{n.upper()}", n) for n in INDICATOR_NAMES]


def indicator_payloads(rows: DataFrame) -> DataFrame:
    """Landed JSON responses, one per (country, indicator code), from cleaned indicator rows.

    Each response carries one item per year (the year's average, as an API
    returns one value per year), so a payload holds at most 31 items.
    Beside them, countries ending in 7 land a response ``[meta]`` and those
    ending in 8 ``[meta, null]``: the two shapes that must yield no rows.
    """
    per_year = (rows.groupBy("country_iso3", "country_name", "indicator_code", "year")
                .agg(mean(rows, "value").alias("value")))
    item = F.struct(F.struct(F.col("country_name").alias("value")).alias("country"),
                    F.col("year").cast("string").alias("date"),
                    F.col("value").alias("value"))
    grouped = (per_year.groupBy("country_iso3", "indicator_code")
               .agg(F.collect_list(item).alias("items")))
    meta = F.to_json(F.struct(F.lit(1).alias("page"), F.lit(1).alias("pages"),
                              F.col("indicator_code").alias("indicator")))
    payload = F.concat(F.lit("["), meta, F.lit(","), F.to_json("items"), F.lit("]"))
    empty = (F.when(F.col("country_iso3").endswith("7"), F.concat(F.lit("["), meta, F.lit("]")))
             .when(F.col("country_iso3").endswith("8"), F.concat(F.lit("["), meta, F.lit(",null]"))))
    shapes = F.explode(F.filter(F.array(payload, empty), lambda x: x.isNotNull()))
    return grouped.select("country_iso3", "indicator_code", shapes.alias("payload"))


# ----------------------------------------------------------- oracle SQL -----

def _values(rows: list[tuple], names: list[str]) -> str:
    def lit(v):
        return "'" + str(v).replace("'", "''") + "'" if isinstance(v, str) else str(v)
    body = ", ".join("(" + ", ".join(lit(v) for v in r) + ")" for r in rows)
    return f"(VALUES {body}) AS t({', '.join(names)})"


SQL_VIEWS = {
    "trade_raw": f"""
SELECT n.n_name AS country_iso3,
       CASE WHEN p.p_size = 50 THEN '{config.ROLLUP_CODE}' ELSE lpad(CAST(p.p_size AS VARCHAR), 2, '0') END AS cmdCode,
       p.p_type AS cmdDesc,
       CASE WHEN l.l_orderkey % 97 = 0 THEN 'N/A'
            ELSE CAST(CAST(l.l_extendedprice AS DECIMAL(18,2)) AS VARCHAR) END AS primaryValue,
       CASE WHEN l.l_orderkey % 89 = 0 THEN '201913' ELSE strftime(l.l_shipdate, '%Y%m') END AS period,
       n.n_regionkey AS region_key
FROM lineitem l
JOIN orders o ON l.l_orderkey = o.o_orderkey
JOIN customer c ON o.o_custkey = c.c_custkey
JOIN nation n ON c.c_nationkey = n.n_nationkey
JOIN part p ON l.l_partkey = p.p_partkey""",
    "trade_clean": """
SELECT * FROM (
  SELECT country_iso3, cmdCode AS commodity_code, cmdDesc AS commodity_desc,
         TRY_CAST(primaryValue AS DOUBLE) AS trade_value,
         TRY_CAST(substr(period, 1, 4) || '-' || substr(period, 5, 2) || '-01' AS DATE) AS month_date
  FROM trade_raw) s
WHERE trade_value IS NOT NULL AND month_date IS NOT NULL""",
    "trade": f"""
SELECT * FROM trade_clean WHERE commodity_code <> '{config.ROLLUP_CODE}'""",
    "indicator_raw": f"""
SELECT 'NATION_' || CAST(user_id % {N_INDICATOR_COUNTRIES} AS VARCHAR) AS country_iso3,
       'Country NATION_' || CAST(user_id % {N_INDICATOR_COUNTRIES} AS VARCHAR) AS country_name,
       CAST(dayofmonth(ts) AS INTEGER) AS year,
       'EV.' || upper(event_type) AS indicator_code,
       event_type AS indicator_name,
       CASE WHEN event_id % 10 = 0 THEN NULL
            ELSE CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR) END AS value
FROM events""",
    "indicators": """
SELECT country_iso3, country_name, year, indicator_code, indicator_name,
       TRY_CAST(value AS DOUBLE) AS value
FROM indicator_raw""",
    "host_county": "SELECT * FROM " + _values(host_county_rows(), ["city", "state_abbr", "state_county_fips"]),
    "sectors": "SELECT * FROM " + _values(list(config.NAICS_SECTORS.items()), ["naics_prefix", "industry_group"]),
    "hs2": "SELECT * FROM " + _values(list(config.HS2_LABELS.items()), ["hs2", "label"]),
    "county_raw": f"""
SELECT CAST(s_nationkey AS VARCHAR) AS state_txt,
       CAST(s_suppkey % 5 AS VARCHAR) AS county_txt,
       ([{", ".join(repr(c) for c in NAICS_CYCLE)}])[CAST(s_suppkey % {len(NAICS_CYCLE)} + 1 AS INTEGER)] || '----' AS naics_code,
       CAST(s_suppkey AS VARCHAR) AS est_txt,
       CASE WHEN s_suppkey % 13 = 0 THEN 'D' ELSE CAST(CAST(s_acctbal AS DECIMAL(18,2)) AS VARCHAR) END AS emp_txt,
       CAST(CAST(s_acctbal AS DECIMAL(18,2)) * 10 AS VARCHAR) AS ap_txt
FROM supplier""",
    "county": """
SELECT h.city, h.state_abbr, k.state_county_fips, k.naics_code, k.naics_prefix, g.industry_group,
       TRY_CAST(k.est_txt AS DOUBLE) AS establishments,
       CASE WHEN regexp_matches(k.emp_txt, '^\\s*[+-]?(\\d+(\\.\\d*)?|\\.\\d+)([eE][+-]?\\d+)?\\s*$')
            THEN TRY_CAST(trim(k.emp_txt) AS DOUBLE) END AS employment,
       TRY_CAST(k.ap_txt AS DOUBLE) AS annual_payroll
FROM (SELECT *,
             CASE WHEN length(state_txt) < 2 THEN lpad(state_txt, 2, '0') ELSE state_txt END ||
             CASE WHEN length(county_txt) < 3 THEN lpad(county_txt, 3, '0') ELSE county_txt END AS state_county_fips,
             substr(naics_code, 1, 2) AS naics_prefix
      FROM county_raw) k
JOIN host_county h ON k.state_county_fips = h.state_county_fips
JOIN sectors g ON k.naics_prefix = g.naics_prefix""",
}

_VIEW_ORDER = ["trade_raw", "trade_clean", "trade", "indicator_raw", "indicators",
               "host_county", "sectors", "hs2", "county_raw", "county"]
_VIEW_DEPS = {
    "trade_clean": ["trade_raw"], "trade": ["trade_clean"], "indicators": ["indicator_raw"],
    "county": ["county_raw", "host_county", "sectors"],
}


def exact_sums(sql: str) -> str:
    """``EXACT_SUM(x)``, with or without FILTER or OVER, written out (see ``functions.exact``)."""
    at = sql.find("EXACT_SUM(")
    while at >= 0:
        value, end = _bracket(sql, at + len("EXACT_SUM"))
        where, over = None, None
        if sql.startswith(" FILTER (", end):
            where, end = _bracket(sql, end + len(" FILTER "))
            where = where.removeprefix("WHERE ")
        if sql.startswith(" OVER (", end):
            inner, end = _bracket(sql, end + len(" OVER "))
            over = f"OVER ({inner})"
        sql = sql[:at] + sql_exact_sum(value, where, over) + sql[end:]
        at = sql.find("EXACT_SUM(", at)
    return sql


def _bracket(sql: str, at: int) -> tuple[str, int]:
    """Text of the bracket that opens at ``at``, and the place behind it."""
    depth = 0
    for i in range(at, len(sql)):
        depth += (sql[i] == "(") - (sql[i] == ")")
        if depth == 0:
            return sql[at + 1:i], i + 1
    raise ValueError(f"open bracket in {sql[at:at + 40]}")


def with_views(body: str, *views: str, extra: list[str] | None = None) -> str:
    """Prefix ``body`` with the CTEs it needs (and what those need).

    ``extra`` are further ``name AS (...)`` CTEs placed after the views.
    """
    need: set[str] = set()

    def add(v: str) -> None:
        if v not in need:
            need.add(v)
            for d in _VIEW_DEPS.get(v, []):
                add(d)

    for v in views:
        add(v)
    ctes = [f"{v} AS ({SQL_VIEWS[v]}\n)" for v in _VIEW_ORDER if v in need] + list(extra or [])
    return exact_sums("WITH " + ",\n".join(ctes) + "\n" + body)
