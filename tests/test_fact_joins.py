"""The landed export's joins: same rows as the SQL view, narrow shuffles, no fact table sorted; periods as text or number."""

import datetime

from pyspark.sql import functions as F

from importlens.functions.columns import month_start_from_period
from importlens.plans import fixtures as fx


def _tables(spark, folder):
    def write(name, rows, schema):
        spark.createDataFrame(rows, schema).write.parquet(f"{folder}/{name}.parquet")
    day = datetime.datetime
    write("nation", [(0, "NATION_0", 1), (1, "NATION_1", 2), (1, "NATION_1", 2), (None, "none", 3)], "n_nationkey int, n_name string, n_regionkey int")
    write("customer", [(1, 0), (2, 1), (3, None), (4, 9), (None, 0)], "c_custkey long, c_nationkey int")
    write("orders", [(k, k % 5 + 1) for k in range(200)] + [(7, 1), (None, 1), (201, None)], "o_orderkey long, o_custkey long")
    write("part", [(1, 50, "A"), (2, 5, "B"), (2, 7, None), (3, None, "C"), (None, 1, "D")], "p_partkey long, p_size int, p_type string")
    write("lineitem", [(k, k % 4, None if k % 11 == 0 else k + 0.125, None if k % 13 == 0 else day(1995 + k % 5, k % 12 + 1, 28, 23, 59))
                       for k in range(200)] * 2 + [(None, 1, 1.0, day(1995, 1, 1))],
          "l_orderkey long, l_partkey long, l_extendedprice double, l_shipdate timestamp")


def _plain(spark, folder):
    t = {n: fx.table(spark, folder, n) for n in ("lineitem", "orders", "customer", "nation", "part")}
    j = (t["lineitem"].join(t["orders"], F.col("l_orderkey") == F.col("o_orderkey")).join(t["customer"], F.col("o_custkey") == F.col("c_custkey"))
         .join(t["nation"], F.col("c_nationkey") == F.col("n_nationkey")).join(t["part"], F.col("l_partkey") == F.col("p_partkey")))
    return j.selectExpr(
        "n_name", "CASE WHEN p_size = 50 THEN 'TOTAL' ELSE lpad(CAST(p_size AS STRING), 2, '0') END", "p_type",
        "CASE WHEN l_orderkey % 97 = 0 THEN 'N/A' ELSE CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS STRING) END",
        "CASE WHEN l_orderkey % 89 = 0 THEN '201913' ELSE date_format(l_shipdate, 'yyyyMM') END", "n_regionkey")


def test_trade_rows_and_plan(spark, tmp_dir):
    _tables(spark, tmp_dir)
    key = lambda rows: sorted(map(repr, map(tuple, rows)))
    want = key(_plain(spark, tmp_dir).collect())
    assert want
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        for limit in (kept, "-1"):
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
            for rebalance in (False, True):
                assert key(fx.trade_raw(spark, tmp_dir, rebalance).collect()) == want
        plan = fx.trade_raw(spark, tmp_dir, True)._jdf.queryExecution().toString().split("== Physical Plan ==")[1]
        keys = ("l_partkey#", "p_partkey#", "o_orderkey#", "l_orderkey#", "o_custkey#", "c_custkey#")
        sorts = [line for line in plan.splitlines() if "Sort [" in line]
        assert "ShuffledHashJoin" in plan and not any(k in s for s in sorts for k in keys)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)


def test_periods(spark):
    texts = ["201901", "201912", "201913", "201900", "100001", "099912", "000101", "999912", "-20191", "+20191", " 20191", "20191 ", "20191",
             "2019", "2019011", "201901x", "2019-1", "20190.", "201.01", "２０１９０１", "1e5000", "", " ", "N/A", None]
    old = F.concat(F.substring("p", 1, 4), F.lit("-"), F.substring("p", 5, 2), F.lit("-01")).try_cast("date")
    rows = spark.createDataFrame([(t,) for t in texts], "p string").select("p", month_start_from_period("p").alias("new"), old.alias("old")).collect()
    assert all(r.new == r.old for r in rows), [r for r in rows if r.new != r.old]
    numbers = spark.createDataFrame([(201905,), (None,), (201913,)], "p int").select(month_start_from_period("p").alias("m")).collect()
    assert [r.m for r in numbers] == [datetime.date(2019, 5, 1), None, None]
