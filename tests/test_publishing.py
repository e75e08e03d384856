"""Published sets: all or nothing, readable while a run is under way, old ones removed."""

import os

import pytest
from pyspark.sql import functions as F

from importlens.operators.clean import clean_trade_frame, drop_incomplete, typed_trade
from importlens.operators.harmonize import concat_layouts, harmonize_layouts, union_all_by_name
from importlens.operators.report import sample_rows
from importlens.plans import catalog, publishing
from importlens.sinks.files import write_parquet


def _write(name, df, folder):
    write_parquet(df, folder + "/parquet")


def _tables(spark, n):
    return {t: spark.range(n).withColumn("t", F.lit(t)) for t in ("a", "b")}


def _sizes(spark, out):
    return {n: df.count() for n, df in publishing.read_set(spark, out).items()}


def test_failed_run_leaves_the_set(spark, tmp_dir):
    with pytest.raises(FileNotFoundError):
        publishing.current(spark, tmp_dir)
    publishing.publish_set(_tables(spark, 3), tmp_dir, _write)
    broken = _tables(spark, 5) | {"b": spark.range(5).select(F.raise_error(F.lit("no")).cast("string").alias("x"))}
    with pytest.raises(Exception, match="no"):
        publishing.publish_set(broken, tmp_dir, _write)
    assert _sizes(spark, tmp_dir) == {"a": 3, "b": 3} and publishing.current(spark, tmp_dir)["number"] == 1
    held = publishing.read_set(spark, tmp_dir)
    publishing.publish_set(_tables(spark, 7), tmp_dir, _write)
    assert _sizes(spark, tmp_dir) == {"a": 7, "b": 7}
    assert {n: df.count() for n, df in held.items()} == {"a": 3, "b": 3}      # a reader of the set before goes on


def test_two_runs_cannot_take_one_number(spark, tmp_dir):
    publishing.publish_set(_tables(spark, 1), tmp_dir, _write)

    def slow(name, df, folder):
        _write(name, df, folder)
        if name == "a":      # another run publishes meanwhile
            publishing.publish_set(_tables(spark, 2), tmp_dir, _write)
    with pytest.raises(Exception, match="exist"):
        publishing.publish_set(_tables(spark, 3), tmp_dir, slow)
    assert _sizes(spark, tmp_dir) == {"a": 2, "b": 2}


def test_old_sets_are_removed(spark, tmp_dir):
    for n in range(1, 6):
        publishing.publish_set(_tables(spark, n), tmp_dir, _write, keep=2)
    assert sorted(x for x in os.listdir(f"{tmp_dir}/results/manifests") if x.endswith(".json")) == ["4.json", "5.json"]
    assert len(os.listdir(f"{tmp_dir}/results/sets")) == 2 and _sizes(spark, tmp_dir) == {"a": 5, "b": 5}


def test_layouts_in_one_pass_equal_frames_one_by_one(spark):
    headers = {"x": ["cmdCode", "cmdDesc", "TradeValue", "primaryValue", "period"], "y": ["cmdCode", "fobvalue", "extract_period", "country_iso3"],
               "z": ["cmdCode", "cifvalue", "period", "extract_period"]}
    names = sorted({c for h in headers.values() for c in h})
    rows = [("xyz"[i % 3], *[f"20220{1 + i % 9}" if "period" in c else str(i) for c in names]) for i in range(60)]
    df = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in ["layout", *names]))
    one = drop_incomplete(typed_trade(harmonize_layouts(df, "layout", headers)))
    each = drop_incomplete(union_all_by_name([clean_trade_frame(df.where(F.col("layout") == k).select(*h)) for k, h in headers.items()]))
    assert sorted(map(str, one.collect())) == sorted(map(str, each.collect())) and one.count() == 60
    joined = concat_layouts(df, "layout", {"x": {"a": F.col("cmdCode")}, "y": {"b": F.col("cmdCode")}})
    assert joined.columns == ["layout", "a", "b"] and joined.where("a is null").count() == joined.where("layout = 'y'").count() == 20


@pytest.mark.parametrize("name", ["harmonize_columns", "comtrade_land_union"])
def test_landed_table_is_scanned_once(spark, name):
    plan = catalog.QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1


def test_sample_does_not_depend_on_layout(spark):
    df = spark.range(1000).withColumn("v", F.when(F.col("id") % 3 > 0, F.col("id")))
    a, b = (sorted(map(tuple, sample_rows(df.repartition(n), 20).collect()), key=str) for n in (1, 7))
    assert a == b and len(a) == 20 and sample_rows(df.limit(0), 5).count() == 0


def test_changed_input_is_read_anew(spark, tmp_dir):
    from importlens.plans.stages import materialized
    folder = f"{tmp_dir}/in"
    for n in (3, 8):
        spark.range(n).write.mode("overwrite").parquet(f"{folder}/t.parquet")
        assert materialized(spark, folder, "changed", lambda: spark.read.parquet(f"{folder}/t.parquet")).count() == n
        assert materialized(spark, folder, "changed", lambda: pytest.fail("written twice")).count() == n
