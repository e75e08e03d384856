"""Landed files by name and by quoting rules, tags of every path form, limits, plain sums."""

import csv
import os

import pytest
from pyspark.sql import functions as F

from importlens.operators import report
from importlens.operators.joins import broadcast_if_small, broadcast_limit
from importlens.plans import jobs
from importlens.session import ensure_checkpoint_dir
from importlens.sinks.files import write_single_csv
from importlens.sources.files import read_csv_strings, read_csv_typed, read_tagged
from tests.conftest import write_text

CELLS = "cmdCode string, cmdDesc string, primaryValue double, period string"


def test_columns_are_bound_by_name(spark, tmp_dir):
    write_text(tmp_dir, "a.csv", "cmdCode,cmdDesc,primaryValue,period\n01,a,10,202201\n")
    write_text(tmp_dir, "b.csv", "period,cmdCode,cmdDesc,primaryValue\n202202,02,b,20\n")
    write_text(tmp_dir, "c.csv", "cmdCode,primaryValue,period,extra\n03,30,202203,x\n")
    want = {("01", "a", 10.0, "202201"), ("02", "b", 20.0, "202202"), ("03", None, 30.0, "202203")}
    assert {tuple(r) for r in read_csv_typed(spark, tmp_dir, CELLS).collect()} == want
    assert {(r.cmdCode, r.extra) for r in read_csv_strings(spark, tmp_dir).collect()} == {("01", None), ("02", None), ("03", "x")}


def test_quotes_inside_cells(spark, tmp_dir):
    text = 'Tubes, 6" dia, steel'
    p = write_text(tmp_dir, "q.csv", 'cmdCode,cmdDesc,primaryValue,period\n01,"Tubes, 6"" dia, steel",10,202201\n')
    rows = read_csv_typed(spark, p, CELLS)
    assert [tuple(r) for r in rows.collect()] == [("01", text, 10.0, "202201")]
    out = os.path.join(tmp_dir, "out")
    write_single_csv(rows, out)
    part = next(f for f in os.listdir(out) if f.endswith(".csv"))
    with open(os.path.join(out, part), newline="") as fh:
        assert list(csv.reader(fh))[1][1] == text


@pytest.mark.parametrize("scheme", ["", "file:", "file://"])
@pytest.mark.parametrize("layout", ["file", "folder", "year=2022", "with space", "a+b"])
def test_every_path_form_is_tagged(spark, tmp_dir, scheme, layout):
    paths = {}
    for iso, n in (("QAT", 2), ("USA", 1)):
        folder = os.path.join(tmp_dir, f"export {iso}" if layout == "with space" else f"{iso}+x" if layout == "a+b" else iso)
        inner = os.path.join(folder, layout) if "=" in layout else folder
        os.makedirs(inner)
        file = write_text(inner, "part.csv", "cmdCode\n" + "01\n" * n)
        paths[iso] = scheme + (file if layout == "file" else folder)
    got = read_tagged(spark, paths).groupBy("country_iso3").count().collect()
    assert {r[0]: r[1] for r in got} == {"QAT": 2, "USA": 1}


def test_broadcast_limits_have_units_and_can_be_off(spark):
    key, small = "spark.sql.autoBroadcastJoinThreshold", spark.range(5)
    before = spark.conf.get(key)
    try:
        for text, want in (("64m", 64 << 20), ("10MB", 10 << 20), ("512", 512), ("-1", -1)):
            spark.conf.set(key, text)
            assert broadcast_limit(small) == want
            hinted = "broadcast" in broadcast_if_small(small)._jdf.queryExecution().logical().toString().lower()
            assert hinted == (want > 0)
    finally:
        spark.conf.set(key, before)


@pytest.mark.parametrize("values", [[1e33, 5.0, 1.0], [1e-7, 2e-7, 4e-7], [9e31, 9e31]])
def test_label_totals_are_plain_sums(spark, values):
    df = spark.createDataFrame([("a", v) for v in values], "commodity_label string, predicted_demand double")
    got = report.totals_by_label(df, ["predicted_demand"]).collect()[0].predicted_demand
    assert got == pytest.approx(sum(values), rel=1e-12)


def test_arg_max_ties_go_to_the_smaller_key(spark):
    df = spark.createDataFrame([("b", 2.0), ("a", 2.0), ("c", None)], "country_iso3 string, total_import_value double")
    assert report.kpi_hosts(df.repartition(3)).collect()[0].highest_import_country == "a"


def test_published_tables_are_evaluated_once(spark, tmp_dir):
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    rows = spark.range(10).select(F.col("id").cast("int").alias("year"), F.lit(1).alias("month"))
    table = rows.mapInArrow(counted, rows.schema)
    base = jobs.publish({"worldbank_indicator_trends": table}, tmp_dir)["worldbank_indicator_trends"]
    assert seen.value == 10
    assert read_csv_strings(spark, base + "/csv").count() == spark.read.parquet(base + "/parquet").count() == 10


def test_positions_follow_the_presentation_order(spark):
    df = spark.createDataFrame([("b", 1.0), ("a", 1.0), ("c", 5.0)], "k string, v double")
    got = report.with_position(df, [F.desc("v"), "k"]).collect()
    assert {r.k: r.position for r in got} == {"c": 1, "a": 2, "b": 3}


def test_sessions_without_a_shared_folder_are_refused():
    class Conf:
        def get(self, key, default=None):
            return default

    class Session:
        conf = Conf()

        @property
        def sparkContext(self):
            raise RuntimeError("no local context")

    with pytest.raises(ValueError):
        ensure_checkpoint_dir(Session())
