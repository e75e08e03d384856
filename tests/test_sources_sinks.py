"""Readers, writers, payload flattening, coverage grids, publishing."""

import os

from pyspark.sql import functions as F

from importlens import dims
from importlens.operators import coverage
from importlens.sinks.files import write_csv, write_parquet, write_single_csv
from importlens.sources.files import read_csv_strings, read_csv_typed, read_tagged
from importlens.sources.indicators import flatten_indicator_payloads
from tests.conftest import write_text


def test_codes_keep_leading_zeros(spark, tmp_dir):
    p = write_text(tmp_dir, "t.csv", "cmdCode,fips\n0101,06037\n")
    r = read_csv_strings(spark, p).collect()[0]
    assert r.cmdCode == "0101" and r.fips == "06037"


def test_typed_read_nulls_bad_cells_only(spark, tmp_dir):
    p = write_text(tmp_dir, "t.csv", "code,value\n01,1.5\n02,N/A\n")
    rows = {r.code: r.value for r in read_csv_typed(spark, p, "code string, value double").collect()}
    assert rows == {"01": 1.5, "02": None}


def test_tagged_multi_folder_read(spark, tmp_dir):
    for iso, n in (("QAT", 2), ("QATX", 1)):
        os.makedirs(os.path.join(tmp_dir, iso))
        write_text(os.path.join(tmp_dir, iso), "part.csv", "cmdCode\n" + "01\n" * n)
    df = read_tagged(spark, {"QAT": os.path.join(tmp_dir, "QAT"), "QATX": os.path.join(tmp_dir, "QATX")})
    got = {r.country_iso3: r["count"] for r in df.groupBy("country_iso3").count().collect()}
    assert got == {"QAT": 2, "QATX": 1}


def test_flatten_payloads(spark):
    good = ('[{},[{"country":{"value":"Qatar"},"date":"2022","value":1.5},'
            '{"country":{"value":"Qatar"},"date":"2018","value":2},'
            '{"country":{"value":"Qatar"},"date":"2021","value":null}]]')
    landed = spark.createDataFrame([("QAT", "NY.GDP.PCAP.CD", good), ("QAT", "SP.POP.TOTL", "[{}]"),
                                    ("USA", "SP.POP.TOTL", "[{},null]")],
                                   "country_iso3 string, indicator_code string, payload string")
    rows = sorted(flatten_indicator_payloads(landed, dims.indicators(spark), [2019, 2020, 2021, 2022])
                  .collect(), key=lambda r: r.year)
    assert [(r.year, r.value) for r in rows] == [(2021, None), (2022, 1.5)]
    assert rows[0].indicator_name == "gdp_per_capita" and rows[0].country_name == "Qatar"


def test_period_coverage_flags_missing(spark):
    trade = spark.createDataFrame([("QAT", "202201"), ("QAT", "202201"), ("QAT", "202213")],
                                  "country_iso3 string, period string")
    cov = coverage.period_coverage(trade, {"QAT": [2022]}).collect()
    assert len(cov) == 12
    jan = [r for r in cov if r.month == 1][0]
    assert jan.rows_landed == 2 and not jan.missing
    assert sum(r.missing for r in cov) == 11


def test_indicator_coverage(spark):
    ind = spark.createDataFrame([("QAT", "gdp", 2022, 1.0), ("QAT", "gdp", 2023, None)],
                                "country_iso3 string, indicator_name string, year int, value double")
    cov = {(r.indicator_name, r.year): r for r in
           coverage.indicator_coverage(ind, ["QAT"], ["gdp", "pop"], [2022, 2023]).collect()}
    assert not cov[("gdp", 2022)].missing and cov[("gdp", 2023)].missing
    assert cov[("gdp", 2023)].rows_landed == 1 and cov[("pop", 2022)].rows_landed == 0


def test_csv_and_parquet_round_trip(spark, tmp_dir):
    df = spark.createDataFrame([("QAT", 2022, 1.5), ("USA", 2023, 2.5)],
                               "country_iso3 string, year int, total double")
    write_single_csv(df, os.path.join(tmp_dir, "one"))
    files = [f for f in os.listdir(os.path.join(tmp_dir, "one")) if f.endswith(".csv")]
    assert len(files) == 1
    back = read_csv_typed(spark, os.path.join(tmp_dir, "one"), df.schema)
    assert sorted(back.collect()) == sorted(df.collect())
    write_parquet(df, os.path.join(tmp_dir, "pq"), partition_by=["country_iso3"])
    assert spark.read.parquet(os.path.join(tmp_dir, "pq")).filter(F.col("country_iso3") == "USA").count() == 1
    write_csv(df, os.path.join(tmp_dir, "many"))
    assert read_csv_strings(spark, os.path.join(tmp_dir, "many")).count() == 2


def test_event_calendar_csv(spark, tmp_dir):
    cal = dims.event_calendar(spark)
    write_csv(cal, os.path.join(tmp_dir, "cal"))
    from importlens import schemas
    back = read_csv_typed(spark, os.path.join(tmp_dir, "cal"), schemas.EVENT_CALENDAR)
    assert back.count() == 4
    assert back.filter(F.col("host_iso3") == "QAT").collect()[0].event_start.isoformat() == "2022-11-20"


def test_dimension_sizes(spark):
    assert dims.hs2_labels(spark).count() == 97
    assert dims.host_counties(spark).count() == 11
    assert dims.naics_sectors(spark).count() == 8
    assert dims.indicators(spark).count() == 4


def test_broadcast_if_small_checks_size(spark):
    from importlens.operators.joins import broadcast_if_small, estimated_bytes
    small = dims.hs2_labels(spark)
    assert estimated_bytes(small) is not None
    big = spark.range(10_000_000)
    fact = spark.range(100).withColumnRenamed("id", "k")
    plan_small = fact.join(broadcast_if_small(small), fact.k == small.hs2.cast("long"))._jdf.queryExecution().optimizedPlan().toString()
    plan_big = fact.join(broadcast_if_small(big, limit_bytes=1024), fact.k == big.id)._jdf.queryExecution().optimizedPlan().toString()
    assert "broadcast" in plan_small.lower()
    assert "broadcast" not in plan_big.lower()


def test_cluster_session_needs_shared_checkpoint_dir():
    import pytest
    from importlens.session import ensure_checkpoint_dir

    class Conf:
        def __init__(self, values):
            self.values = values

        def get(self, key, default=None):
            return self.values.get(key, default)

        def set(self, key, value):
            self.values[key] = value

    class Stub:
        def __init__(self, values):
            self.conf = Conf(values)

        @property
        def sparkContext(self):
            raise RuntimeError("no local context")

    with pytest.raises(ValueError, match="shared folder"):
        ensure_checkpoint_dir(Stub({"spark.master": "spark://cluster:7077"}))
    assert ensure_checkpoint_dir(Stub({"spark.master": "yarn", "spark.checkpoint.dir": "hdfs:///shared/ckpt/"})) \
        == "hdfs:///shared/ckpt"


def test_headers_are_found_in_tasks(spark, tmp_dir):
    from importlens.sources.files import by_header
    odd = os.path.join(tmp_dir, "a b+c=%")
    os.makedirs(odd)
    write_text(odd, "one.csv", "﻿a,b\n1,2\n")
    write_text(odd, "two.csv", "\n\nb,a\n3,4\n")
    write_text(odd, "empty.csv", "")
    write_text(odd, "_hidden.csv", "x\n9\n")
    groups = by_header(spark, [odd])
    assert sorted(groups) == [("a", "b"), ("b", "a")] and all(len(v) == 1 for v in groups.values())
    rows = sorted((r.a, r.b) for r in read_csv_strings(spark, odd).collect())
    assert rows == [("1", "2"), ("4", "3")]
    same = os.path.join(tmp_dir, "same")
    os.makedirs(same)
    for i in range(40):
        write_text(same, f"{i}.csv", f"a,b\n{i},x\n")
    assert by_header(spark, [same]) == {("a", "b"): [same]}
    assert read_csv_strings(spark, same).count() == 40


def test_header_with_a_line_break(spark, tmp_dir):
    p = write_text(tmp_dir, "t.csv", 'code,"trade\n""value""",x\n01,1.5,"two\nlines"\n')
    df = read_csv_strings(spark, p, multi_line=True)
    assert df.columns == ["code", 'trade\n"value"', "x"]
    assert tuple(df.collect()[0]) == ("01", "1.5", "two\nlines")


def test_tags_by_a_path_table(spark, tmp_dir):
    mixed = os.path.join(tmp_dir, "mixed")
    os.makedirs(mixed)
    os.makedirs(os.path.join(tmp_dir, "own", "deep"))
    files = {iso: write_text(mixed, f"{iso} export.csv", "cmdCode\n01\n") for iso in ("QAT", "USA")}
    write_text(os.path.join(tmp_dir, "own", "deep"), "x.csv", "period,cmdCode\n202201,02\n")
    df = read_tagged(spark, files | {"CAN": os.path.join(tmp_dir, "own")})
    assert sorted((r.country_iso3, r.cmdCode, r.period) for r in df.collect()) == [
        ("CAN", "02", "202201"), ("QAT", "01", None), ("USA", "01", None)]

    def plan_size(n):
        folder = os.path.join(tmp_dir, f"many{n}")
        os.makedirs(folder)
        paths = {f"C{i}": write_text(folder, f"{i}.csv", "cmdCode\n01\n") for i in range(n)}
        return len(read_tagged(spark, {"ALL": folder})._jdf.queryExecution().analyzed().toString()), paths
    assert abs(plan_size(3)[0] - plan_size(60)[0]) < 200


def test_first_lines_hold_one_batch(spark, tmp_dir):
    """The header pass neither sorts nor groups the lines: a task's memory does not grow with its split."""
    from importlens.sources.files import first_lines
    for i in range(40):
        write_text(tmp_dir, f"part {i:02d}+.csv", "\n" * (i % 3) + f"h{i}\n" + "row\n" * (i * 40))
    write_text(tmp_dir, "blank.csv", "\n \n")
    found = first_lines(spark, [tmp_dir])
    assert {r.file.rsplit("/", 1)[1]: r.line for r in found.collect()} == {f"part {i:02d}+.csv": f"h{i}" for i in range(40)}
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Sort" not in plan and "Aggregate" not in plan
