"""Cross-query invariants on the driver data."""

import math
import os

import pytest

import __spark_entry__ as E

from importlens.plans import fixtures as fx

SF = "/root/testdata/sf0.01"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")


def rows(spark, name):
    return E.queries()[name](spark, SF).collect()


def test_shares_sum_to_one(spark):
    for name in ("topk_share", "topk_commodity_share"):
        assert abs(sum(r.share for r in rows(spark, name)) - 1.0) < 1e-12


def test_histogram_counts_cover_every_score(spark):
    scores = [r.opportunity_score for r in rows(spark, "stocking_prediction")]
    hist = rows(spark, "score_histogram_20")
    assert len(hist) == 20
    assert sum(r["count"] for r in hist) == sum(s is not None for s in scores)
    labels = [r.opportunity_score for r in rows(spark, "predictions_by_label")]
    assert sum(r["count"] for r in rows(spark, "score_histogram_30")) == sum(s is not None for s in labels)


def test_country_totals_equal_sum_of_years(spark):
    by_year = {}
    for r in rows(spark, "imports_by_year"):
        by_year[r.country_iso3] = by_year.get(r.country_iso3, 0.0) + r.total_import_value
    totals = {r.country_iso3: r.total_import_value for r in rows(spark, "country_imports")}
    assert set(totals) == set(by_year)
    assert all(abs(totals[c] - by_year[c]) <= 1e-6 * abs(totals[c]) for c in totals)
    summary = {r.country_iso3: r.total_import_value for r in rows(spark, "import_summary")}
    # a sum of rounded yearly sums: equal but for the last bits
    assert set(summary) == set(totals) and all(math.isclose(summary[c], totals[c], rel_tol=1e-14) for c in totals)


def test_growth_slice_equals_full_series(spark):
    full = {(r.year, r.month): r.growth_rate for r in rows(spark, "monthly_growth")}
    sliced = rows(spark, "trend_selected_years")
    assert sliced and all(r.year in fx.TREND_YEARS for r in sliced)
    assert all(full[(r.year, r.month)] == r.growth_rate for r in sliced)


def test_pivot_cells_equal_long_averages(spark):
    longs = {(r.country_iso3, r.indicator_name): r.average_indicator_value
             for r in rows(spark, "indicator_averages")}
    for r in rows(spark, "indicator_pivot"):
        for name in fx.INDICATOR_NAMES:
            assert r[name] == longs.get((r.country_iso3, name))
