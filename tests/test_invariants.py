"""Cross-query invariants that hold for the reference's own goldens."""

import pytest

from orderlens.plans import analytics as A
from orderlens.sources.star import star_model

from .conftest import SF_SMALL


@pytest.fixture(scope="module")
def model(spark):
    return star_model(spark, SF_SMALL)


def test_customer_and_region_sums_agree(model):
    q3 = sum(r.Total for r in A.q03_totals_by_customer(model).collect())
    q4 = sum(r.Total for r in A.q04_totals_by_region(model).collect())
    n3 = A.q03_totals_by_customer(model).count()
    assert abs(q3 - q4) <= 0.005 * (n3 + 5)


def test_country_sums_agree(model):
    q5 = sum(r.CountryTotal for r in A.q05_totals_by_country(model).collect())
    q6 = sum(r.CountryTotal for r in A.q06_country_rank_in_region(model).collect())
    assert q5 == q6


def test_q7_is_q6_rank_one(model):
    q6 = {(r.Region, r.Country, r.CountryTotal) for r in
          A.q06_country_rank_in_region(model).collect() if r.CountryRegionalRank == 1}
    q7 = {(r.Region, r.Country, r.CountryTotal) for r in
          A.q07_top_country_per_region(model).collect()}
    assert q7 <= q6 and {r for r, _, _ in q7} == {r for r, _, _ in q6}


def test_q9_within_q8(model):
    q8 = {(r.Quarter, r.Year, r.CustomerID, r.Total) for r in
          A.q08_customer_quarter_totals(model).collect()}
    q9 = A.q09_top5_customers_per_quarter(model).collect()
    assert {(r.Quarter, r.Year, r.CustomerID, r.Total) for r in q9} <= q8
    assert all(r.CustomerRank <= 5 for r in q9)


def test_q11_gap_is_date_difference(model):
    for r in A.q11_longest_order_gap(model).collect():
        assert r.MaxDaysWithoutOrder == float((r.OrderDate - r.PreviousOrderDate).days)


def test_q10_orders_by_rank(model):
    rows = A.q10_month_rank(model).collect()
    assert len(rows) <= 12
    assert [r.TotalRank for r in rows] == sorted(r.TotalRank for r in rows)
