"""The test tables reach every step: each named step changes rows at every scale."""

import pytest

from comarca.plans import fixed, tables
from comarca.queries import QUERIES

SCALES = ["/root/testdata/sf0.001", "/root/testdata/sf0.01", "/root/testdata/sf0.1"]


@pytest.fixture(params=SCALES)
def found(spark, request):
    return lambda name: QUERIES[name](spark, request.param)


def test_counties_are_dropped_and_corrected(found):
    for gathered, cleaned in [("social_table", "social_clean"), ("cultural_table", "cultural_clean")]:
        counties = {row.county for row in found(gathered).select("county").distinct().collect()}
        lowered = {county.lower() for county in counties if county}
        assert None in counties
        assert lowered & set(fixed.COUNTY_FIXES)
        assert "madrid" in lowered
        kept = {row.county for row in found(cleaned).select("county").distinct().collect()}
        assert kept <= set(fixed.VALID_COUNTIES)


def test_every_step_removes_rows(found):
    for name in ["social_audit", "cultural_audit"]:
        counts = [row["rows"] for row in found(name).collect()]
        assert counts == sorted(set(counts), reverse=True)


def test_the_order_of_the_cleanups_matters(found):
    assert found("social_clean").count() > found("social_clean_counties_first").count()


def test_institutions_repeat_with_their_address(found):
    by_address = found("report_repeated_cultural_addresses").collect()
    assert any(row.address is not None for row in by_address)


def test_the_minimum_population_removes_some_cities_but_not_all(found):
    people = found("population_table").where("total_population > 0")
    large = people.where("total_population >= 1000000").count()
    assert 0 < large < people.count()
    every, some = found("report_venue_rates").collect(), found("report_venue_rates_large").collect()
    assert some and every != some


def test_the_fill_changes_venues(found):
    missing = "postal_code is null"
    assert found("venues_clean").where(missing).count() < found("venues_table").where(missing).count()
