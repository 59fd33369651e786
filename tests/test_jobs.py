"""How many jobs run while a plan is built: one per dimension that is counted, at most."""

import uuid

import pytest

from gridloom.operators import tariffs, usage
from gridloom.plans import energy, parameters
from gridloom.plans.meter import Meter


def jobs_of(spark, build):
    group = uuid.uuid4().hex
    spark.sparkContext.setJobGroup(group, group)
    try:
        build()
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


# Jobs as Spark counts them: a schema that is read is one, a counted dimension two or
# more, as every shuffle inside the count is one of its own.
LIMITS = {
    "usage_rollup": 5,  # events, customer; registry
    "peak_alerts": 8,  # nation; thresholds
    "co2e": 13,  # nation, region; locations, factors
    "cost_report": 16,  # nation; tariffs: overlaps, zones, count; charges
    "cost_co2e_corr": 21,
}


@pytest.mark.parametrize("name", sorted(LIMITS))
def test_plans_count_each_dimension_once(spark, sf_dir, name):
    m = Meter(spark, sf_dir)
    assert jobs_of(spark, lambda: getattr(energy, name)(m)) <= LIMITS[name]


def test_a_dimension_is_not_counted_again(spark, sf_dir):
    m = Meter(spark, sf_dir)
    places = usage.intervals(m.readings, ["location_id"])
    charges = parameters.charges(parameters.locations(m.table("nation")))
    prices = parameters.tariffs(spark)
    matched = lambda: usage.own_or_shared(tariffs.match_tariffs(places, prices, "interval_start"), charges, ["interval_start"])
    assert jobs_of(spark, matched) > 0
    assert jobs_of(spark, matched) == 0
