"""An empty plant table flows through placement, ages, adjustment, aggregation and reports."""

from pyspark.sql import functions as F

from capgrid import config as C
from capgrid.operators import reports
from capgrid.plans import categories as P
from capgrid.plans import fixtures as FX
from capgrid.plans import queries as Q

SF = "/root/testdata/sf0.001"


def test_empty_plants_through_jobs(spark):
    plants, _ = Q.og_plants(spark, SF, with_country=False)
    empty = plants.where(F.lit(False))
    s, e = Q.shapes(spark, SF)
    loc = C.LocationSettings(inner_distance=0.5, shape_class=FX.FIXTURE_SHAPE_CLASS)
    imp = C.ImputationSettings(lifetime_years=FX.FIXTURE_LIFETIMES, retirement_delay_years=FX.FIXTURE_DELAYS)
    unadj = P.unadjusted_plants(empty, s, e, Q.B, imp, loc, Q.Y)
    assert unadj.count() == 0
    adj = P.adjusted_plants(unadj, Q.stats(spark, SF), Q.Y, "fossil", quality_mode="raise")
    assert adj.count() == 0
    agg = P.aggregated(adj, s, e, Q.Y, Q.B, quality_mode="raise")
    assert agg.count() == 0 and "reference_year" in agg.columns
    assert reports.capacity_buildup(unadj).count() == 0
    assert reports.relocation_summary(unadj).first()["n_plants"] == 0
