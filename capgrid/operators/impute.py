"""Time imputation.

Group means are computed with `groupBy` (partial aggregation before the
shuffle, so a hot group never sits in one task) and joined back; the number
of groups is bounded by country x category x technology x status.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from capgrid.config import DATASET_YEAR, SCENARIO_MAP
from capgrid.functions.columns import map_literal
from capgrid.session import cut_lineage, small

GROUP_KEYS = ["country_id", "category", "technology", "status"]


def _lookup(mapping: Mapping[str, float], key: str = "technology") -> F.Column:
    return F.try_element_at(map_literal({k: float(v) for k, v in mapping.items()}), F.col(key))


# C2 -----------------------------------------------------------------------
def scenario_filter(df: DataFrame, scenario: str) -> DataFrame:
    if scenario not in SCENARIO_MAP:
        raise ValueError(f"Invalid scenario {scenario!r}.")
    return df.where(F.col("status").isin(SCENARIO_MAP[scenario]))


# F1 -----------------------------------------------------------------------
def impute_start_year(df: DataFrame, lifetimes: Mapping[str, float], keys: Sequence[str] = GROUP_KEYS) -> DataFrame:
    """null start: end - lifetime[tech]; still null: half-even rounded mean of the
    original start years of its (country, category, technology, status) group."""
    means = (
        df.where(F.col("start_year").isNotNull())
        .dropna(subset=list(keys))
        .groupBy(*keys)
        .agg(F.bround(F.avg("start_year"), 0).alias("_mean_start"))
    )
    # written once: measured for the broadcast, then joined
    joined = df.join(small(cut_lineage(means)), on=list(keys), how="left")
    filled = F.coalesce(F.col("start_year"), F.col("end_year") - _lookup(lifetimes), F.col("_mean_start"))
    return joined.withColumn("start_year", filled).select(*df.columns)


# F2 -----------------------------------------------------------------------
def impute_end_year(df: DataFrame, lifetimes: Mapping[str, float], delays: Mapping[str, float], year: int = DATASET_YEAR) -> DataFrame:
    """null end: start + lifetime; operating plants with end <= year retire at
    max(end + delay, year + 1) (this also overrides reported end years)."""
    end = F.coalesce(F.col("end_year"), F.col("start_year") + _lookup(lifetimes))
    delay = F.coalesce(_lookup(delays), F.lit(0.0))
    needs = (end <= F.lit(year)) & (F.col("status") == "operating")
    delayed = F.greatest(end + delay, F.lit(float(year + 1)))
    return df.withColumn("end_year", F.when(needs, delayed).otherwise(end))


# F3 -----------------------------------------------------------------------
def impute_status(df: DataFrame, year: int = DATASET_YEAR) -> DataFrame:
    """planned (start > y), then operating (start <= y < end), then retired (end <= y); last wins."""
    s, e, y = F.col("start_year"), F.col("end_year"), F.lit(year)
    status = F.when(e <= y, "retired").when((s <= y) & (y < e), "operating").when(s > y, "planned").otherwise(F.col("status"))
    return df.withColumn("status", status)


# F4 -----------------------------------------------------------------------
def impute_time(
    df: DataFrame,
    scenario: str,
    lifetimes: Mapping[str, float],
    delays: Mapping[str, float],
    year: int = DATASET_YEAR,
) -> DataFrame:
    """Scenario filter, start and end years, drop rows still without years, status."""
    out = scenario_filter(df, scenario)
    out = impute_start_year(out, lifetimes)
    out = impute_end_year(out, lifetimes, delays, year)
    out = out.dropna(subset=["start_year", "end_year"])
    return impute_status(out, year)


# F5 -----------------------------------------------------------------------
def fill_from_points(facilities: DataFrame, within: DataFrame, fac_id: str = "shape_id") -> DataFrame:
    """Facilities get the rounded mean start/end year and the unique most frequent
    status of the tracker points inside them; only present values overwrite.

    `within` has one row per (point, facility) with the point's
    start_year, end_year and status and the facility id in `fac_id`.
    """
    # one pass over the (large) point table: per (facility, status) partial sums;
    # everything else is derived from that small table
    # (written once: the years read it whole and the modes by status, which would run the join behind `within` anew)
    per = cut_lineage(within.groupBy(fac_id, "status").agg(
        F.sum("start_year").alias("_ss"), F.count("start_year").alias("_ns"),
        F.sum("end_year").alias("_se"), F.count("end_year").alias("_ne"),
        F.count(F.lit(1)).alias("_n"),
    ))
    years = per.groupBy(fac_id).agg(
        F.bround(F.try_divide(F.sum("_ss"), F.sum("_ns")), 0).alias("_start"),
        F.bround(F.try_divide(F.sum("_se"), F.sum("_ne")), 0).alias("_end"),
    )
    counted = per.where(F.col("status").isNotNull())
    top = counted.groupBy(fac_id).agg(F.max("_n").alias("_max"), F.max_by("status", "_n").alias("_mode"))
    ties = counted.join(top, on=fac_id).where(F.col("_n") == F.col("_max")).groupBy(fac_id).agg(
        F.count(F.lit(1)).alias("_ties"), F.first("_mode").alias("_mode")
    )
    mode = ties.where(F.col("_ties") == 1).select(fac_id, "_mode")
    out = facilities.join(years, on=fac_id, how="left").join(mode, on=fac_id, how="left")
    return out.select(
        *[
            F.coalesce(F.col("_start"), F.col(c)).alias(c) if c == "start_year"
            else F.coalesce(F.col("_end"), F.col(c)).alias(c) if c == "end_year"
            else F.coalesce(F.col("_mode"), F.col(c)).alias(c) if c == "status"
            else F.col(c)
            for c in facilities.columns
        ]
    )
