"""Report tables behind the figures."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from capgrid.config import EIA_CAT_MAPPING
from capgrid.functions.columns import stats_category_predicate
from capgrid.operators.capacity import operating_split


# J1 -----------------------------------------------------------------------
def capacity_buildup(plants: DataFrame) -> DataFrame:
    """Active MW per (country, technology, year) for every year from the first
    start to the last end, zeros filled for every technology of the table.

    Each plant adds its capacity at ceil(start) and removes it at ceil(end);
    a running sum over the year spine gives the active capacity, so no plant
    is exploded over its lifetime.  The number of active plants runs along:
    where it is zero so is the capacity, without a residue of the sum.  Plants
    that never start, or end before they start, are never active.
    """
    plants = plants.where(F.col("start_year").isNotNull() & (F.col("end_year").isNull() | (F.col("end_year") > F.col("start_year"))))
    # the year range and the technology vocabulary: one row, read by scalar subqueries
    extent = plants.agg(
        F.floor(F.min("start_year")).cast("int").alias("y0"),
        F.floor(F.max("end_year")).cast("int").alias("y1"),
        F.array_sort(F.collect_set("technology")).alias("techs"),
    )
    spine = plants.select("country_id").distinct().select(
        "country_id", F.explode(extent.select("techs").scalar()).alias("technology")
    ).select("country_id", "technology", F.explode(F.sequence(extent.select("y0").scalar(), extent.select("y1").scalar())).alias("year"))
    ev = plants.select(
        "country_id", "technology",
        F.explode(
            F.array(
                F.struct(F.ceil("start_year").cast("int").alias("year"), F.col("output_capacity_mw").alias("d"), F.lit(1).alias("n")),
                F.struct(F.ceil("end_year").cast("int").alias("year"), (-F.col("output_capacity_mw")).alias("d"), F.lit(-1).alias("n")),
            )
        ).alias("e"),
    ).select("country_id", "technology", "e.year", "e.d", "e.n")
    deltas = ev.groupBy("country_id", "technology", "year").agg(F.sum("d").alias("d"), F.sum("n").alias("n"))
    w = Window.partitionBy("country_id", "technology").orderBy("year").rowsBetween(Window.unboundedPreceding, 0)
    # deltas before the first spine year belong to no spine row; starts are never before y0
    out = spine.join(deltas, on=["country_id", "technology", "year"], how="left").withColumn(
        "output_capacity_mw",
        F.when(F.sum(F.coalesce("n", F.lit(0))).over(w) == 0, F.lit(0.0)).otherwise(F.sum(F.coalesce("d", F.lit(0.0))).over(w)),
    )
    return out.select("country_id", "technology", "year", "output_capacity_mw")


# J2 -----------------------------------------------------------------------
def adjustment_comparison(unadjusted: DataFrame, adjusted: DataFrame, stats: DataFrame, year: int, category: str, disaggregated: bool = True) -> DataFrame:
    """Long table (country_id, source, label, capacity_mw, share_of_adjusted).

    Each input is read once: labels and their total come from one aggregation,
    and what is known of a country from windows over its few summary rows.
    """
    if disaggregated:
        unadjusted, _ = operating_split(unadjusted, year)
        adjusted, _ = operating_split(adjusted, year)
    eia = stats.where(stats_category_predicate(year, EIA_CAT_MAPPING[category]))
    rows = lambda df, label, mw, source: df.select("country_id", F.lit(source).alias("source"), F.col(label).alias("label"), F.col(mw).alias("mw"))
    every = (
        rows(unadjusted, "technology", "output_capacity_mw", "unadjusted")
        .unionByName(rows(adjusted, "technology", "output_capacity_mw", "adjusted"))
        .unionByName(rows(eia, "category", "capacity_mw", "statistics"))
    )
    sums = (
        every.select("country_id", "source", "mw", F.explode(F.array(F.struct(F.col("label").alias("label"), F.lit(False).alias("all")), F.struct(F.lit("total").alias("label"), F.lit(True).alias("all")))).alias("l"))
        .groupBy("country_id", "source", "l.label", "l.all").agg(F.sum("mw").alias("capacity_mw"))
    )
    country = Window.partitionBy("country_id")
    has = lambda source: F.max(F.col("source") == source).over(country)
    adjusted_total = F.max(F.when((F.col("source") == "adjusted") & F.col("all"), F.col("capacity_mw"))).over(country)
    known = sums.withColumns({"_stats": has("statistics"), "_unadjusted": has("unadjusted"), "_adjusted": has("adjusted"), "_adj": adjusted_total})
    kept = known.where(
        (F.col("source") == "adjusted")
        | ((F.col("source") == "unadjusted") & F.col("_stats"))
        | ((F.col("source") == "statistics") & (F.col("_unadjusted") | F.col("_adjusted")))
    )
    share = F.when(F.col("_adj") != 0, F.col("capacity_mw") / F.col("_adj") * 100)
    return kept.select("country_id", "label", "capacity_mw", "source", share.alias("share_of_adjusted"))


# J3 -----------------------------------------------------------------------
def statistics_pivot(category_stats: DataFrame, total_stats: DataFrame, categories: list[str]) -> DataFrame:
    """(country_id, year, one column per category (nulls 0), total)."""
    names = {c: "mw_" + c.replace(" ", "_") for c in categories}
    wide = category_stats.groupBy("country_id", "year").pivot("category", categories).agg(F.sum("capacity_mw"))
    wide = wide.select("country_id", "year", *[F.coalesce(F.col(f"`{c}`"), F.lit(0.0)).alias(names[c]) for c in categories])
    tot = total_stats.groupBy("country_id", "year").agg(F.sum("capacity_mw").alias("total_mw"))
    return wide.join(tot, on=["country_id", "year"], how="left")


# J4 -----------------------------------------------------------------------
def capacity_by_shape(agg: DataFrame, shapes: DataFrame) -> DataFrame:
    """Sum per shape onto all shapes; 0 becomes null."""
    sums = agg.groupBy("shape_id").agg(F.sum("output_capacity_mw").alias("output_capacity_mw"))
    out = shapes.select("shape_id").join(sums, on="shape_id", how="left")
    return out.withColumn("output_capacity_mw", F.nullif(F.col("output_capacity_mw"), F.lit(0.0)))


# J5 -----------------------------------------------------------------------
def relocation_summary(plants: DataFrame) -> DataFrame:
    """Counts of valid (neither split nor moved), split and moved plants."""
    return plants.agg(
        F.count(F.lit(1)).alias("n_plants"),
        F.count_if(~F.col("split") & ~F.col("moved")).alias("n_valid"),
        F.count_if(F.col("split")).alias("n_split"),
        F.count_if(F.col("moved")).alias("n_moved"),
    )
