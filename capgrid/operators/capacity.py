"""Aggregation, scaling and national statistics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from capgrid.config import CAPACITY_GROUP_COLUMNS, EIA_CAT_MAPPING, EIA_CATEGORY_IDS
from capgrid.functions.columns import stats_category_predicate, year_predicate
from capgrid.operators.geometry import points_in_shapes
from capgrid.session import cut_lineage, small


def operating_split(df: DataFrame, year: int) -> tuple[DataFrame, DataFrame]:
    """(operating in `year`, everything else incl. rows with unknown years)."""
    pred = F.coalesce(year_predicate(year, "operating"), F.lit(False))
    return df.where(pred), df.where(~pred)


# G8 -----------------------------------------------------------------------
def expected_capacity(stats: DataFrame, year: int, category: str) -> DataFrame:
    """(country_id, expected) national capacity of a plant category in a year."""
    cats = EIA_CAT_MAPPING[category]
    return stats.where(stats_category_predicate(year, cats)).groupBy("country_id").agg(
        F.sum("capacity_mw").alias("expected")
    )


# G1 -----------------------------------------------------------------------
def scale_to_total(df: DataFrame, expected: DataFrame, by: str = "country_id", col: str = "output_capacity_mw") -> DataFrame:
    """value / group sum * expected group total (inner join on the expected table)."""
    # one row per country on both small sides; cut, so that measuring them does not read `df` once more
    sums = df.groupBy(by).agg(F.sum(col).alias("_sum"))
    scaled = df.join(small(cut_lineage(sums.join(expected, on=by))), on=by)
    # a group summing to zero has no share to give (null, as pandas gives NaN; ANSI would raise)
    return scaled.withColumn(col, F.try_divide(F.col(col), F.col("_sum")) * F.col("expected")).select(*df.columns)


# G2 -----------------------------------------------------------------------
def adjust_capacity(plants: DataFrame, stats: DataFrame, year: int, category: str) -> DataFrame:
    """Operating plants scaled to the national statistic; where it is missing or
    zero they are removed; past and future plants pass unchanged.

    One pass over the plants for the sums and one for the result: plants carry
    a flag instead of being split and united again.
    """
    now = F.coalesce(year_predicate(year, "operating"), F.lit(False))
    expected = expected_capacity(stats, year, category).where(F.col("expected") > 0)
    sums = plants.where(now).groupBy("country_id").agg(F.sum("output_capacity_mw").alias("_sum"))
    # one row a country on both sides; cut, so that measuring them does not read the plants once more
    factors = small(cut_lineage(expected.join(sums, on="country_id")))
    joined = plants.join(factors, on="country_id", how="left").where(~now | F.col("expected").isNotNull())
    scaled = F.try_divide(F.col("output_capacity_mw"), F.col("_sum")) * F.col("expected")
    return joined.withColumn("output_capacity_mw", F.when(now, scaled).otherwise(F.col("output_capacity_mw"))).select(*plants.columns)


# G3 -----------------------------------------------------------------------
def adjust_aggregated(agg: DataFrame, stats: DataFrame, year: int, category: str) -> DataFrame:
    """Aggregated rows scaled per country (positive rows of countries with statistics)."""
    expected = expected_capacity(stats, year, category).withColumn("expected", F.coalesce("expected", F.lit(0.0)))
    positive = agg.where(F.col("output_capacity_mw") > 0)
    return scale_to_total(positive, expected)


# G4 -----------------------------------------------------------------------
def aggregate_capacity(
    plants: DataFrame,
    shapes: DataFrame,
    edges: DataFrame,
    year: int,
    band: float,
    x: str = "lon",
    y: str = "lat",
    group_columns: Sequence[str] = tuple(CAPACITY_GROUP_COLUMNS),
) -> DataFrame:
    """Operating capacity summed per shape and per technology group.

    Groups are the capacity columns the table has (category, technology,
    chp, ccs, fuel_class); the country comes from the shape; only positive
    sums are kept; `reference_year` records the year.
    """
    groups = [c for c in group_columns if c in plants.columns]
    operating, _ = operating_split(plants, year)
    pts = operating.select(x, y, "output_capacity_mw", *groups).dropna(subset=groups)
    matched = points_in_shapes(pts, edges, band, x=x, y=y, boundary="include")
    agg = matched.groupBy("shape_id", *groups).agg(F.sum("output_capacity_mw").alias("output_capacity_mw"))
    agg = agg.join(shapes.select("shape_id", "country_id"), on="shape_id")
    agg = agg.withColumn("output_capacity_mw", F.coalesce("output_capacity_mw", F.lit(0.0)))
    return agg.where(F.col("output_capacity_mw") > 0).withColumn("reference_year", F.lit(year)).select(
        "shape_id", "country_id", *groups, "output_capacity_mw", "reference_year"
    )


# G5 / G6 ------------------------------------------------------------------
def series_codes(countries: DataFrame, category_ids: dict = EIA_CATEGORY_IDS) -> DataFrame:
    """(country_id, category, series_id) for every country and statistics category."""
    pairs = F.explode(F.array(*[F.struct(F.lit(k).alias("category"), F.lit(v).alias("cid")) for k, v in category_ids.items()]))
    return countries.select("country_id").distinct().select("country_id", pairs.alias("c")).select(
        "country_id",
        F.col("c.category").alias("category"),
        F.concat(F.lit("INTL."), F.col("c.cid").cast("string"), F.lit("-7-"), F.col("country_id"), F.lit("-MK.A")).alias("series_id"),
    )


def national_statistics(series: DataFrame, countries: DataFrame, category_ids: dict = EIA_CATEGORY_IDS, order_col: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(statistics, missing countries) from raw series rows (series_id, data).

    A country lacking any of the series is skipped whole; values are GW -> MW.
    If a series id repeats, the row with the smallest `order_col` wins (say, a
    position in the file); without such a column, rows of one id that differ
    fail the job, since a distributed read has no first row.
    """
    if order_col:
        data = F.min_by("data", order_col)
    else:
        clash = F.raise_error(F.concat(F.lit("series with differing rows: "), F.col("series_id")))
        data = F.when(F.min("data").eqNullSafe(F.max("data")), F.min("data")).otherwise(clash)
    first = series.groupBy("series_id").agg(data.alias("data"))
    codes = series_codes(countries, category_ids)
    found = codes.join(first, on="series_id")
    complete = found.groupBy("country_id").agg(F.count_distinct("category").alias("n")).where(
        F.col("n") == len(category_ids)
    ).select("country_id")
    rows = found.join(complete, on="country_id", how="left_semi").select(
        "country_id", "category", F.explode("data").alias("pair")
    )
    stats = rows.select(
        F.col("pair")[0].try_cast("double").cast("int").alias("year"),
        "category",
        (F.col("pair")[1].try_cast("double") * F.lit(1000.0)).alias("capacity_mw"),
        "country_id",
    )
    missing = countries.select("country_id").distinct().join(complete, on="country_id", how="left_anti")
    return stats, missing


# G7 -----------------------------------------------------------------------
def split_total(stats: DataFrame, rel_tol: float = 1e-9) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(total rows, category rows, checksum row); the checksum row has `ok`."""
    total = stats.where(F.col("category") == "total")
    cats = stats.where(F.col("category") != "total")
    check = stats.agg(
        F.coalesce(F.sum(F.when(F.col("category") == "total", F.col("capacity_mw"))), F.lit(0.0)).alias("total_sum"),
        F.coalesce(F.sum(F.when(F.col("category") != "total", F.col("capacity_mw"))), F.lit(0.0)).alias("category_sum"),
    ).withColumn(
        "ok",
        F.abs(F.col("total_sum") - F.col("category_sum"))
        <= F.lit(rel_tol) * F.greatest(F.abs("total_sum"), F.abs("category_sum")),
    )
    return total, cats, check


def checksum_gate(check: DataFrame) -> None:
    row = check.first()
    if not row["ok"]:
        raise ValueError(f"the categories add up to {row['category_sum']} MW, the totals to {row['total_sum']} MW")
