"""Raster operators on a pixel table `(prow, pcol, x, y, value)` (H1-H5).

A raster is a DataFrame of pixels keyed by (prow, pcol) with the pixel
centre in (x, y).  Pixels reach shapes through the same band join as plant
points, so rasters of any size are split across tasks like any table.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from capgrid.config import EIA_CAT_MAPPING
from capgrid.functions.columns import stats_category_predicate
from capgrid.operators.geometry import points_in_shapes
from capgrid.session import cut_lineage, small


# H1 -----------------------------------------------------------------------
def missing_capacity(stats: DataFrame, agg: DataFrame, year: int, category: str) -> DataFrame:
    """(country_id, output_capacity_mw): national total minus large plants, >= 0.

    Countries present on one side only are dropped (so a country with no
    large plants gets nothing), as are unknown statistics.
    """
    total = stats.where(stats_category_predicate(year, EIA_CAT_MAPPING[category])).groupBy("country_id").agg(
        F.sum("capacity_mw").alias("_total")
    )
    large = agg.groupBy("country_id").agg(F.sum("output_capacity_mw").alias("_large"))
    diff = total.join(large, on="country_id").select("country_id", (F.col("_total") - F.col("_large")).alias("d"))
    return diff.where(F.col("d").isNotNull()).select(
        "country_id", F.when(F.col("d") >= 0, F.col("d")).otherwise(F.lit(0.0)).alias("output_capacity_mw")
    )


def pixel_countries(pixels: DataFrame, land_shapes: DataFrame, land_edges: DataFrame, band: float) -> DataFrame:
    """(pixel, country) pairs: pixel centres in a country's land shapes (E11 without a union)."""
    hits = points_in_shapes(pixels.select("prow", "pcol", "x", "y", "value"), land_edges, band, boundary="include")
    return hits.join(small(land_shapes.select("shape_id", "country_id")), on="shape_id").drop("shape_id").dropDuplicates(
        ["prow", "pcol", "country_id"]
    )


# H2 -----------------------------------------------------------------------
def disaggregate_by_proxy(totals: DataFrame, pixels: DataFrame, land_shapes: DataFrame, land_edges: DataFrame, band: float) -> DataFrame:
    """Spread each country's total over its pixels in proportion to the proxy value.

    Output pixel table with `value` = capacity (MW) per pixel.
    """
    pc = cut_lineage(pixel_countries(pixels, land_shapes, land_edges, band))  # read for the sums and for the shares
    sums = pc.groupBy("country_id").agg(F.sum("value").alias("_sum"))
    # one row a country: joined first (and cut, since it is measured), then to the pixels
    shares = pc.join(small(cut_lineage(sums.join(totals, on="country_id"))), on="country_id")
    spread = shares.select(
        "prow", "pcol", "x", "y", (F.try_divide(F.col("value"), F.col("_sum")) * F.col("output_capacity_mw")).alias("value")
    )
    return spread.groupBy("prow", "pcol", "x", "y").agg(F.sum("value").alias("value"))


# H3 -----------------------------------------------------------------------
def zonal_sum(pixels: DataFrame, shapes: DataFrame, edges: DataFrame, band: float) -> DataFrame:
    """(shape_id, country_id, sum) of pixel values whose centre lies in each shape."""
    hits = points_in_shapes(pixels.select("prow", "pcol", "x", "y", "value"), edges, band, boundary="include")
    sums = hits.groupBy("shape_id").agg(F.sum("value").alias("sum"))
    return sums.join(shapes.select("shape_id", "country_id"), on="shape_id")


# H4 -----------------------------------------------------------------------
def combine_solar(rooftop: DataFrame, large: DataFrame, technology: str) -> DataFrame:
    """Rooftop rows (solar / `technology`) unioned with large solar; positive only."""
    roof = rooftop.where(F.col("sum").isNotNull()).select(
        "shape_id", "country_id", F.lit("solar").alias("category"), F.lit(technology).alias("technology"),
        F.col("sum").alias("output_capacity_mw"),
    )
    out = roof.unionByName(large.select(*[c for c in large.columns if c != "reference_year"]), allowMissingColumns=True)
    return out.where(F.col("output_capacity_mw") > 0)


# H5 -----------------------------------------------------------------------
def coarsen_factor(n_pixels: int, budget: int = 500_000) -> int:
    return max(1, math.ceil(math.sqrt(n_pixels / budget)))


def coarsen(pixels: DataFrame, factor: int, n_rows: int, n_cols: int) -> DataFrame:
    """Block means of `factor` x `factor` pixels; incomplete edge blocks trimmed."""
    keep_r = (n_rows // factor) * factor
    keep_c = (n_cols // factor) * factor
    f = F.lit(factor)
    return (
        pixels.where((F.col("prow") < keep_r) & (F.col("pcol") < keep_c))
        .groupBy((F.col("prow") / f).cast("int").alias("brow"), (F.col("pcol") / f).cast("int").alias("bcol"))
        .agg(F.avg("value").alias("value"), F.avg("x").alias("x"), F.avg("y").alias("y"))
    )


def coarsen_to_budget(pixels: DataFrame, budget: int = 500_000) -> DataFrame:
    """Coarsen with the factor ceil(sqrt(n / budget)), n = grid rows x columns.

    The grid size comes from one small aggregate (max row and column index).
    """
    dims = pixels.agg((F.max("prow") + 1).alias("r"), (F.max("pcol") + 1).alias("c")).first()
    n_rows, n_cols = int(dims["r"] or 0), int(dims["c"] or 0)
    return coarsen(pixels, coarsen_factor(n_rows * n_cols, budget), n_rows, n_cols)
