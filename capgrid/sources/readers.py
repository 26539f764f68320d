"""Sources (A1-A9, A11): tabular trackers, CSV, series JSON, geometry, rasters."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from capgrid.config import DROPPED_NA_COLUMNS, INVALID_STATUS_VALUES


# A1 -----------------------------------------------------------------------
def union_sheets(sheets: Sequence[DataFrame]) -> DataFrame:
    """Concatenate the sheets of one tracker (columns matched by name)."""
    if not sheets:
        raise ValueError("No sheets given.")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), sheets)


# A2 -----------------------------------------------------------------------
def normalise_name(name: str) -> str:
    return name.strip().lower().replace(" ", "_")


def normalise_columns(df: DataFrame) -> DataFrame:
    """Strip, lower-case and `space -> _` every header; a collision is an error."""
    names = [normalise_name(c) for c in df.columns]
    dupes = sorted({n for n in names if names.count(n) > 1})
    if dupes:
        raise ValueError(f"Column names collide after normalisation: {dupes}")
    return df.toDF(*names)


# A3 -----------------------------------------------------------------------
def drop_invalid_status(df: DataFrame, col: str = "status", invalid: Iterable[str] = INVALID_STATUS_VALUES) -> DataFrame:
    """Drop rows whose status contains an invalid word (case-sensitive); keep null status."""
    pattern = "|".join(re.escape(v) for v in invalid)
    return df.where(~F.coalesce(F.col(col).rlike(pattern), F.lit(False)))


# A4 -----------------------------------------------------------------------
def drop_missing(df: DataFrame, cols: Sequence[str] = DROPPED_NA_COLUMNS) -> DataFrame:
    return df.dropna(subset=list(cols))


# A5 -----------------------------------------------------------------------
HYDRO_SCHEMA = T.StructType(
    [
        T.StructField("ID", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("plant_type", T.StringType()),
        T.StructField("capacity_mw", T.DoubleType()),
        T.StructField("plant_lon", T.DoubleType()),
        T.StructField("plant_lat", T.DoubleType()),
        T.StructField("year", T.DoubleType()),
        T.StructField("res_vol_km3", T.DoubleType()),
    ]
)


def read_hydro_csv(spark: SparkSession, path: str, schema: T.StructType = HYDRO_SCHEMA) -> DataFrame:
    """Hydropower CSV with a header; the needed columns are picked by name and
    typed (`try_cast`: a bad number becomes null), extra columns are ignored."""
    raw = spark.read.option("header", True).option("inferSchema", False).csv(path)
    return raw.select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema.fields])


# A6 -----------------------------------------------------------------------
SERIES_SCHEMA = T.StructType(
    [T.StructField("series_id", T.StringType()), T.StructField("data", T.ArrayType(T.ArrayType(T.StringType())))]
)


def read_series_bulk(spark: SparkSession, path: str) -> DataFrame:
    """Newline JSON with `series_id` and `data` = [[year, value], ...]."""
    return spark.read.schema(SERIES_SCHEMA).json(path)


def explode_series(series: DataFrame) -> DataFrame:
    """(series_id, year INT, value DOUBLE) rows; `"NA"` and other text -> null."""
    pair = F.explode("data").alias("pair")
    return series.select("series_id", pair).select(
        "series_id",
        F.col("pair")[0].try_cast("double").cast("int").alias("year"),
        F.col("pair")[1].try_cast("double").alias("value"),
    )


# A7 -----------------------------------------------------------------------
def read_sentinel_table(
    spark: SparkSession, path: str, null_value: str = "#ND", units_row: bool = True, units: Mapping[str, str] | None = None
) -> DataFrame:
    """CSV export of a sheet with a null sentinel and a units row under the header.

    The units row is known by its exact texts: those in `units`, or, when none
    are given, all cells of the file's first row.  Rows that differ from it in
    any of these cells are kept, whatever their id looks like.
    """
    df = spark.read.option("header", True).option("nullValue", null_value).option("multiLine", True).csv(path)
    if not units_row:
        return df
    cells = dict(units) if units is not None else (first.asDict() if (first := df.first()) else {})
    if not cells:
        return df
    same = reduce(and_, [F.col(f"`{name}`").eqNullSafe(F.lit(text)) for name, text in cells.items()])
    return df.where(~same)


# A8 -----------------------------------------------------------------------
EDGE_SCHEMA = "shape_id string, part int, ring int, seq int, x1 double, y1 double, x2 double, y2 double"


def _wkb_header(buf: bytes, at: int) -> tuple[str, int, int, int]:
    """(byte order, geometry type, numbers per point, next offset); Z, M and ZM in both the ISO and the flagged notation."""
    import struct

    order = "<" if buf[at] == 1 else ">"
    (code,) = struct.unpack_from(order + "I", buf, at + 1)
    at += 5
    if code & 0x20000000:  # an SRID follows
        at += 4
    thousands, kind = divmod(code & 0x0FFFFFFF, 1000)
    if thousands > 3:
        raise ValueError(f"WKB geometry code {code} is unknown")
    extra = {0: 0, 1: 1, 2: 1, 3: 2}[thousands] or bool(code & 0x80000000) + bool(code & 0x40000000)
    return order, kind, 2 + extra, at


def _wkb_polygon(buf: bytes, at: int, order: str, width: int) -> tuple[list, int]:
    """Rings (x, y arrays) of one polygon body and the offset behind it."""
    import struct

    import numpy as np

    (n_rings,) = struct.unpack_from(order + "I", buf, at)
    at += 4
    rings = []
    for _ in range(n_rings):
        (n,) = struct.unpack_from(order + "I", buf, at)
        rings.append(np.frombuffer(buf, order + "f8", n * width, at + 4).reshape(n, width)[:, :2].astype("f8"))
        at += 4 + 8 * n * width
    return rings, at


def _wkb_edges(pdf_iter, id_col: str, geom_col: str):
    import struct

    import numpy as np
    import pandas as pd

    def parts_of(buf: bytes) -> list:
        order, kind, width, at = _wkb_header(buf, 0)
        if kind == 3:
            return [_wkb_polygon(buf, at, order, width)[0]]
        if kind != 6:
            raise ValueError(f"WKB geometry kind {kind} is no polygon")
        (n_parts,) = struct.unpack_from(order + "I", buf, at)
        at += 4
        parts = []
        for _ in range(n_parts):
            order, _, width, at = _wkb_header(buf, at)
            rings, at = _wkb_polygon(buf, at, order, width)
            parts.append(rings)
        return parts

    for pdf in pdf_iter:
        out = []
        for sid, wkb in zip(pdf[id_col], pdf[geom_col]):
            for part, rings in enumerate(parts_of(bytes(wkb))):
                for ring, xy in enumerate(rings):
                    if len(xy) < 2:
                        continue
                    ends = {"x1": xy[:-1, 0], "y1": xy[:-1, 1], "x2": xy[1:, 0], "y2": xy[1:, 1]}
                    out.append(pd.DataFrame({"shape_id": sid, "part": part, "ring": ring, "seq": np.arange(len(xy) - 1, dtype="int32"), **ends}))
        if out:
            yield pd.concat(out, ignore_index=True).astype({"part": "int32", "ring": "int32"})


def wkb_to_edges(shapes: DataFrame, id_col: str = "shape_id", geom_col: str = "geometry") -> DataFrame:
    """Polygon/MultiPolygon WKB -> edge rows, decoded per Arrow batch (one shape per row)."""
    return shapes.select(id_col, geom_col).mapInPandas(
        lambda it: _wkb_edges(it, id_col, geom_col), schema=EDGE_SCHEMA
    )


def read_geo_polygons(spark: SparkSession, path: str, id_col: str = "shape_id", geom_col: str = "geometry"):
    """GeoParquet polygons -> (attributes without geometry, edge table)."""
    df = spark.read.parquet(path)
    return df.drop(geom_col), wkb_to_edges(df, id_col, geom_col)


def read_geo_points(spark: SparkSession, path: str, geom_col: str = "geometry") -> DataFrame:
    """GeoParquet points -> the same rows with `lon`, `lat` doubles (little/big endian WKB)."""
    df = spark.read.parquet(path)
    # decode in Arrow batches: the coordinates are 8-byte IEEE floats at fixed offsets
    def decode(it):
        import numpy as np

        for pdf in it:
            buf = pdf[geom_col]
            lon = np.empty(len(buf))
            lat = np.empty(len(buf))
            for i, b in enumerate(buf):
                b = bytes(b)
                order, kind, _, at = _wkb_header(b, 0)
                if kind != 1:
                    raise ValueError(f"WKB geometry kind {kind} is no point")
                lon[i], lat[i] = np.frombuffer(b, dtype=order + "f8", count=2, offset=at)
            pdf = pdf.drop(columns=[geom_col])
            pdf["lon"] = lon
            pdf["lat"] = lat
            yield pdf

    out_schema = T.StructType([f for f in df.schema.fields if f.name != geom_col] + [
        T.StructField("lon", T.DoubleType()), T.StructField("lat", T.DoubleType())
    ])
    return df.mapInPandas(decode, schema=out_schema)


# A9 -----------------------------------------------------------------------
def read_pixels(spark: SparkSession, path: str) -> DataFrame:
    """Raster stored as a pixel table `(prow, pcol, x, y, value)`; nodata rows are absent."""
    return spark.read.parquet(path).select("prow", "pcol", "x", "y", F.col("value").cast("double"))


# A11 ----------------------------------------------------------------------
def combine_with_user_plants(internal: DataFrame, users: Sequence[DataFrame], excluded_ids: Sequence[str]) -> DataFrame:
    """Union the internal table with user tables and remove excluded ids."""
    combined = union_sheets([internal, *users])
    if excluded_ids:
        spark = internal.sparkSession
        ids = spark.createDataFrame([(i,) for i in excluded_ids], "powerplant_id string")
        # the id list is user configuration (a handful of ids): broadcast it
        combined = combined.join(F.broadcast(ids), on="powerplant_id", how="left_anti")
    return combined
