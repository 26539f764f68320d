"""Sources and the sink on small files written to a scratch folder."""

import os
import struct
import tempfile

from pyspark.sql import functions as F

from capgrid.sources import readers as R
from capgrid.sources.sinks import write_output


def _poly_wkb(rings, order="<"):
    flag = 1 if order == "<" else 0
    out = struct.pack(order + "BII", flag, 3, len(rings))
    for ring in rings:
        out += struct.pack(order + "I", len(ring))
        for x, y in ring:
            out += struct.pack(order + "dd", x, y)
    return out


def test_wkb_polygons_to_edges(spark):
    outer = [(0, 0), (4, 0), (4, 4), (0, 4), (0, 0)]
    hole = [(1, 1), (2, 1), (2, 2), (1, 1)]
    poly = _poly_wkb([outer, hole])
    multi = struct.pack(">BII", 0, 6, 2) + _poly_wkb([outer], ">") + _poly_wkb([[(9, 9), (10, 9), (10, 10), (9, 9)]], ">")
    df = spark.createDataFrame([("P", bytearray(poly)), ("M", bytearray(multi))], "shape_id string, geometry binary")
    edges = R.wkb_to_edges(df).collect()
    by = {}
    for e in edges:
        by.setdefault((e.shape_id, e.part, e.ring), []).append((e.x1, e.y1, e.x2, e.y2))
    assert len(by[("P", 0, 0)]) == 4 and len(by[("P", 0, 1)]) == 3
    assert len(by[("M", 0, 0)]) == 4 and by[("M", 1, 0)][0] == (9.0, 9.0, 10.0, 9.0)


def test_geo_points(spark, tmp_path):
    pts = [("a", bytearray(struct.pack("<BIdd", 1, 1, 12.5, 41.9))), ("b", bytearray(struct.pack(">BIdd", 0, 1, -3.0, 7.25)))]
    path = str(tmp_path / "pts.parquet")
    spark.createDataFrame(pts, "id string, geometry binary").write.parquet(path)
    got = {r.id: (r.lon, r.lat) for r in R.read_geo_points(spark, path).collect()}
    assert got == {"a": (12.5, 41.9), "b": (-3.0, 7.25)}


def test_hydro_csv_and_sentinel_sheet(spark, tmp_path):
    csv = tmp_path / "hydro.csv"
    csv.write_text("ID,name,plant_type,capacity_mw,plant_lon,plant_lat,year,res_vol_km3,head_m\n"
                   "H1,Dam,STO,10.5,1.0,2.0,1990,-1,50\nH2,Run,,3,4.0,5.0,,0.2,\n")
    rows = {r.ID: r for r in R.read_hydro_csv(spark, str(csv)).collect()}
    assert rows["H1"].capacity_mw == 10.5 and rows["H2"].plant_type is None and rows["H2"].year is None
    sheet = tmp_path / "wind.csv"
    sheet.write_text("ID,Name,Total power\n(id),(text),(kW)\n1,Farm,#ND\n2,Other,3000\n")
    got = sorted((r.ID, r["Total power"]) for r in R.read_sentinel_table(spark, str(sheet)).collect())
    assert got == [("1", None), ("2", "3000")]


def test_series_bulk(spark, tmp_path):
    f = tmp_path / "series.txt"
    f.write_text('{"series_id": "INTL.2-7-ABC-MK.A", "data": [[2020, 1.5], [2021, "NA"]]}\n')
    got = sorted(tuple(r) for r in R.explode_series(R.read_series_bulk(spark, str(f))).collect())
    assert got == [("INTL.2-7-ABC-MK.A", 2020, 1.5), ("INTL.2-7-ABC-MK.A", 2021, None)]


def test_combine_and_sink(spark, tmp_path):
    a = spark.createDataFrame([("x", 1.0), ("drop", 2.0)], "powerplant_id string, output_capacity_mw double")
    b = spark.createDataFrame([("u", "solar")], "powerplant_id string, category string")
    out = R.combine_with_user_plants(a, [b], ["drop"])
    assert sorted(r.powerplant_id for r in out.collect()) == ["u", "x"]
    path = str(tmp_path / "published")
    write_output(out.withColumn("category", F.lit("solar")), path, "eu", "adjusted", "solar")
    write_output(out.withColumn("category", F.lit("wind")), path, "eu", "adjusted", "wind")
    write_output(out.where(F.col("powerplant_id") == "x").withColumn("category", F.lit("solar")), path, "eu", "adjusted", "solar")
    back = spark.read.parquet(path)
    assert back.where(F.col("category_part") == "solar").count() == 1
    assert back.where(F.col("category_part") == "wind").count() == 2
    assert os.path.isdir(os.path.join(path, "shapes=eu", "adjustment=adjusted", "category_part=wind"))
