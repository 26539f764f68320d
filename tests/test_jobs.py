"""Gates and options of the jobs, on hand-written rows."""

import struct

import numpy as np
import pytest
from edge_tables import EDGE_DDL, square_edges

from capgrid import config as C
from capgrid.operators import capacity, fuel_classes, reports
from capgrid.operators import geometry as G
from capgrid.plans import categories as P
from capgrid.session import cut_lineage, ensure_checkpoint_dir, small
from capgrid.sources import readers as R


# sources -------------------------------------------------------------------
RING = [(0.0, 0.0), (4.0, 0.0), (4.0, 4.0), (0.0, 0.0)]


def _wkb(code, width, order="<", kind_bytes=b""):
    points = b"".join(struct.pack(order + "d" * width, *p, *[9.0] * (width - 2)) for p in RING)
    return struct.pack(order + "BI", order == "<", code) + kind_bytes + struct.pack(order + "II", 1, len(RING)) + points


@pytest.mark.parametrize("code,width", [(3, 2), (1003, 3), (2003, 3), (3003, 4), (0x80000003, 3), (0x40000003, 3), (0xC0000003, 4)])
@pytest.mark.parametrize("order", ["<", ">"])
def test_wkb_with_heights_and_measures(spark, code, width, order):
    rows = R.wkb_to_edges(spark.createDataFrame([("s", bytearray(_wkb(code, width, order)))], "shape_id string, geometry binary")).collect()
    assert [(r["x1"], r["y1"], r["x2"], r["y2"]) for r in sorted(rows, key=lambda r: r["seq"])] == [(*a, *b) for a, b in zip(RING, RING[1:])]


def test_wkb_srid_and_unknown_codes(spark):
    ok = spark.createDataFrame([("s", bytearray(_wkb(0x20000003, 2, "<", struct.pack("<I", 4326))))], "shape_id string, geometry binary")
    assert R.wkb_to_edges(ok).count() == 3
    with pytest.raises(Exception, match="unknown|no polygon"):
        R.wkb_to_edges(spark.createDataFrame([("s", bytearray(_wkb(4003, 2)))], "shape_id string, geometry binary")).collect()


def test_sentinel_table_keeps_every_id(spark, tmp_path):
    path = tmp_path / "sheet.csv"
    path.write_text("ID,Power\n(id),(kW)\n12,5\nWF-7,#ND\nA3,7\n,8\n")
    for units in (None, {"ID": "(id)"}):
        rows = R.read_sentinel_table(spark, str(path), units=units).collect()
        assert sorted(((r["ID"], r["Power"]) for r in rows), key=repr) == sorted([("12", "5"), ("WF-7", None), ("A3", "7"), (None, "8")], key=repr)
    assert R.read_sentinel_table(spark, str(path), units_row=False).count() == 5


# statistics ----------------------------------------------------------------
def _series(total):
    data = lambda v: [["2020", str(v)]]
    ids = {c: i for c, i in C.EIA_CATEGORY_IDS.items()}
    return [(f"INTL.{i}-7-AAA-MK.A", data(total if c == "total" else 1.0)) for c, i in ids.items()]


def test_statistics_job_and_its_checksum(spark):
    ddl = "series_id string, data array<array<string>>"
    countries = spark.createDataFrame([("AAA",), ("BBB",)], "country_id string")
    n = len(C.EIA_CATEGORY_IDS) - 1
    total, categories, missing = P.prepare_statistics(spark.createDataFrame(_series(float(n)), ddl), countries)
    assert total.count() == 1 and categories.count() == n and [r[0] for r in missing.collect()] == ["BBB"]
    with pytest.raises(ValueError, match="add up"):
        P.prepare_statistics(spark.createDataFrame(_series(n + 0.5), ddl), countries)


def test_repeated_series(spark):
    rows = _series(9.0)
    ddl = "series_id string, data array<array<string>>, line int"
    countries = spark.createDataFrame([("AAA",)], "country_id string")
    twice = [(*r, 1) for r in rows] + [(rows[0][0], [["2020", "77"]], 0)]
    frame = spark.createDataFrame(twice, ddl)
    with pytest.raises(Exception, match="differing rows"):
        capacity.national_statistics(frame, countries)[0].collect()
    first = capacity.national_statistics(frame, countries, order_col="line")[0]
    assert 77000.0 in {r["capacity_mw"] for r in first.collect()}


# fuel classes --------------------------------------------------------------
def test_classes_are_ranked_in_set_order(spark):
    sets = [["a"], ["a", "b"], ["b"], ["c", "d"], ["b", "z"]]
    frame = spark.createDataFrame([(i % 13, sets[i % 5]) for i in range(100)], "id int, fuels array<string>")
    classes, coded = fuel_classes.encode_sets(frame, "fuels", "x")
    got = {r["fuel_class"]: r["fuels"] for r in fuel_classes.sets_by_class(classes).collect()}
    assert got == {f"x{i}": s for i, s in enumerate(sorted(sets))}
    assert coded.count() == 100


# placement job -------------------------------------------------------------
def _plants(spark, rows):
    ddl = "powerplant_id string, name string, category string, technology string, output_capacity_mw double, start_year double, end_year double, status string, lon double, lat double"
    return spark.createDataFrame([(i, i, c, "ccgt", 10.0, 1990.0, 2050.0, "operating", x, y) for i, c, x, y in rows], ddl)


def _shapes(spark):
    edges = square_edges("A", 0, 0, 10, 10) + square_edges("B", 8, 0, 20, 10)
    return spark.createDataFrame([("A", "AAA", "land"), ("B", "BBB", "land")], "shape_id string, country_id string, shape_class string"), spark.createDataFrame(edges, EDGE_DDL)


def _run(spark, rows, users=(), **more):
    shapes, edges = _shapes(spark)
    where = C.LocationSettings(inner_distance=more.pop("inner", 0.5), on_overlap=more.pop("overlap", "split_capacity"), shape_class={})
    ages = C.ImputationSettings(scenario="historical", lifetime_years={"ccgt": 30.0}, retirement_delay_years={})
    return P.unadjusted_plants(_plants(spark, rows), shapes, edges, more.pop("band", 2.0), ages, where, 2020, users=[_plants(spark, u) for u in users], **more)


def test_users_exclusions_and_split_copies(spark):
    out = {r["powerplant_id"]: r for r in _run(spark, [("p", "fossil", 5.0, 5.0), ("q", "fossil", 9.0, 5.0), ("gone", "fossil", 1.0, 1.0), ("sea", "fossil", 90.0, 1.0)], users=[[("u", "fossil", 15.0, 5.0)]], excluded_ids=["gone"]).collect()}
    assert set(out) == {"p", "u", "q_duplicate_0", "q_duplicate_1"}
    assert (out["p"]["lon"], out["u"]["country_id"]) == (5.0, "BBB")
    # copies move from the overlap towards their shape's middle, without an exclusive table too
    assert np.isclose(out["q_duplicate_0"]["lon"], 8.5) and np.isclose(out["q_duplicate_1"]["lon"], 9.5)
    assert out["q_duplicate_0"]["output_capacity_mw"] == 5.0


def test_placement_in_projected_metres(spark):
    out = {r["powerplant_id"]: r for r in _run(spark, [("p", "fossil", 5.0, 5.0), ("q", "fossil", 9.0, 5.0)], projected_epsg=8857, band=200_000.0, inner=10_000.0).collect()}
    assert np.allclose([out["p"]["lon"], out["p"]["lat"]], [5.0, 5.0], atol=1e-9)
    moved = out["q_duplicate_0"]
    x, y = (spark.createDataFrame([(9.0, 5.0), (moved["lon"], moved["lat"])], "lon double, lat double").select(*[c.alias(n) for n, c in zip("xy", G.project("lon", "lat", 8857))]).collect())
    assert np.isclose(np.hypot(x["x"] - y["x"], x["y"] - y["y"]), 10_000.0, rtol=1e-6)


def test_placement_refuses_mixed_categories_and_other_shapes(spark):
    with pytest.raises(ValueError, match="exactly one category"):
        _run(spark, [("p", "fossil", 5.0, 5.0)], users=[[("w", "wind", 5.0, 5.0)]])
    with pytest.raises(ValueError, match="differ in 1 ids: B"):
        _run(spark, [("p", "fossil", 5.0, 5.0)], exclusive_edges=spark.createDataFrame(square_edges("A", 0, 0, 8, 10), EDGE_DDL))
    with pytest.raises(ValueError, match="Schema check failed"):
        _run(spark, [("p", "fossil", 5.0, 5.0), ("p", "fossil", 6.0, 5.0)])


def test_exclusive_shapes_take_the_copies(spark):
    exclusive = spark.createDataFrame(square_edges("A", 0, 0, 8, 10) + square_edges("B", 10, 0, 20, 10), EDGE_DDL)
    out = {r["powerplant_id"]: r for r in _run(spark, [("q", "fossil", 9.0, 5.0)], exclusive_edges=exclusive).collect()}
    assert np.isclose(out["q_duplicate_0"]["lon"], 7.5) and np.isclose(out["q_duplicate_1"]["lon"], 10.5)


# reports, checks, session ----------------------------------------------------
def test_buildup_has_exact_zeros(spark):
    rows = [("A", "t", 0.1, 1990.0, 1992.0), ("A", "t", 0.2, 1990.0, 1991.0), ("A", "t", 0.3, 1995.0, 1996.0), ("A", "t", 5.0, None, 1994.0), ("A", "t", 5.0, 1994.0, 1991.0), ("B", "s", 1.0, 1991.5, 1993.0)]
    frame = spark.createDataFrame(rows, "country_id string, technology string, output_capacity_mw double, start_year double, end_year double")
    got = {(r["country_id"], r["technology"], r["year"]): r["output_capacity_mw"] for r in reports.capacity_buildup(frame).collect()}
    assert [got["A", "t", y] for y in (1992, 1993, 1994, 1996)] == [0.0] * 4
    assert np.isclose(got["A", "t", 1990], 0.3) and np.isclose(got["A", "t", 1995], 0.3) and got["B", "s", 1992] == 1.0 and got["B", "t", 1992] == 0.0
    assert reports.capacity_buildup(frame.limit(0)).count() == 0


def test_bow_tie_is_invalid(spark):
    ring = [(0, 0), (4, 4), (4, 0), (0, 1)]
    bow = [("bow", 0, 0, i, *map(float, a), *map(float, b)) for i, (a, b) in enumerate(zip(ring, ring[1:] + ring[:1]))]
    got = {r["shape_id"]: (r["simple"], r["valid"]) for r in G.polygon_checks(spark.createDataFrame(bow + square_edges("ok", 0, 0, 3, 3), EDGE_DDL)).collect()}
    assert got == {"bow": (False, False), "ok": (True, True)}


def test_small_measures_before_it_broadcasts(spark):
    frame = spark.range(1000)
    assert "BroadcastHashJoin" in frame.join(small(frame), "id")._jdf.queryExecution().executedPlan().toString()
    hinted = small(frame, limit=100)._jdf.queryExecution().logical().toString()
    assert "hint" not in hinted.lower()


def test_checkpoints_need_a_shared_folder_off_local(spark, monkeypatch):
    assert ensure_checkpoint_dir(spark)
    assert cut_lineage(spark.range(3)).count() == 3

    class Context:
        master = "spark://host:7077"
        getCheckpointDir = staticmethod(lambda: None)

    class Conf:
        get = staticmethod(lambda key, default=None: None)

    class Session:
        sparkContext, conf = Context, Conf

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(Session)


def test_row_rules_stop_the_job_where_they_break(spark):
    from capgrid.operators import quality

    plants = _plants(spark, [("p", "fossil", 5.0, 5.0), ("q", "fossil", None, 5.0)])
    rules = quality.stage_rules(["ccgt"], "prepare")
    with pytest.raises(Exception, match="lon:not_null: q"):
        quality.enforce(plants, rules).collect()
    assert quality.enforce(plants.where("lon IS NOT NULL"), rules).count() == 1
    assert quality.enforce(plants, rules, "skip").count() == 2
    with pytest.raises(Exception, match="technology:isin"):
        quality.enforce(plants, quality.stage_rules(["ocgt"], "prepare")).collect()


def test_solar_from_raw_inputs(spark):
    """Satellite midpoint years, photovoltaic and solar-thermal tracker rows, ratings, and the 1,000 m rule."""
    import datetime as dt

    day = dt.datetime(2018, 1, 1), dt.datetime(2020, 1, 1)
    satellite = spark.createDataFrame([("c1", 5.0, *day)], "cluster_id string, capacity_mw double, constructed_after timestamp, constructed_before timestamp")
    edges = spark.createDataFrame(square_edges("c1", 10, 10, 10.01, 10.01), EDGE_DDL)
    rows = [
        ("in", "PV", "operating", 10.005, 10.005, "MWac"), ("near", None, "announced", 10.015, 10.005, "MWac"), ("far", "PV", "construction", 10.05, 10.005, "MWp/dc"),
        ("runs", "PV", "operating", 11.0, 10.0, "MWac"), ("heat", "Solar Thermal", "operating", 12.0, 10.0, "MWac"),
    ]
    tracker = spark.createDataFrame([(i, i, "n", "u", t, s, x, y, "100", r, "2015", None) for i, t, s, x, y, r in rows],
        "gem_location_id string, gem_phase_id string, project_name string, phase_name string, technology_type string, status string, longitude double, latitude double, `capacity_(mw)` string, capacity_rating string, start_year string, retired_year string")
    got = {r["powerplant_id"]: r for r in P.prepare_solar(satellite, edges, tracker).collect()}
    assert set(got) == {"TZ-SAM_c1", "GEM_far-far", "GEM_heat-heat"}
    assert got["TZ-SAM_c1"]["start_year"] == 2015.0 and got["TZ-SAM_c1"]["status"] == "operating"
    assert got["GEM_far-far"]["output_capacity_mw"] == 80.0 and got["GEM_heat-heat"]["technology"] == "csp"
