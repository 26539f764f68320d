"""Category jobs (P1-P11): DataFrame in, DataFrame out, one lazy plan each.

Tracker column names default to the normalised tracker headers; every job
takes a `cols` override so differently labelled inputs can be used as is.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from capgrid import config as C
from capgrid.functions import columns as X
from capgrid.functions.fuels import parse_fuel_set
from capgrid.operators import capacity, fuel_classes, geometry, impute, quality, raster
from capgrid.operators.place import relocate
from capgrid.session import cut_lineage
from capgrid.sources.readers import combine_with_user_plants, drop_invalid_status, drop_missing

PLANT_COLUMNS = [
    "powerplant_id", "name", "category", "technology", "output_capacity_mw",
    "start_year", "end_year", "status", "lon", "lat",
]

OIL_GAS_COLS = {
    "capacity": "capacity_(mw)", "lat": "latitude", "lon": "longitude", "status": "status",
    "location_id": "gem_location_id", "unit_id": "gem_unit_id", "plant_name": "plant_name", "unit_name": "unit_name",
    "technology": "turbine/engine_technology", "start": "start_year", "retired": "retired_year",
    "planned_retire": "planned_retire", "fuel": "fuel", "ccs": "ccs_attachment?", "chp": "chp",
}
COAL_COLS = {
    "capacity": "capacity_(mw)", "lat": "latitude", "lon": "longitude", "status": "status",
    "location_id": "gem_location_id", "unit_id": "gem_unit/phase_id", "plant_name": "plant_name", "unit_name": "unit_name",
    "technology": "combustion_technology", "start": "start_year", "retired": "retired_year",
    "planned_retire": "planned_retirement", "coal_type": "coal_type", "alternate_fuel": "alternate_fuel",
}
BIO_COLS = {
    "capacity": "capacity_(mw)", "lat": "latitude", "lon": "longitude", "status": "status",
    "location_id": "gem_location_id", "unit_id": "gem_phase_id", "plant_name": "project_name", "unit_name": "unit_name",
    "start": "start_year", "conversion": "unit_conversion_year", "retired": "retired_year", "fuel": "fuel",
}
GEO_COLS = {
    "capacity": "unit_capacity_(mw)", "lat": "latitude", "lon": "longitude", "status": "status",
    "location_id": "gem_location_id", "unit_id": "gem_unit_id", "plant_name": "project_name", "unit_name": "unit_name",
    "technology": "technology", "start": "start_year", "retired": "retired_year",
}
NUCLEAR_COLS = {
    "capacity": "capacity_(mw)", "lat": "latitude", "lon": "longitude", "status": "status",
    "location_id": "gem_location_id", "unit_id": "gem_unit_id", "plant_name": "project_name", "unit_name": "unit_name",
    "technology": "reactor_type", "start_date": "commercial_operation_date", "end_date": "retirement_date",
}
WIND_COLS = {
    "capacity": "capacity_(mw)", "lat": "latitude", "lon": "longitude", "status": "status",
    "location_id": "gem_location_id", "unit_id": "gem_phase_id", "plant_name": "project_name", "unit_name": "phase_name",
    "installation": "installation_type", "start": "start_year", "retired": "retired_year",
}
SOLAR_COLS = {
    "capacity": "capacity_(mw)", "lat": "latitude", "lon": "longitude", "status": "status",
    "location_id": "gem_location_id", "unit_id": "gem_phase_id", "plant_name": "project_name", "unit_name": "phase_name",
    "rating": "capacity_rating", "type": "technology_type", "start": "start_year", "retired": "retired_year",
}


def _cols(defaults: Mapping[str, str], override: Mapping[str, str] | None) -> dict:
    out = dict(defaults)
    out.update(override or {})
    return out


def _clean(raw: DataFrame, c: Mapping[str, str]) -> DataFrame:
    """A3 + A4 on a tracker."""
    return drop_missing(drop_invalid_status(raw, c["status"]), [c["capacity"], c["lat"], c["lon"]])


def _base(c: Mapping[str, str], category: str, technology, start, end, status_map=C.STATUS_MAPPING) -> list:
    return [
        X.combined_text([c["location_id"], c["unit_id"]], prefix="GEM_").alias("powerplant_id"),
        X.combined_text([c["plant_name"], c["unit_name"]]).alias("name"),
        F.lit(category).alias("category"),
        technology.alias("technology"),
        F.col(c["capacity"]).cast("double").alias("output_capacity_mw"),
        start.alias("start_year"),
        end.alias("end_year"),
        X.map_status(c["status"], status_map).alias("status"),
        F.col(c["lon"]).cast("double").alias("lon"),
        F.col(c["lat"]).cast("double").alias("lat"),
    ]


def _published(plants: DataFrame, tech_map: Mapping[str, str], mode: str) -> DataFrame:
    """The prepared table with its row rules (I2, I3) enforced in the plan."""
    return quality.enforce(plants, quality.stage_rules(tech_map.values(), "prepare"), mode)


# P2 -----------------------------------------------------------------------
def prepare_oil_gas(raw: DataFrame, tech_map: Mapping[str, str], fuel_map: Mapping[str, str] = C.FUEL_MAPPING, cols=None, keep=(), quality_mode: str = "raise"):
    """(plants, fuel class table) of the oil and gas tracker; `keep` passes raw columns through."""
    c = _cols(OIL_GAS_COLS, cols)
    clean = _clean(raw, c).withColumn("_fuels", parse_fuel_set(c["fuel"], fuel_map, "fossil gas: unknown"))
    classes, coded = fuel_classes.encode_sets(clean, "_fuels", "og")
    plants = coded.select(
        *_base(
            c, "fossil", X.map_technology(c["technology"], tech_map), X.coerce_year(c["start"]),
            X.first_present_number(c["retired"], c["planned_retire"]),
        ),
        X.yes_flag(c["ccs"]).alias("ccs"),
        X.yes_flag(c["chp"]).alias("chp"),
        "fuel_class",
        *keep,
    )
    return _published(plants.where(F.col("output_capacity_mw") > 0), tech_map, quality_mode), classes


def prepare_coal(raw: DataFrame, tech_map: Mapping[str, str], fuel_map: Mapping[str, str] = C.FUEL_MAPPING, cols=None, quality_mode: str = "raise"):
    """(plants, fuel class table) of the coal tracker."""
    c = _cols(COAL_COLS, cols)
    fuel_text = X.coal_fuel_text(c["coal_type"], c["alternate_fuel"])
    clean = _clean(raw, c).withColumn("_fuels", parse_fuel_set(fuel_text, fuel_map, "coal: unknown"))
    classes, coded = fuel_classes.encode_sets(clean, "_fuels", "c")
    plants = coded.select(
        *_base(
            c, "fossil", X.map_technology(c["technology"], tech_map), X.coerce_year(c["start"]),
            X.first_present_number(c["retired"], c["planned_retire"]), C.STATUS_MAPPING_COAL,
        ),
        X.contains_flag(c["technology"], c["coal_type"], token="CCS").alias("ccs"),
        F.lit(False).alias("chp"),
        "fuel_class",
    )
    return _published(plants.where(F.col("output_capacity_mw") > 0), tech_map, quality_mode), classes


def prepare_fossil(og_raw, coal_raw, og_tech, coal_tech, fuel_map=C.FUEL_MAPPING, og_cols=None, coal_cols=None, other_classes: Sequence[DataFrame] = ()):
    """P2 + D3 + D4: both trackers as one fossil table; classes harmonised with each other and with `other_classes`."""
    og, og_classes = prepare_oil_gas(og_raw, og_tech, fuel_map, og_cols)
    coal, coal_classes = prepare_coal(coal_raw, coal_tech, fuel_map, coal_cols)
    classes = fuel_classes.harmonise_classes([coal_classes, og_classes, *other_classes])
    plants = fuel_classes.remap_classes(og, og_classes, classes).unionByName(
        fuel_classes.remap_classes(coal, coal_classes, classes)
    )
    return plants, classes


def prepare_burners(bio_raw, og_raw, coal_raw, og_tech, coal_tech, fuel_map=C.FUEL_MAPPING, bio_tech=C.TECHNOLOGY_MAPPING["bioenergy"], bio_cols=None, og_cols=None, coal_cols=None):
    """P1 + P2: (bioenergy, fossil, classes) with one class table for all three burner trackers."""
    bio, bio_classes = prepare_bioenergy(bio_raw, bio_tech, fuel_map, bio_cols)
    fossil, classes = prepare_fossil(og_raw, coal_raw, og_tech, coal_tech, fuel_map, og_cols, coal_cols, [bio_classes])
    return fuel_classes.remap_classes(bio, bio_classes, classes), fossil, classes


# P1 -----------------------------------------------------------------------
def prepare_bioenergy(raw: DataFrame, tech_map: Mapping[str, str] = C.TECHNOLOGY_MAPPING["bioenergy"], fuel_map=C.FUEL_MAPPING, cols=None, quality_mode: str = "raise"):
    c = _cols(BIO_COLS, cols)
    clean = _clean(raw, c).withColumn("_fuels", parse_fuel_set(c["fuel"], fuel_map, "bioenergy: unknown"))
    classes, coded = fuel_classes.encode_sets(clean, "_fuels", "b")
    plants = coded.select(
        *_base(
            c, "bioenergy", F.lit(tech_map["unknown"]),
            X.first_present_number(c["conversion"], c["start"]), X.coerce_year(c["retired"]),
        ),
        F.lit(False).alias("ccs"),
        F.lit(False).alias("chp"),
        "fuel_class",
    )
    return _published(plants, tech_map, quality_mode), classes


# P3 -----------------------------------------------------------------------
def prepare_geothermal(raw: DataFrame, tech_map=C.TECHNOLOGY_MAPPING["geothermal"], cols=None, quality_mode: str = "raise") -> DataFrame:
    c = _cols(GEO_COLS, cols)
    plants = _clean(raw, c).select(
        *_base(c, "geothermal", X.map_technology(c["technology"], tech_map), X.coerce_year(c["start"]), X.coerce_year(c["retired"]))
    )
    return _published(plants, tech_map, quality_mode)


# P4 -----------------------------------------------------------------------
def prepare_hydropower(raw: DataFrame, tech_map=C.TECHNOLOGY_MAPPING["hydropower"], quality_mode: str = "raise") -> DataFrame:
    clean = drop_missing(raw, ["capacity_mw", "plant_lon", "plant_lat"])
    plants = clean.select(
        X.with_prefix("GloHydroRes_", "ID").alias("powerplant_id"),
        F.col("name").cast("string").alias("name"),
        F.lit("hydropower").alias("category"),
        X.map_plain("plant_type", tech_map, default="unknown").alias("technology"),
        F.col("capacity_mw").cast("double").alias("output_capacity_mw"),
        F.col("year").cast("double").alias("start_year"),
        F.lit(None).cast("double").alias("end_year"),
        F.lit("operating").alias("status"),
        F.col("plant_lon").cast("double").alias("lon"),
        F.col("plant_lat").cast("double").alias("lat"),
        X.non_negative_or_null(F.col("res_vol_km3").cast("double")).alias("reservoir_km3"),
    )
    return _published(plants, tech_map, quality_mode)


# P5 -----------------------------------------------------------------------
def prepare_nuclear(raw: DataFrame, tech_map=C.TECHNOLOGY_MAPPING["nuclear"], cols=None, quality_mode: str = "raise") -> DataFrame:
    c = _cols(NUCLEAR_COLS, cols)
    plants = _clean(raw, c).select(
        *_base(
            c, "nuclear", X.map_technology(c["technology"], tech_map),
            X.year_of_mixed_date(c["start_date"]), X.year_of_mixed_date(c["end_date"]),
        )
    )
    return _published(plants, tech_map, quality_mode)


# P7 -----------------------------------------------------------------------
def prepare_wind_tracker(raw: DataFrame, tech_map=C.TECHNOLOGY_MAPPING["wind"], cols=None, quality_mode: str = "raise") -> DataFrame:
    c = _cols(WIND_COLS, cols)
    clean = _clean(raw, c)
    clean = clean.where(F.col(c["installation"]).isNotNull() & (F.col(c["installation"]) != "Unknown"))
    tech = F.try_element_at(X.map_literal(tech_map), X.map_plain(c["installation"], C.WIND_INSTALLATION_MAPPING))
    plants = clean.select(*_base(c, "wind", tech, X.coerce_year(c["start"]), X.coerce_year(c["retired"])))
    return _published(plants, tech_map, quality_mode)


def prepare_wind_market(raw: DataFrame, tech_map=C.TECHNOLOGY_MAPPING["wind"], quality_mode: str = "raise") -> DataFrame:
    """Wind market file (sentinel-null sheet, kW capacities, replace-style statuses)."""
    clean = raw.dropna(subset=["Total power", "Latitude", "Longitude"])
    plants = clean.select(
        X.with_prefix("WEMI_", "ID").alias("powerplant_id"),
        F.col("Name").cast("string").alias("name"),
        F.lit("wind").alias("category"),
        F.try_element_at(X.map_literal(tech_map), X.offshore_flag("Offshore\nShore distance")).alias("technology"),
        X.kw_to_mw("Total power").alias("output_capacity_mw"),
        X.first_year_in_text("Commissioning date").alias("start_year"),
        F.lit(None).cast("double").alias("end_year"),
        X.map_status("Status", C.STATUS_MAPPING_WIND_MARKET, keep_unmapped=True).alias("status"),
        F.col("Longitude").cast("double").alias("lon"),
        F.col("Latitude").cast("double").alias("lat"),
    )
    return _published(plants, tech_map, quality_mode)


# P6 -----------------------------------------------------------------------
def prepare_solar_tracker(raw: DataFrame, tech_name: str, types, dc_ac_ratio: float, cols=None) -> DataFrame:
    """Solar tracker rows of the given technology types, capacity in AC."""
    c = _cols(SOLAR_COLS, cols)
    clean = _clean(raw, c).withColumn("_type", X.solar_type(c["type"])).where(F.col("_type").isin(list(types)))
    return clean.select(
        *_base(c, "solar", F.lit(tech_name), X.coerce_year(c["start"]), X.coerce_year(c["retired"]))[:4],
        X.ac_capacity(c["capacity"], c["rating"], dc_ac_ratio, "AC").alias("output_capacity_mw"),
        *_base(c, "solar", F.lit(tech_name), X.coerce_year(c["start"]), X.coerce_year(c["retired"]))[5:],
    )


def prepare_large_solar(
    facilities: DataFrame,
    facility_edges: DataFrame,
    tracker: DataFrame,
    buffer: float = 1000.0,
    pv_name: str = "utility pv",
    valid_status=("announced", "pre-construction", "construction", "retired"),
    fill_epsg: int = 3857,
    buffer_epsg: int = 8857,
    band: float = 100_000.0,
    csp: DataFrame | None = None,
    csp_name: str = "csp",
    quality_mode: str = "raise",
) -> DataFrame:
    """Satellite facilities filled from tracker points (F5), plus tracker points
    of non-operating projects far from every facility (E5), plus the `csp` rows;
    all as points in degrees.

    Points are matched to facilities in `fill_epsg` and kept `buffer` metres
    away in `buffer_epsg`; `band` is the index height in the same metres.
    """
    if not valid_status:
        raise ValueError("valid_status names no status")

    def projected(df, epsg):
        x, y = geometry.project("lon", "lat", epsg)
        return df.withColumns({"_x": x, "_y": y})

    # tracker points strictly inside a facility
    within = geometry.points_in_shapes(
        projected(tracker, fill_epsg).select("_x", "_y", "start_year", "end_year", "status"),
        geometry.project_edges(facility_edges, fill_epsg), band, x="_x", y="_y", boundary="exclude",
    )
    filled = impute.fill_from_points(facilities, within, fac_id="shape_id")
    # Facilities become their representative points
    rep = geometry.representative_points(facility_edges)
    fac_points = filled.join(rep, on="shape_id").select(
        F.concat(F.lit("TZ-SAM_"), F.col("shape_id")).alias("powerplant_id"),
        F.concat(F.lit("TZ-SAM cluster "), F.col("shape_id")).alias("name"),
        F.lit("solar").alias("category"),
        F.lit(pv_name).alias("technology"),
        F.col("output_capacity_mw").cast("double"),
        F.col("start_year").cast("double"),
        F.col("end_year").cast("double"),
        "status",
        F.col("rx").alias("lon"),
        F.col("ry").alias("lat"),
    )
    # E5: non-operating tracker points with no facility within the buffer
    future = tracker.where(F.col("status").isin(list(valid_status)))
    near = geometry.points_within_distance(
        projected(future, buffer_epsg).select("powerplant_id", "_x", "_y"), geometry.project_edges(facility_edges, buffer_epsg), buffer, band, x="_x", y="_y", pairs=False,
    )
    mismatch = future.join(near.select("powerplant_id"), on="powerplant_id", how="left_anti")
    pv = fac_points.unionByName(mismatch.select(*PLANT_COLUMNS))
    every = pv if csp is None else pv.unionByName(csp.select(*PLANT_COLUMNS))
    return _published(every, {"utility_pv": pv_name, "csp": csp_name}, quality_mode)


def prepare_satellite(raw: DataFrame, pv_name: str = "utility pv") -> DataFrame:
    """Satellite clusters (B9): operating since the middle of their detection window."""
    return raw.select(
        F.col("cluster_id").alias("shape_id"),
        F.col("capacity_mw").cast("double").alias("output_capacity_mw"),
        X.midpoint_year("constructed_after", "constructed_before").alias("start_year"),
        F.lit(None).cast("double").alias("end_year"),
        F.lit("operating").alias("status"),
        F.lit(pv_name).alias("technology"),
    )


def prepare_solar(
    satellite: DataFrame, satellite_edges: DataFrame, tracker: DataFrame,
    pv_name: str = "utility pv", csp_name: str = "csp", dc_ac_ratio: float = 1.25, buffer: float = 1000.0, cols=None,
) -> DataFrame:
    """P6 from the raw inputs: satellite clusters, photovoltaic and solar-thermal rows of the tracker."""
    pv = prepare_solar_tracker(tracker, pv_name, X.PV_TYPES, dc_ac_ratio, cols)
    csp = prepare_solar_tracker(tracker, csp_name, [X.CSP_TYPE], 1.0, cols)
    return prepare_large_solar(prepare_satellite(satellite, pv_name), satellite_edges, pv, buffer, pv_name, csp=csp, csp_name=csp_name)


# P8 -----------------------------------------------------------------------
def unadjusted_plants(
    plants: DataFrame,
    shapes: DataFrame,
    edges: DataFrame,
    band: float,
    imputation: C.ImputationSettings,
    location: C.LocationSettings,
    year: int = C.DATASET_YEAR,
    exclusive_edges: DataFrame | None = None,
    quality_mode: str = "raise",
    tech_values=None,
    users: Sequence[DataFrame] = (),
    excluded_ids: Sequence[str] = (),
    projected_epsg: int = 4326,
) -> DataFrame:
    """Combine with user plants (A11), assign countries (E16), relocate misplaced
    technologies (E15), impute ages (F4).

    The combined table must hold one category and pass the "prepare" rules; the
    exclusive shapes must have the ids of `shapes`.  Points and edges are in
    degrees and are worked on in `projected_epsg`, whose unit `band` and the
    distances of `location` have; the result is in degrees again.

    The published table is checked against the "impute" stage rules (I2/I3)
    with `quality_mode` ("raise", "report" or "skip"); `tech_values`, when
    given, adds the technology vocabulary rule.

    The assigned table feeds several branches of the relocation (already
    inside / to move / untouched), so its lineage is cut once with a reliable
    checkpoint instead of re-running the spatial join per branch; the result
    is materialised the same way because it is a published table that the
    adjustment and aggregation jobs read more than once.
    """
    if users or excluded_ids:
        plants = combine_with_user_plants(plants, users, excluded_ids)
    before = [r for r in quality.stage_rules(tech_values or [], "prepare") if tech_values is not None or (r.column, r.kind) != ("technology", "isin")]
    plants = quality.checked(plants, before, quality_mode, one_category=True)
    if exclusive_edges is not None:
        odd = sorted(r[0] for r in quality.mismatched_ids(shapes, exclusive_edges).collect())
        if odd:
            raise ValueError(f"shapes and exclusive shapes differ in {len(odd)} ids: {', '.join(odd)}")
    if projected_epsg != 4326:
        x, y = geometry.project("lon", "lat", projected_epsg)
        plants = plants.withColumns({"lon": x, "lat": y})
        edges = geometry.project_edges(edges, projected_epsg)
        exclusive_edges = None if exclusive_edges is None else geometry.project_edges(exclusive_edges, projected_epsg)
    assigned = cut_lineage(geometry.assign_country(
        plants, shapes, edges, band, on_overlap=location.on_overlap, exclusive=exclusive_edges, inner_distance=location.inner_distance,
    ))
    # relocation output is read twice by the imputation (group means, join back)
    placed = cut_lineage(relocate(
        assigned.drop("shape_id"), shapes, exclusive_edges if exclusive_edges is not None else edges, band,
        location.shape_class, location.inner_distance, location.on_shape_class_error,
    ))
    if projected_epsg != 4326:
        lon, lat = geometry.unproject("lon", "lat", projected_epsg)
        placed = placed.withColumns({"lon": lon, "lat": lat})
    aged = impute.impute_time(
        placed, imputation.scenario, imputation.lifetime_years, imputation.retirement_delay_years, year
    )
    published = cut_lineage(aged)
    rules = quality.stage_rules(tech_values or [], "impute")
    if tech_values is None:
        rules = [r for r in rules if not (r.column == "technology" and r.kind == "isin")]
    return quality.gate(published, rules, quality_mode)


# P9 -----------------------------------------------------------------------
def adjusted_plants(unadjusted: DataFrame, stats: DataFrame, year: int, category: str, quality_mode: str = "raise") -> DataFrame:
    out = capacity.adjust_capacity(unadjusted, stats, year, category)
    return quality.checked(out, [quality.Rule("powerplant_id", "unique"), quality.Rule("output_capacity_mw", "gt", 0)], quality_mode)


# P10 ----------------------------------------------------------------------
def aggregated(plants: DataFrame, shapes: DataFrame, edges: DataFrame, year: int, band: float, quality_mode: str = "raise") -> DataFrame:
    return quality.checked(capacity.aggregate_capacity(plants, shapes, edges, year, band), quality.AGGREGATED_RULES, quality_mode)


# P11 ----------------------------------------------------------------------
def adjusted_solar(
    stats: DataFrame,
    large_agg: DataFrame,
    pixels: DataFrame,
    shapes: DataFrame,
    edges: DataFrame,
    band: float,
    year: int,
    technology: str = "rooftop pv",
) -> DataFrame:
    """Rooftop = national solar - large solar, spread by the proxy raster, summed per shape."""
    totals = raster.missing_capacity(stats, large_agg, year, "solar")
    land, land_edges = geometry.country_borders(shapes, edges)
    proxy = raster.disaggregate_by_proxy(totals, pixels, land, land_edges, band)
    roof = raster.zonal_sum(proxy, shapes, edges, band)
    return raster.combine_solar(roof, large_agg, technology)


# National statistics ------------------------------------------------------
def prepare_statistics(series: DataFrame, countries: DataFrame, rel_tol: float = 1e-9, order_col: str | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(total rows, category rows, missing countries) from raw series.

    Fails when the categories do not add up to the totals.
    """
    stats, missing = capacity.national_statistics(series, countries, order_col=order_col)
    stats = cut_lineage(stats)  # read by the checksum and by both results
    total, categories, check = capacity.split_total(stats, rel_tol)
    capacity.checksum_gate(check)
    return total, categories, missing
