"""Independent DuckDB formulations of the stand-ins' derived tables.

These are written directly in SQL (not generated from the Spark code) so
the registered queries are checked against a second implementation.
"""

from __future__ import annotations

from capgrid import config as C
from capgrid.plans import fixtures as FX


def case_map(expr: str, mapping: dict, default: str = "NULL") -> str:
    whens = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in mapping.items())
    return f"CASE {expr} {whens} ELSE {default} END"


def tech_sql(col: str, mapping: dict) -> str:
    key = (
        f"trim(replace(CASE WHEN coalesce({col}, 'unknown') = 'unknown type' THEN 'unknown' "
        f"ELSE coalesce({col}, 'unknown') END, '/CCS', ''))"
    )
    return case_map(key, mapping)


def fuels_sql(text: str, default_fuel: str) -> str:
    clean = "trim(regexp_replace(x, '\\s*\\[.*?\\]', '', 'g'))"
    entry = f"CASE WHEN contains({clean}, ':') THEN {clean} ELSE {clean} || ': unknown' END"
    amb = ", ".join(f"'{a}'" for a in C.AMBIGUOUS_FUELS)
    mapped = case_map("z", C.FUEL_MAPPING)
    lst = (
        f"list_sort(list_distinct(list_transform(list_filter(list_transform(string_split({text}, ','), lambda x: {entry}), "
        f"lambda y: y NOT IN ({amb})), lambda z: {mapped})))"
    )
    return f"CASE WHEN {text} IS NULL OR len({lst}) = 0 THEN ['{default_fuel}'] ELSE {lst} END"


TRACKER = FX.duck(FX.TRACKER_SQL)

CLEAN = """SELECT * FROM tracker
WHERE NOT coalesce(regexp_matches(status, 'cancelled|shelved'), false)
  AND capacity_mw_raw IS NOT NULL AND latitude IS NOT NULL AND longitude IS NOT NULL"""

OG_CLEAN = f"SELECT *, {fuels_sql('fuel_raw', 'natural gas')} AS fuels FROM ({CLEAN})"
OG_CODES = "SELECT fuels, 'og' || CAST(dense_rank() OVER (ORDER BY fuels) - 1 AS VARCHAR) AS fuel_class FROM (SELECT DISTINCT fuels FROM og_clean)"

COAL_TEXT = (
    "CASE WHEN replace(alternate_fuel, ' - ', ': ') IS NOT NULL "
    "THEN trim('coal: ' || coalesce(replace(coal_type, 'with CCS', ''), 'unknown')) || ', ' || trim(replace(alternate_fuel, ' - ', ': ')) "
    "ELSE 'coal: ' || coalesce(replace(coal_type, 'with CCS', ''), 'unknown') END"
)
COAL_CLEAN = f"SELECT *, {fuels_sql('(' + COAL_TEXT + ')', 'brown coal')} AS fuels FROM ({CLEAN})"
COAL_CODES = "SELECT fuels, 'c' || CAST(dense_rank() OVER (ORDER BY fuels) - 1 AS VARCHAR) AS fuel_class FROM (SELECT DISTINCT fuels FROM coal_clean)"


def _coal_status(status_map: dict) -> str:
    """The stand-in coal tracker words one status in its own way."""
    return "CASE WHEN status = 'pre-construction' THEN 'permitted' ELSE status END" if status_map is C.STATUS_MAPPING_COAL else "status"


def _plant_cols(unit_prefix: str, status_map: dict) -> str:
    return f"""
  'GEM_' || coalesce(gem_location_id, 'nan') || '-' || coalesce({unit_prefix}, 'nan') AS powerplant_id,
  coalesce(plant_name, 'nan') || '-' || coalesce(unit_name, 'nan') AS name,
  'fossil' AS category,
  {tech_sql('technology_raw', FX.FIXTURE_TECH_MAP)} AS technology,
  capacity_mw_raw AS output_capacity_mw,
  TRY_CAST(start_year_raw AS DOUBLE) AS start_year,
  CASE WHEN retired_year_raw IS NOT NULL THEN TRY_CAST(retired_year_raw AS DOUBLE)
       ELSE TRY_CAST(planned_retire_raw AS DOUBLE) END AS end_year,
  {case_map(_coal_status(status_map), status_map)} AS status,
  longitude AS lon, latitude AS lat"""


OG_PLANTS = f"""SELECT {_plant_cols('gem_unit_id', C.STATUS_MAPPING)},
  coalesce(ccs_raw = 'yes', false) AS ccs, coalesce(chp_raw = 'yes', false) AS chp,
  k.fuel_class, nation_id AS country_id
FROM og_clean JOIN og_codes k USING (fuels) WHERE capacity_mw_raw > 0"""

COAL_PLANTS = f"""SELECT {_plant_cols("'C' || substr(gem_unit_id, 2)", C.STATUS_MAPPING_COAL)},
  (coalesce(contains(technology_raw, 'CCS'), false) OR coalesce(contains(coal_type, 'CCS'), false)) AS ccs,
  false AS chp, k.fuel_class, nation_id AS country_id
FROM coal_clean JOIN coal_codes k USING (fuels) WHERE capacity_mw_raw > 0"""

FC_CLASSES = """SELECT 'fc' || CAST(dense_rank() OVER (ORDER BY fuels) - 1 AS VARCHAR) AS fuel_class, fuels
FROM (SELECT DISTINCT fuels FROM (SELECT fuels FROM og_codes UNION ALL SELECT fuels FROM coal_codes UNION ALL SELECT fuels FROM bio_codes))"""

FOSSIL = """SELECT p.* EXCLUDE (fuel_class), f.fuel_class FROM (
  SELECT o.*, c.fuels FROM og_plants o JOIN og_codes c USING (fuel_class)
  UNION ALL
  SELECT o.*, c.fuels FROM coal_plants o JOIN coal_codes c USING (fuel_class)) p
JOIN fc_classes f USING (fuels)"""

def _life(mapping: dict) -> str:
    whens = " ".join(f"WHEN '{k}' THEN {float(v)}" for k, v in mapping.items())
    return f"CASE technology {whens} ELSE NULL END"


Y = FX.FIXTURE_YEAR

F1 = f"""SELECT p.* REPLACE (coalesce(p.start_year, p.end_year - {_life(FX.FIXTURE_LIFETIMES)}, m.mean_start) AS start_year)
FROM scen p LEFT JOIN (
  SELECT country_id, category, technology, status, round_even(avg(start_year), 0) AS mean_start
  FROM scen WHERE start_year IS NOT NULL GROUP BY ALL) m
USING (country_id, category, technology, status)"""

F2 = f"""SELECT * REPLACE (CASE WHEN e <= {Y} AND status = 'operating'
    THEN greatest(e + coalesce({_life(FX.FIXTURE_DELAYS)}, 0), {Y + 1}e0) ELSE e END AS end_year)
FROM (SELECT *, coalesce(end_year, start_year + {_life(FX.FIXTURE_LIFETIMES)}) AS e FROM f1)"""

F4 = f"""SELECT * EXCLUDE (e) REPLACE (CASE WHEN end_year <= {Y} THEN 'retired'
    WHEN start_year <= {Y} AND {Y} < end_year THEN 'operating'
    WHEN start_year > {Y} THEN 'planned' ELSE status END AS status)
FROM f2 WHERE start_year IS NOT NULL AND end_year IS NOT NULL"""

SCEN = "SELECT * FROM og_plants WHERE status IN ('operating', 'retired', 'construction')"


def pip(points: str, edges: str, x: str, y: str, id_col: str, boundary: str = "include") -> str:
    """Brute-force point-in-polygon over an edge table."""
    keep = "nc % 2 = 1 OR onb" if boundary == "include" else "nc % 2 = 1 AND NOT onb"
    return f"""SELECT {id_col}, shape_id FROM (
  SELECT p.{id_col}, e.shape_id,
    sum(CASE WHEN (e.y1 > p.{y}) <> (e.y2 > p.{y})
              AND p.{x} < e.x1 + (p.{y} - e.y1) * (e.x2 - e.x1) / (e.y2 - e.y1) THEN 1 ELSE 0 END) AS nc,
    bool_or(((e.x2 - e.x1) * (p.{y} - e.y1) - (e.y2 - e.y1) * (p.{x} - e.x1)) = 0
            AND p.{x} BETWEEN least(e.x1, e.x2) AND greatest(e.x1, e.x2)
            AND p.{y} BETWEEN least(e.y1, e.y2) AND greatest(e.y1, e.y2)) AS onb
  FROM {points} p JOIN {edges} e ON p.{y} BETWEEN least(e.y1, e.y2) AND greatest(e.y1, e.y2)
  GROUP BY 1, 2) WHERE {keep}"""


def seg_dist(px: str, py: str) -> str:
    t = (
        f"least(greatest(CASE WHEN (e.x2-e.x1)*(e.x2-e.x1)+(e.y2-e.y1)*(e.y2-e.y1) > 0 THEN "
        f"(({px}-e.x1)*(e.x2-e.x1)+({py}-e.y1)*(e.y2-e.y1))/((e.x2-e.x1)*(e.x2-e.x1)+(e.y2-e.y1)*(e.y2-e.y1)) ELSE 0 END, 0), 1)"
    )
    return f"sqrt(power({px} - (e.x1 + {t}*(e.x2-e.x1)), 2) + power({py} - (e.y1 + {t}*(e.y2-e.y1)), 2))"


def sweep(edges: str, scope: str, prefix: str = "sw") -> str:
    """CTEs that cover the plane with trapezoids: `{prefix}_cover(scope, lo, hi, xa, xb, shapes)`, the shapes by the even-odd rule over each.

    Between two neighbouring heights at which an edge of the scope ends or
    crosses another, edges keep their order, so the width half-way times the
    height is a trapezoid's exact area.
    """
    return f"""{prefix}_e AS (SELECT {scope} AS scope, shape_id, part, ring, seq, x1, y1, x2, y2 FROM {edges}),
{prefix}_x AS (SELECT scope, y1 + t * dy AS y FROM (
    SELECT a.scope, a.y1, a.y2 - a.y1 AS dy,
      ((b.x1 - a.x1) * (b.y2 - b.y1) - (b.y1 - a.y1) * (b.x2 - b.x1)) / nullif((a.x2 - a.x1) * (b.y2 - b.y1) - (a.y2 - a.y1) * (b.x2 - b.x1), 0) AS t,
      ((b.x1 - a.x1) * (a.y2 - a.y1) - (b.y1 - a.y1) * (a.x2 - a.x1)) / nullif((a.x2 - a.x1) * (b.y2 - b.y1) - (a.y2 - a.y1) * (b.x2 - b.x1), 0) AS u
    FROM {prefix}_e a JOIN {prefix}_e b ON a.scope = b.scope AND least(a.y1, a.y2) <= greatest(b.y1, b.y2) AND least(b.y1, b.y2) <= greatest(a.y1, a.y2)) WHERE t BETWEEN 0 AND 1 AND u BETWEEN 0 AND 1),
{prefix}_b AS (SELECT scope, y AS lo, lead(y) OVER (PARTITION BY scope ORDER BY y) AS hi FROM (
    SELECT scope, y1 AS y FROM {prefix}_e UNION SELECT scope, y FROM {prefix}_x)),
{prefix}_h AS (SELECT b.scope, lo, hi, shape_id, x1 + ((lo + hi) / 2 - y1) * (x2 - x1) / (y2 - y1) AS x
  FROM {prefix}_b b JOIN {prefix}_e e ON b.scope = e.scope AND (y1 > (lo + hi) / 2) <> (y2 > (lo + hi) / 2) WHERE hi > lo),
{prefix}_s AS (SELECT scope, lo, hi, x AS xa, lead(x) OVER (PARTITION BY scope, lo ORDER BY x) AS xb FROM {prefix}_h),
{prefix}_cover AS (SELECT scope, lo, hi, xa, xb, list(shape_id ORDER BY shape_id) AS shapes FROM (
    SELECT s.scope, s.lo, s.hi, s.xa, s.xb, h.shape_id FROM {prefix}_s s JOIN {prefix}_h h ON s.scope = h.scope AND s.lo = h.lo AND h.x <= s.xa
    WHERE s.xb > s.xa GROUP BY ALL HAVING count(*) % 2 = 1) GROUP BY ALL)"""


def ctes(**parts: str) -> str:
    return "WITH " + ",\n".join(f"{k} AS ({v})" for k, v in parts.items()) + "\n"


BASE = dict(tracker=TRACKER, og_clean=OG_CLEAN, og_codes=OG_CODES, og_plants=OG_PLANTS)
BIO = dict(
    bio_clean=f"SELECT *, {fuels_sql('fuel_raw', 'biomass')} AS fuels FROM ({CLEAN})",
    bio_codes="SELECT DISTINCT fuels FROM bio_clean",
)
COAL = dict(coal_clean=COAL_CLEAN, coal_codes=COAL_CODES, coal_plants=COAL_PLANTS)
AGES = dict(scen=SCEN, f1=F1, f2=F2, f4=F4)
SHAPES = dict(shapes=FX.duck(FX.shapes_sql(False)), edges=FX.duck(FX.edges_sql(False)))
SHAPES_OV = dict(shapes_ov=FX.duck(FX.shapes_sql(True)), edges_ov=FX.duck(FX.edges_sql(True)))
STATS = dict(stats=FX.duck(FX.STATS_SQL))
PIXELS = dict(pixels=FX.duck(FX.PIXELS_SQL))
FAC = dict(
    facilities=FX.duck(FX.FACILITIES_SQL),
    facility_edges=FX.duck(FX.FACILITY_EDGES_SQL),
    tracker_points=FX.duck(FX.TRACKER_POINTS_SQL),
)


def _class_case(mapping: dict) -> str:
    return case_map("technology", mapping)


def relocation(inner: float, shape_class: dict) -> dict:
    """CTEs: assign country (E16), keep plants already in a shape of their class,
    move the others just inside the nearest one (E6, E10, E9, E15).  Needs
    og_plants, shapes, edges; produces `reloc`."""
    seg = seg_dist("p.lon", "p.lat")
    tcl = "least(greatest(CASE WHEN (e.x2-e.x1)*(e.x2-e.x1)+(e.y2-e.y1)*(e.y2-e.y1) > 0 THEN ((p.lon-e.x1)*(e.x2-e.x1)+(p.lat-e.y1)*(e.y2-e.y1))/((e.x2-e.x1)*(e.x2-e.x1)+(e.y2-e.y1)*(e.y2-e.y1)) ELSE 0 END, 0), 1)"
    cross_sum = "sum(CASE WHEN (e.y1 > q.y) <> (e.y2 > q.y) AND q.x < e.x1 + (q.y - e.y1) * (e.x2 - e.x1) / (e.y2 - e.y1) THEN 1 ELSE 0 END) % 2 = 1"
    return dict(
        m0=pip("og_plants", "edges", "lon", "lat", "powerplant_id"),
        asg=("SELECT p.* EXCLUDE (country_id), s.country_id, false AS split FROM og_plants p "
             "JOIN m0 USING (powerplant_id) JOIN shapes s ON s.shape_id = m0.shape_id"),
        tgt=f"SELECT *, {_class_case(shape_class)} AS tcls FROM asg",
        valid=("SELECT t.* FROM tgt t WHERE tcls IS NOT NULL AND EXISTS "
               "(SELECT 1 FROM shapes s WHERE s.country_id = t.country_id AND s.shape_class = t.tcls)"),
        win=pip("valid", "edges", "lon", "lat", "powerplant_id", boundary="exclude"),
        okp=("SELECT v.* FROM valid v WHERE EXISTS (SELECT 1 FROM win w JOIN shapes s USING (shape_id) "
             "WHERE w.powerplant_id = v.powerplant_id AND s.country_id = v.country_id AND s.shape_class = v.tcls)"),
        mv="SELECT * FROM valid WHERE powerplant_id NOT IN (SELECT powerplant_id FROM okp)",
        mvin=pip("mv", "edges", "lon", "lat", "powerplant_id"),
        dist=f"""SELECT p.powerplant_id, s.shape_id, CASE WHEN i.shape_id IS NOT NULL THEN 0e0 ELSE min({seg}) END AS d
  FROM mv p JOIN shapes s ON s.country_id = p.country_id AND s.shape_class = p.tcls JOIN edges e ON e.shape_id = s.shape_id
  LEFT JOIN mvin i ON i.powerplant_id = p.powerplant_id AND i.shape_id = s.shape_id GROUP BY p.powerplant_id, s.shape_id, i.shape_id""",
        best="SELECT powerplant_id, arg_min(shape_id, (d, shape_id)) AS shape_id FROM dist GROUP BY 1",
        pin=f"""SELECT q.powerplant_id, e.part, {cross_sum} AS ins
  FROM (SELECT powerplant_id, lon AS x, lat AS y FROM mv) q JOIN best b USING (powerplant_id)
  JOIN edges e ON e.shape_id = b.shape_id AND q.y BETWEEN least(e.y1, e.y2) AND greatest(e.y1, e.y2) GROUP BY 1, 2""",
        pdist=f"""SELECT p.powerplant_id, b.shape_id, e.part, CASE WHEN coalesce(any_value(pi.ins), false) THEN 0e0 ELSE min({seg}) END AS dd
  FROM mv p JOIN best b USING (powerplant_id) JOIN edges e ON e.shape_id = b.shape_id
  LEFT JOIN pin pi ON pi.powerplant_id = p.powerplant_id AND pi.part = e.part GROUP BY 1, 2, 3""",
        bpart="SELECT powerplant_id, any_value(shape_id) AS shape_id, arg_min(part, (dd, part)) AS part FROM pdist GROUP BY 1",
        pedges="SELECT e.*, e.shape_id || '#' || CAST(e.part AS VARCHAR) AS pk FROM edges e",
        contact=f"""SELECT p.powerplant_id, b.shape_id || '#' || CAST(b.part AS VARCHAR) AS pk, any_value(p.lon) AS px, any_value(p.lat) AS py,
    arg_min({{'x': e.x1 + {tcl} * (e.x2 - e.x1), 'y': e.y1 + {tcl} * (e.y2 - e.y1)}}, {seg}) AS c
  FROM mv p JOIN bpart b USING (powerplant_id) JOIN edges e ON e.shape_id = b.shape_id AND e.part = b.part GROUP BY 1, 2""",
        ray="""SELECT k.powerplant_id, k.pk, k.c.x AS cx, k.c.y AS cy,
    (k.c.x - k.px) / sqrt(power(k.c.x - k.px, 2) + power(k.c.y - k.py, 2)) AS ux,
    (k.c.y - k.py) / sqrt(power(k.c.x - k.px, 2) + power(k.c.y - k.py, 2)) AS uy,
    sqrt(power(max(greatest(e.x1, e.x2)) OVER w - min(least(e.x1, e.x2)) OVER w, 2)
       + power(max(greatest(e.y1, e.y2)) OVER w - min(least(e.y1, e.y2)) OVER w, 2)) AS span
  FROM contact k JOIN pedges e USING (pk) WINDOW w AS (PARTITION BY k.powerplant_id) QUALIFY row_number() OVER w = 1""",
        hitsr=f"""SELECT r.powerplant_id, r.pk, r.cx, r.cy, r.ux, r.uy, (r.span + {inner}) AS ext,
    min(CASE WHEN abs((r.ux * (r.span + {inner})) * (e.y2 - e.y1) - (r.uy * (r.span + {inner})) * (e.x2 - e.x1)) > 1e-12 THEN
      ((e.x1 - r.cx) * (e.y2 - e.y1) - (e.y1 - r.cy) * (e.x2 - e.x1)) / ((r.ux * (r.span + {inner})) * (e.y2 - e.y1) - (r.uy * (r.span + {inner})) * (e.x2 - e.x1)) END)
      FILTER (WHERE abs((r.ux * (r.span + {inner})) * (e.y2 - e.y1) - (r.uy * (r.span + {inner})) * (e.x2 - e.x1)) > 1e-12
        AND ((e.x1 - r.cx) * (e.y2 - e.y1) - (e.y1 - r.cy) * (e.x2 - e.x1)) / ((r.ux * (r.span + {inner})) * (e.y2 - e.y1) - (r.uy * (r.span + {inner})) * (e.x2 - e.x1)) BETWEEN 1e-9 AND 1
        AND ((e.x1 - r.cx) * (r.uy * (r.span + {inner})) - (e.y1 - r.cy) * (r.ux * (r.span + {inner}))) / ((r.ux * (r.span + {inner})) * (e.y2 - e.y1) - (r.uy * (r.span + {inner})) * (e.x2 - e.x1)) BETWEEN 0 AND 1) AS t1
  FROM ray r JOIN pedges e USING (pk) GROUP BY 1, 2, 3, 4, 5, 6, 7""",
        placed=f"""SELECT powerplant_id, pk, cx + ux * CASE WHEN {inner} < coalesce(t1, 1) * ext THEN {inner} ELSE coalesce(t1, 1) * ext / 2 END AS nx,
    cy + uy * CASE WHEN {inner} < coalesce(t1, 1) * ext THEN {inner} ELSE coalesce(t1, 1) * ext / 2 END AS ny FROM hitsr""",
        reloc="""SELECT * EXCLUDE (tcls), false AS moved FROM tgt WHERE tcls IS NULL
UNION ALL BY NAME SELECT * EXCLUDE (tcls), false AS moved FROM okp
UNION ALL BY NAME SELECT v.* EXCLUDE (tcls, lon, lat), pl.nx AS lon, pl.ny AS lat, true AS moved FROM mv v JOIN placed pl USING (powerplant_id)""",
    )


def aged_from(src: str) -> dict:
    """The F1-F4 chain over another plant table (replacing the scenario source)."""
    return dict(scen=SCEN.replace("FROM og_plants", f"FROM {src}"), f1=F1, f2=F2, f4=F4)
