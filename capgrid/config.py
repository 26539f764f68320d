"""Settings and fixed look-up values.

Everything that must equal the upstream inventory conventions is stated
once, below, as plain data.  Operators receive these through arguments so a
user can override any of them; nothing here is read implicitly by a job.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# --------------------------------------------------------------------------
# FIXED VALUES (must match the upstream data conventions for right results)
# --------------------------------------------------------------------------

#: Reference year of the inventories (the year the data sets were last updated).
DATASET_YEAR = 2023

#: Status values that remove a tracker row (substring match, case-sensitive).
INVALID_STATUS_VALUES = ["cancelled", "shelved"]

#: Columns whose null removes a tracker row.
DROPPED_NA_COLUMNS = ["capacity_(mw)", "latitude", "longitude"]

#: Generic tracker status map.
STATUS_MAPPING = {
    "announced": "announced",
    "pre-construction": "pre-construction",
    "construction": "construction",
    "operating": "operating",
    "mothballed": "retired",
    "retired": "retired",
}

#: Coal tracker status map.
STATUS_MAPPING_COAL = {
    "announced": "announced",
    "pre-permit": "pre-construction",
    "permitted": "pre-construction",
    "construction": "construction",
    "operating": "operating",
    "mothballed": "retired",
    "retired": "retired",
}

#: Wind market file status map (applied as a replace: unmapped text survives).
STATUS_MAPPING_WIND_MARKET = {
    "Planned": "announced",
    "Approved": "pre-construction",
    "Construction": "construction",
    "Production": "operating",
    "Dismantled": "retired",
}

#: Solar capacity rating labels.
CAPACITY_RATING_MAPPING = {"MWac": "AC", "MWp/dc": "DC"}

#: Wind tracker installation types.
WIND_INSTALLATION_MAPPING = {
    "Onshore": "onshore",
    "Offshore floating": "offshore",
    "Offshore hard mount": "offshore",
    "Offshore mount unknown": "offshore",
}

#: Statuses allowed after standardisation and after imputation.
PREPARED_STATUS = ["announced", "pre-construction", "construction", "operating", "retired"]
IMPUTED_STATUS = ["planned", "operating", "retired"]

#: Nested scenario status sets.
HISTORICAL = ["operating", "retired"]
SCENARIO_MAP = {
    "historical": HISTORICAL,
    "construction": HISTORICAL + ["construction"],
    "pre_construction": HISTORICAL + ["construction", "pre-construction"],
    "announced": HISTORICAL + ["construction", "pre-construction", "announced"],
}

#: Plant category -> national statistics categories.
EIA_CAT_MAPPING = {
    "bioenergy": ["biomass and waste"],
    "fossil": ["fossil fuels"],
    "geothermal": ["geothermal"],
    "hydropower": ["hydropower", "pumped storage"],
    "nuclear": ["nuclear"],
    "solar": ["solar"],
    "wind": ["wind"],
}

#: National statistics category -> series number in `INTL.{n}-7-{ISO3}-MK.A`.
EIA_CATEGORY_IDS = {
    "total": 2,
    "nuclear": 27,
    "fossil fuels": 28,
    "hydropower": 33,
    "geothermal": 35,
    "tide and wave": 117,
    "solar": 116,
    "wind": 37,
    "biomass and waste": 38,
    "pumped storage": 82,
}

#: Fuel text (after cleaning) -> fuel name.
FUEL_MAPPING = {
    "bioenergy: agricultural waste (biogas)": "biogas",
    "bioenergy: agricultural waste (solids)": "biomass",
    "bioenergy: agricultural waste (syngas)": "syngas",
    "bioenergy: agricultural waste (unknown)": "biomass",
    "bioenergy: biodiesel": "diesel",
    "bioenergy: ethanol": "ethanol",
    "bioenergy: paper mill wastes": "biomass",
    "bioenergy: refuse (landfill gas)": "biogas",
    "bioenergy: refuse (municipal and industrial wastes)": "solid waste",
    "bioenergy: refuse (syngas)": "syngas",
    "bioenergy: unknown": "biomass",
    "bioenergy: wastewater and sewage sludge (solids or biogas)": "biomass",
    "bioenergy: wood & other biomass (biocoal)": "biomass",
    "bioenergy: wood & other biomass (solids)": "biomass",
    "bioenergy: wood & other biomass (syngas)": "syngas",
    "coal: anthracite": "hard coal",
    "coal: bituminous": "hard coal",
    "coal: lignite": "brown coal",
    "coal: subbituminous": "brown coal",
    "coal: unknown": "brown coal",
    "coal: waste coal": "brown coal",
    "fossil gas: coalbed methane": "natural gas",
    "fossil gas: gaseous propane": "oil",
    "fossil gas: LNG": "natural gas",
    "fossil gas: natural gas": "natural gas",
    "fossil gas: unknown": "natural gas",
    "fossil gas: waste heat from natural gas": "waste heat",
    "fossil liquids: crude oil": "oil",
    "fossil liquids: diesel": "diesel",
    "fossil liquids: fuel oil": "oil",
    "fossil liquids: gasoline": "gasoline",
    "fossil liquids: heavy fuel oil": "oil",
    "fossil liquids: jet fuel": "oil",
    "fossil liquids: kerosene": "oil",
    "fossil liquids: light fuel oil": "oil",
    "fossil liquids: liquefied petroleum gas": "oil",
    "fossil liquids: naphtha": "oil",
    "fossil liquids: petroleum coke": "oil",
    "fossil liquids: unknown": "oil",
    "fossil liquids: waste/other oil": "oil",
    "industrial by-product:": "solid waste",
    "industrial by-product: blast furnace gas": "waste heat",
    "industrial by-product: coke oven gas": "waste heat",
    "industrial by-product: unknown": "solid waste",
    "other: hydrogen (blue)": "hydrogen",
    "other: hydrogen (green)": "hydrogen",
    "other: hydrogen (unknown)": "hydrogen",
    "other: tires": "solid waste",
}

#: Fuel entries too ambiguous to map; skipped while parsing a fuel cell.
AMBIGUOUS_FUELS = ["other: other", "other: unknown"]

#: Default user configuration: technology maps per category.
TECHNOLOGY_MAPPING = {
    "bioenergy": {"unknown": "bioenergy turbine"},
    "coal": {
        "CFB": "coal turbine",
        "IGCC": "igcc",
        "subcritical": "coal turbine",
        "supercritical": "coal turbine",
        "ultra-supercritical": "coal turbine",
        "unknown": "coal turbine",
    },
    "oil_gas": {
        "AFC": "ccgt",
        "ICCC": "ccgt",
        "IGCC": "igcc",
        "ISCC": "ccgt",
        "combined cycle": "ccgt",
        "gas turbine": "ocgt",
        "internal combustion": "reciprocating engine",
        "steam turbine": "steam turbine",
        "unknown": "ocgt",
    },
    "geothermal": {
        "advanced geothermal systems (AGS)": "high enthalpy geothermal",
        "binary cycle": "low enthalpy geothermal",
        "dry steam": "high enthalpy geothermal",
        "enhanced geothermal systems (EGS)": "high enthalpy geothermal",
        "flash steam - double": "low enthalpy geothermal",
        "flash steam - single": "high enthalpy geothermal",
        "flash steam - triple": "low enthalpy geothermal",
        "flash steam - unknown": "high enthalpy geothermal",
        "geopressured geothermal system (GGS)": "high enthalpy geothermal",
        "unknown": "high enthalpy geothermal",
    },
    "hydropower": {
        "Canal": "run of river",
        "PS": "pumped storage",
        "ROR": "run of river",
        "STO": "reservoir",
        "unknown": "reservoir",
    },
    "nuclear": {
        "boiling water reactor": "nuclear reactor",
        "fast breeder reactor": "nuclear reactor",
        "fast neutron reactor": "nuclear reactor",
        "gas-cooled reactor": "nuclear reactor",
        "heavy water gas-cooled reactor": "nuclear reactor",
        "heavy water light water reactor": "nuclear reactor",
        "high temperature gas reactor": "nuclear reactor",
        "liquid-metal-cooled fast reactor": "nuclear reactor",
        "light water graphite reactor": "nuclear reactor",
        "molten salt reactor": "nuclear reactor",
        "pressurized heavy water reactor": "nuclear reactor",
        "pressurized water reactor": "nuclear reactor",
        "small modular reactor": "nuclear reactor",
        "steam-generating heavy water reactor": "nuclear reactor",
        "unknown": "nuclear reactor",
    },
    "solar": {"csp": "concentrating solar power", "rooftop_pv": "rooftop pv", "utility_pv": "utility pv"},
    "wind": {"offshore": "offshore", "onshore": "onshore"},
}

#: Default DC/AC ratios for solar capacity.
DC_AC_RATIO = {"utility_pv": 1.25, "csp": 1.0}

#: Default shape class each technology must sit in.
SHAPE_CLASS_BY_TECHNOLOGY = {
    "bioenergy turbine": "land",
    "ccgt": "land",
    "coal turbine": "land",
    "concentrating solar power": "land",
    "high enthalpy geothermal": "land",
    "igcc": "land",
    "low enthalpy geothermal": "land",
    "nuclear reactor": "land",
    "ocgt": "land",
    "offshore": "maritime",
    "onshore": "land",
    "pumped storage": "land",
    "reciprocating engine": "land",
    "reservoir": "land",
    "run of river": "land",
    "steam turbine": "land",
    "utility pv": "land",
}

#: Default lifetimes (years) and retirement delays (years) per technology.
LIFETIME_YEARS = {
    "bioenergy turbine": 25,
    "ccgt": 20,
    "coal turbine": 50,
    "concentrating solar power": 25,
    "high enthalpy geothermal": 30,
    "igcc": 25,
    "low enthalpy geothermal": 30,
    "nuclear reactor": 50,
    "ocgt": 20,
    "offshore": 25,
    "onshore": 25,
    "pumped storage": 80,
    "reciprocating engine": 20,
    "reservoir": 80,
    "rooftop pv": 25,
    "run of river": 80,
    "steam turbine": 30,
    "utility pv": 25,
}
RETIREMENT_DELAY_YEARS = {
    "bioenergy turbine": 5,
    "ccgt": 5,
    "coal turbine": 5,
    "concentrating solar power": 2,
    "high enthalpy geothermal": 5,
    "igcc": 5,
    "low enthalpy geothermal": 5,
    "nuclear reactor": 5,
    "ocgt": 5,
    "offshore": 2,
    "onshore": 2,
    "pumped storage": 10,
    "reciprocating engine": 5,
    "reservoir": 10,
    "rooftop pv": 5,
    "run of river": 10,
    "steam turbine": 5,
    "utility pv": 2,
}

#: Columns that define an aggregation group when present.
CAPACITY_GROUP_COLUMNS = ["category", "technology", "chp", "ccs", "fuel_class"]

# --------------------------------------------------------------------------
# End of fixed values
# --------------------------------------------------------------------------


@dataclass(frozen=True)
class ImputationSettings:
    """Time imputation parameters."""

    scenario: str = "construction"
    lifetime_years: dict = field(default_factory=lambda: dict(LIFETIME_YEARS))
    retirement_delay_years: dict = field(default_factory=lambda: dict(RETIREMENT_DELAY_YEARS))


@dataclass(frozen=True)
class LocationSettings:
    """Placement parameters (distances in the unit of the working CRS)."""

    inner_distance: float = 100.0
    on_overlap: str = "raise"  # "raise" | "split_capacity"
    on_shape_class_error: str = "drop"  # "drop" | "ignore" | "raise"
    shape_class: dict = field(default_factory=lambda: dict(SHAPE_CLASS_BY_TECHNOLOGY))


def check_choice(name: str, value: str, allowed) -> str:
    """Plain-Python check of a configuration value."""
    if value not in allowed:
        raise ValueError(f"Invalid {name} {value!r}; expected one of {sorted(allowed)}.")
    return value
