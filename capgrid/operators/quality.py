"""Data-quality gates.

Rules are evaluated in one aggregate pass (`count_if` per rule) plus one
`groupBy ... having count > 1` per uniqueness rule; the result is a
violations table.  `gate(..., mode)` reports it, raises on it, or skips the
check, so validation costs an action only where a table is published.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from capgrid.config import IMPUTED_STATUS, PREPARED_STATUS
from capgrid.session import cut_lineage

PLANT_SCHEMA = T.StructType(
    [
        T.StructField("powerplant_id", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("category", T.StringType()),
        T.StructField("technology", T.StringType()),
        T.StructField("output_capacity_mw", T.DoubleType()),
        T.StructField("start_year", T.DoubleType()),
        T.StructField("end_year", T.DoubleType()),
        T.StructField("status", T.StringType()),
        T.StructField("lon", T.DoubleType()),
        T.StructField("lat", T.DoubleType()),
        T.StructField("country_id", T.StringType()),
        T.StructField("ccs", T.BooleanType()),
        T.StructField("chp", T.BooleanType()),
        T.StructField("fuel_class", T.StringType()),
        T.StructField("reservoir_km3", T.DoubleType()),
    ]
)
PLANT_OPTIONAL = ["country_id", "ccs", "chp", "fuel_class", "reservoir_km3"]

AGGREGATED_SCHEMA = T.StructType(
    [
        T.StructField("shape_id", T.StringType()),
        T.StructField("country_id", T.StringType()),
        T.StructField("category", T.StringType()),
        T.StructField("technology", T.StringType()),
        T.StructField("output_capacity_mw", T.DoubleType()),
        T.StructField("chp", T.BooleanType()),
        T.StructField("ccs", T.BooleanType()),
        T.StructField("fuel_class", T.StringType()),
    ]
)
AGGREGATED_OPTIONAL = ["chp", "ccs", "fuel_class"]

STATISTICS_SCHEMA = T.StructType(
    [
        T.StructField("year", T.IntegerType()),
        T.StructField("category", T.StringType()),
        T.StructField("capacity_mw", T.DoubleType()),
        T.StructField("country_id", T.StringType()),
    ]
)
FUEL_SCHEMA = T.StructType([T.StructField("fuel_class", T.StringType()), T.StructField("fuel", T.StringType())])


# I1 -----------------------------------------------------------------------
def conform(df: DataFrame, schema: T.StructType, optional: Iterable[str] = (), strict: bool = True) -> DataFrame:
    """Cast to `schema`; a missing required column (or, when strict, an extra one) is an error."""
    optional = set(optional)
    names = [f.name for f in schema.fields]
    missing = [n for n in names if n not in df.columns and n not in optional]
    extra = [c for c in df.columns if c not in names]
    if missing:
        raise ValueError(f"Missing columns: {missing}")
    if strict and extra:
        raise ValueError(f"Unexpected columns: {extra}")
    cols = [F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields if f.name in df.columns]
    if not strict:
        cols += [F.col(c) for c in extra]
    return df.select(*cols)


# I2 -----------------------------------------------------------------------
@dataclass(frozen=True)
class Rule:
    column: str
    kind: str  # not_null | unique | isin | gt | ge | length
    arg: object = None

    @property
    def name(self) -> str:
        return f"{self.column}:{self.kind}"

    def failing(self) -> F.Column:
        c = F.col(self.column)
        if self.kind == "not_null":
            return c.isNull()
        if self.kind == "isin":
            return c.isNotNull() & ~c.isin(list(self.arg))
        if self.kind == "gt":
            return c.isNotNull() & ~(c > F.lit(self.arg))
        if self.kind == "ge":
            return c.isNotNull() & ~(c >= F.lit(self.arg))
        if self.kind == "length":
            lo, hi = self.arg
            return c.isNotNull() & ~F.length(c).between(lo, hi)
        raise ValueError(f"Unknown rule kind {self.kind!r}.")


def check_rules(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Violations table (rule, failures) with one row per rule."""
    spark = df.sparkSession
    present = [r for r in rules if r.column in df.columns]
    row_rules = [r for r in present if r.kind != "unique"]
    parts = []
    if row_rules:
        counts = df.agg(*[F.count_if(r.failing()).alias(f"r{i}") for i, r in enumerate(row_rules)])
        stack = ", ".join(f"'{r.name}', r{i}" for i, r in enumerate(row_rules))
        parts.append(counts.selectExpr(f"stack({len(row_rules)}, {stack}) AS (rule, failures)"))
    for r in present:
        if r.kind == "unique":
            dup = (
                df.where(F.col(r.column).isNotNull())
                .groupBy(r.column)
                .agg(F.count(F.lit(1)).alias("n"))
                .where(F.col("n") > 1)
                .agg(F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("failures"))
                .select(F.lit(r.name).alias("rule"), "failures")
            )
            parts.append(dup)
    if not parts:
        return spark.createDataFrame([], "rule string, failures long")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select("rule", F.col("failures").cast("long"))


def gate(df: DataFrame, rules: Sequence[Rule], mode: str = "raise") -> DataFrame:
    """Validate at a publish point: `raise` on any violation, `report` prints, `skip` does nothing."""
    if mode == "skip":
        return df
    bad = [r for r in check_rules(df, rules).where(F.col("failures") > 0).collect()]
    if bad and mode == "raise":
        raise ValueError("Schema check failed: " + ", ".join(f"{r['rule']}={r['failures']}" for r in bad))
    if bad:
        print("Schema violations:", [(r["rule"], r["failures"]) for r in bad])
    return df


def enforce(df: DataFrame, rules: Sequence[Rule], mode: str = "raise", key: str = "powerplant_id") -> DataFrame:
    """Row rules as part of the plan: a row that breaks one fails the job when its `key` is read, without a pass of its own.

    Rules on whole columns (uniqueness) are left to `gate`.  `skip` does nothing.
    """
    present = [r for r in rules if r.column in df.columns and r.kind != "unique"]
    if mode == "skip" or not present:
        return df
    broken = F.coalesce(*[F.when(r.failing(), F.lit(r.name)) for r in present])
    stop = F.raise_error(F.concat(F.lit("row breaks the rule "), broken, F.lit(": "), F.coalesce(F.col(key).cast("string"), F.lit("null"))))
    return df.withColumn(key, F.when(broken.isNull(), F.col(key)).otherwise(stop))


# I3 -----------------------------------------------------------------------
def stage_rules(tech_values: Iterable[str], stage: str) -> list[Rule]:
    """Plant rules of a stage: prepare (years nullable, 5 statuses) or impute (years set, 3 statuses)."""
    if stage == "prepare":
        statuses, years_required = PREPARED_STATUS, False
    elif stage == "impute":
        statuses, years_required = IMPUTED_STATUS, True
    else:
        raise ValueError(f"unknown rule stage {stage!r}")
    rules = [
        Rule("powerplant_id", "unique"),
        Rule("powerplant_id", "not_null"),
        Rule("name", "not_null"),
        Rule("category", "not_null"),
        Rule("technology", "not_null"),
        Rule("technology", "isin", sorted(set(tech_values))),
        Rule("output_capacity_mw", "not_null"),
        Rule("output_capacity_mw", "gt", 0),
        Rule("status", "not_null"),
        Rule("status", "isin", list(statuses)),
        Rule("lon", "not_null"),
        Rule("lat", "not_null"),
        Rule("country_id", "length", (3, 3)),
        Rule("reservoir_km3", "ge", 0),
    ]
    if years_required:
        rules += [Rule("start_year", "not_null"), Rule("end_year", "not_null")]
    return rules


AGGREGATED_RULES = [
    Rule("shape_id", "not_null"),
    Rule("country_id", "not_null"),
    Rule("category", "not_null"),
    Rule("technology", "not_null"),
    Rule("output_capacity_mw", "gt", 0),
    Rule("output_capacity_mw", "not_null"),
]
SHAPE_RULES = [Rule("shape_id", "unique"), Rule("shape_id", "not_null"), Rule("shape_class", "isin", ["land", "maritime"])]


def checked(df: DataFrame, rules: Sequence[Rule], mode: str = "raise", one_category: bool = False) -> DataFrame:
    """`df` cut at a publish point and then validated: its plan runs once, the checks read the cut table.

    With `one_category`, a table with rows must also hold exactly one category (I4).
    """
    if mode == "skip":
        return df
    cut = cut_lineage(df)
    if one_category and cut.limit(1).count():
        single_category(cut)
    return gate(cut, rules, mode)


# I4 -----------------------------------------------------------------------
def single_category(df: DataFrame) -> str:
    """The one category of a table (reads at most two distinct values)."""
    cats = [r[0] for r in df.select("category").distinct().limit(2).collect()]
    if len(cats) != 1:
        raise ValueError(f"the table must hold exactly one category, it holds {cats}")
    return cats[0]


# I5 -----------------------------------------------------------------------
def mismatched_ids(a: DataFrame, b: DataFrame, col: str = "shape_id") -> DataFrame:
    """Ids present in only one of the two tables (symmetric difference)."""
    ia = a.select(col).distinct()
    ib = b.select(col).distinct()
    return ia.join(ib, on=col, how="left_anti").unionByName(ib.join(ia, on=col, how="left_anti"))
