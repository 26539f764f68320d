"""Set-valued dictionary encoding of fuel combinations.

A plant burns a *set* of fuels; each distinct set gets a class code
`<prefix><rank>` where rank is the 0-based position of the set in sorted
order (arrays compare element-wise, like tuples).  The class table holds one
row per (class, fuel).

Distinct sets are ranked per first fuel, and each first fuel's ranks start after
the number of sets before it, so no single task orders them all.  Codes are
joined back by broadcast when their measured size allows.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from capgrid.session import cut_lineage, small

def _ranked_sets(sets: DataFrame, set_col: str, prefix: str) -> DataFrame:
    """(set, fuel_class), marked for broadcast when measured small.

    The distinct sets are written to the checkpoint folder, so the input is
    read once.  Sets are ranked among those with the same first fuel, after
    the number of sets with smaller first fuels.
    """
    distinct = cut_lineage(sets.select(set_col).distinct()).withColumn("_first", F.get(set_col, F.lit(0)))
    sizes = distinct.groupBy("_first").agg(F.count(F.lit(1)).alias("_n"))  # one row a fuel
    before = sizes.select(F.col("_first").alias("_fuel"), (F.sum("_n").over(Window.orderBy("_first")) - F.col("_n")).alias("_before"))
    among = F.row_number().over(Window.partitionBy("_first").orderBy(set_col)) - 1
    ranked = distinct.withColumn("_among", among).join(before, F.col("_first").eqNullSafe(F.col("_fuel")))
    codes = ranked.select(set_col, F.concat(F.lit(prefix), (F.col("_before") + F.col("_among")).cast("string")).alias("fuel_class"))
    return small(codes, measured=distinct)


def _join_small(big: DataFrame, side: DataFrame, on, how: str = "inner") -> DataFrame:
    return big.join(small(side), on=on, how=how)


def class_table(codes: DataFrame, set_col: str = "fuels") -> DataFrame:
    """(fuel_class, fuel) rows from (set, fuel_class) codes."""
    return codes.select("fuel_class", F.explode(set_col).alias("fuel"))


# D2 -----------------------------------------------------------------------
def encode_sets(df: DataFrame, set_col: str, prefix: str) -> tuple[DataFrame, DataFrame]:
    """Returns (class table, df with `fuel_class` in place of the set column)."""
    codes = _ranked_sets(df, set_col, prefix)
    coded = df.join(codes, on=set_col).drop(set_col)
    return class_table(codes, set_col), coded


def sets_by_class(classes: DataFrame) -> DataFrame:
    """(fuel_class, fuels sorted array) from a class table."""
    return classes.groupBy("fuel_class").agg(F.array_sort(F.collect_list("fuel")).alias("fuels"))


# D3 -----------------------------------------------------------------------
def harmonise_classes(class_tables: Sequence[DataFrame], prefix: str = "fc") -> DataFrame:
    """One class table over several categories: sets rebuilt per class, distinct, re-ranked."""
    union = reduce(lambda a, b: a.unionByName(b), class_tables)
    sets = sets_by_class(union)
    return class_table(_ranked_sets(sets, "fuels", prefix))


# D4 -----------------------------------------------------------------------
def remap_classes(plants: DataFrame, old_classes: DataFrame, new_classes: DataFrame, strict: bool = True) -> DataFrame:
    """Old code -> fuel set -> new code.  An old code without a new one fails the job."""
    old = sets_by_class(old_classes).withColumnRenamed("fuel_class", "_old")
    new = sets_by_class(new_classes).withColumnRenamed("fuel_class", "_new")
    old_to_new = old.join(new, on="fuels", how="left").select("_old", "_new")
    out = _join_small(plants.withColumnRenamed("fuel_class", "_old"), old_to_new, on="_old", how="left")
    mapped = F.col("_new")
    if strict:
        mapped = F.when(mapped.isNotNull(), mapped).otherwise(
            F.raise_error(F.concat(F.lit("fuel class that the harmonised table lacks: "), F.coalesce(F.col("_old"), F.lit("null"))))
        )
    cols = [mapped.alias("fuel_class") if c == "fuel_class" else F.col(c) for c in plants.columns]
    return out.select(*cols)
