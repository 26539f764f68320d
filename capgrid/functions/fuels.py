"""A fuel cell of free text -> sorted set of mapped fuel names (built-ins only)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from capgrid.config import AMBIGUOUS_FUELS
from capgrid.functions.columns import ColumnLike, _col, map_literal


def parse_fuel_set(
    cell: ColumnLike,
    mapping: Mapping[str, str],
    default: str,
    ambiguous: Sequence[str] = tuple(AMBIGUOUS_FUELS),
    strict: bool = True,
) -> Column:
    """Split on `,`, drop `[..]` shares, trim, add `: unknown` when there is no
    colon, skip ambiguous entries, map each entry, and return the sorted
    distinct set; empty or null cells give `[mapping[default]]`.
    A fuel without a mapping fails the job when `strict`."""
    lookup = map_literal(mapping)
    default_fuel = mapping[default]

    def clean(x: Column) -> Column:
        t = F.trim(F.regexp_replace(x, r"\s*\[.*?\]", ""))
        return F.when(t.contains(":"), t).otherwise(F.concat(t, F.lit(": unknown")))

    def to_fuel(x: Column) -> Column:
        v = F.try_element_at(lookup, x)
        if not strict:
            return v
        return F.when(v.isNotNull(), v).otherwise(
            F.raise_error(F.concat(F.lit("fuel without an entry in its map: "), x))
        )

    entries = F.transform(F.split(_col(cell), ","), clean)
    kept = F.filter(entries, lambda x: ~x.isin(list(ambiguous)))
    fuels = F.array_sort(F.array_distinct(F.transform(kept, to_fuel)))
    return F.when(_col(cell).isNull() | (F.size(fuels) == 0), F.array(F.lit(default_fuel))).otherwise(fuels)
