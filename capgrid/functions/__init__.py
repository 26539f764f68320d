"""Column-level functions (string, date, map, array) used by the operators."""

from capgrid.functions.columns import *  # noqa: F401,F403
from capgrid.functions.fuels import parse_fuel_set  # noqa: F401
