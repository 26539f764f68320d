"""Sources and sinks."""

from capgrid.sources.readers import *  # noqa: F401,F403
from capgrid.sources.sinks import write_output  # noqa: F401
