"""Statistics of electricity readings by zone and time, on Spark."""

from gridstats.operators import *  # noqa: F403
from gridstats.plans import *  # noqa: F403
from gridstats.sinks import *  # noqa: F403
from gridstats.sources import *  # noqa: F403
